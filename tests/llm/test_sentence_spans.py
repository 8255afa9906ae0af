"""Repeated sentence spans against a brute-force version."""
import hashlib
import random

from feedloom.llm import queries as Q
from feedloom.llm import sentence_spans as S
from feedloom.llm.common import corpus, identified


def slow_runs(texts, shortest=False):
    """Texts in order of first occurrence without the sentences of any run, of whatever length, that came before.

    With ``shortest``, of the shortest runs from and up to every sentence only: runs of the same words in
    sentences that are cut elsewhere are then found by these alone."""
    first, out = {}, []
    for d, text in enumerate(texts):
        parts = S.sentences(text)
        gone = [False] * len(parts)
        toks = [text[a:b].lower().split() for a, b in parts]
        size = [S.n_words(text[a:b]) for a, b in parts]
        valid = {(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)
                 if toks[i] and toks[j - 1] and sum(map(bool, toks[i:j])) >= S.SPAN and sum(size[i:j]) >= S.SPAN_WORDS}
        if shortest:
            end, start = {}, {}
            for i, j in valid:
                end[i], start[j] = min(j, end.get(i, j)), max(i, start.get(j, i))
            valid = set(end.items()) | {(i, j) for j, i in start.items()}
        for i, j in sorted(valid):
            if first.setdefault(tuple(w for t in toks[i:j] for w in t), (d, i)) < (d, i):
                gone[i:j] = [True] * (j - i)
        out.append("".join(text[a:b] for (a, b), g in zip(parts, gone) if not g))
    return out


def test_sentences_tile_the_text():
    for t in ["", "One. Two! Three?\nFour", "a" * 50, "\n\n x.  y", 'He said "no." Then. 世界。你好！', " ".join(f"w{i}" for i in range(300))]:
        parts = S.sentences(t)
        assert "".join(t[a:b] for a, b in parts) == t and all(a < b for a, b in parts)
    assert len(S.sentences("One. Two! Three?\nFour")) == 4
    long = [f"w{i}" for i in range(300)]
    cut = lambda ws: {" ".join(ws)[a:b].strip() for a, b in S.sentences(" ".join(ws))}
    assert len(cut(long) & cut(["x"] * 7 + long[20:])) > 15


def make(rnd):
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(60))
    sent = lambda: " ".join(word() for _ in range(rnd.choice([1, 2, 4, 9, 30]))) + rnd.choice([".", "!", "?"])
    passages = [" ".join(sent() for _ in range(rnd.randrange(4, 12))) for _ in range(5)]
    texts = []
    for _ in range(60):
        p = rnd.choice(passages)
        texts.append(" ".join([sent() for _ in range(rnd.randrange(0, 6))]) + " " + (p if rnd.random() < .5 else p.upper().replace(" ", "\n")) + " " + sent())
    return texts + [None, "", "no end", "A. B. C. " * 40] + [texts[0]] * 3


def compare(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, k1 int, n int")
    tag = identified(corpus(df)).collect()
    order = sorted({(r.uid, r.th, r.text) for r in tag})
    want = dict(zip(order, slow_runs([r[2] for r in order], shortest=True)))
    want = sorted((r.did is None, r.did, want[r.uid, r.th, r.text]) for r in tag)
    got = S.remove_repeated_spans(df).collect()
    assert sorted((r.did is None, r.did, r.kept_text) for r in got) == want
    assert all(r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest() and r.n_bytes - r.n_removed == len(r.kept_text.encode()) for r in got)
    return got


def test_against_brute_force(spark):
    texts = make(random.Random(3))
    got = compare(spark, [(None if i == 9 else i // 2, t) for i, t in enumerate(texts)])
    assert any(r.n_removed for r in got) and any(r.n_bytes and not r.n_removed for r in got)


def test_passages_inside_other_sentences_are_caught_and_clean_texts_kept(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    text = lambda n: " ".join(word() + ("." if rnd.random() < .12 else "") for _ in range(n))
    passage = text(70)
    rows = [(i, f"{text(30)} {passage} {text(30)}") for i in range(20)] + [(100 + i, text(100)) for i in range(50)]
    got = {r.did: r for r in compare(spark, rows)}
    assert not got[0].n_removed and all(not got[100 + i].n_removed for i in range(50))
    assert all(got[i].n_removed > len(passage) / 2 for i in range(1, 20))


def test_against_all_runs(spark):
    rnd = random.Random(21)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(60))
    sent = lambda: " ".join(word() for _ in range(rnd.choice([1, 2, 4, 9, 30]))) + rnd.choice([".", "!", "?"])
    passages = [[sent() for _ in range(rnd.randrange(3, 9))] for _ in range(6)]
    texts = [" ".join([sent() for _ in range(rnd.randrange(4))] + rnd.choice(passages) + [sent() for _ in range(rnd.randrange(4))]) for _ in range(40)]
    got = S.remove_repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.kept_text for r in sorted(got, key=lambda r: r.did)] == slow_runs(texts)


def test_passages_are_removed_to_both_ends_in_all_scripts(spark):
    rnd = random.Random(22)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    spaced = lambda sizes: "".join(" ".join(word() for _ in range(n)) + ". " for n in sizes)
    han = lambda sizes: "".join("".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(n)) + "。" for n in sizes)
    rows, kept = [], []
    for k, (make, sizes) in enumerate([(spaced, [9, 17, 16, 5, 2, 2]), (spaced, [2, 2, 17, 17, 9, 2, 2]), (han, [14, 20, 9, 12, 5, 3])]):
        passage = make(sizes)
        for d in range(2):
            before, after = make([8, 11, 7]), make([6, 10, 8])
            rows.append((2 * k + d, before + passage + after))
            kept.append(before + (passage if d == 0 else "") + after)
    got = S.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.kept_text for r in sorted(got, key=lambda r: r.did)] == kept
    text = "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(400))  # without any full stop
    cut = lambda t: {t[a:b] for a, b in S.sentences(t)}
    assert len(cut(text) & cut("前" * 5 + text[30:])) > 10


def test_empty_table(spark):
    assert S.remove_repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_frequent_runs_span_many_tasks(spark):
    """One run in a third of all rows, rows without ids among them, in more tasks than rows of other runs."""
    rnd = random.Random(31)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    text = lambda n: " ".join(word() + ("." if rnd.random() < .2 else "") for _ in range(n))
    passage = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen fifteen."
    rows = [(None if i % 5 == 0 else i, f"{text(5)}. {passage} {text(9)}") for i in range(150)] + [(1000 + i, text(60)) for i in range(300)]
    rows += [(7, rows[7][1])] * 40  # repeated rows
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = compare(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert sum(r.n_removed > 0 for r in got) >= 149


def test_the_first_row_of_a_task(spark):
    """Runs of one hash over any cut into tasks, each task a list of (hash, place)."""
    import pyarrow as pa
    rnd = random.Random(6)
    for _ in range(200):
        rows = sorted((rnd.randrange(4), rnd.randrange(6)) for _ in range(rnd.randrange(1, 25)))
        cuts = [0, *sorted(rnd.randrange(len(rows) + 1) for _ in range(rnd.randrange(4))), len(rows)]
        late, ends = set(), []
        for i, j in zip(cuts, cuts[1:]):
            batch = lambda part: pa.record_batch([pa.array([r[c] for r in part], t) for c, t in
                                                  ((1, pa.int64()), (1, pa.int64()), (0, pa.int64()), (0, pa.int64()), (1, pa.int32()), (1, pa.int32()))],
                                                 names=["uid", "th", "k1", "k2", "a", "e"])
            m = rnd.randrange(i, j + 1)
            for out in S._late_stage()(batch(p) for p in (rows[i:m], rows[m:j])):
                for r in out.to_pylist():
                    ends.append(r) if r["end"] else late.add((r["uid"], r["a"]))
        first = {}
        for r in ends:
            first[r["k1"]] = min(first.get(r["k1"], 99), r["a"])
        found = sorted(late | {(r["uid"], r["a"]) for r in ends if r["end"] == 1 and r["a"] > first[r["k1"]]})
        least = {k: min(a for h, a in rows if h == k) for k, _ in rows}
        assert found == sorted({(a, a) for k, a in rows if a > least[k]})


def test_query(spark):
    got = Q.queries()["op10_sentence_spans"](spark, "/root/testdata/sf0.001").collect()
    rows = identified(corpus(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).collect()
    rows.sort(key=lambda r: (r.uid, r.th))
    assert {r.doc_id: r.kept_text for r in got} == dict(zip((r.did for r in rows), slow_runs([r.text for r in rows])))
