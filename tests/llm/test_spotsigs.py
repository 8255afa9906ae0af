"""SpotSigs: neighbours and groups against brute force."""
import hashlib
import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from feedloom.llm import queries as Q
from feedloom.llm import spotsigs as S


def slow_signatures(text):
    import regex
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    out = set()
    for i, w in enumerate(words):
        rest = [x for x in words[i + 1:] if x not in S.ANCHORS][:2]
        if w in S.ANCHORS and len(rest) == 2:
            out.add((w, *rest))
    if not out and len(words) > 2:
        out = {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
    if not out and text:
        out = {tuple(words) if words else (text,)}
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """rows: (id, text) in order of next documents."""
    out = []
    for k, (d, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        a, b, c = slow_signatures(t), slow_signatures(e), slow_signatures(nxt)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(a, b), jaccard(a, c)))
    return out


def test_signatures():
    t = "The quick brown fox is in the big old house"
    assert S.signatures(t) == {S._hash(*s) for s in slow_signatures(t)} and len(S.signatures(t)) == 4
    assert S.signatures("") == frozenset() and S.likeness(frozenset(), frozenset()) == 1
    assert S.fingerprint(frozenset()) == "" and len(S.fingerprint(S.signatures(t))) == 32
    assert len(S.signatures("%%% !!")) == 1 and len(S.signatures("zig zag zog zug")) == 2


def test_neighbours(spark):
    rnd = random.Random(1)
    words = ["the", "of", "und", "la"] + [f"w{i}" for i in range(40)] + ["Ünd", "日本"]
    rows = [(i * 3, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 50)))) for i in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "x")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, bucket int, tail string")
    want = expected(sorted(((d, t or "") for d, t in rows), reverse=True))
    for buckets in (1, 7, 50):
        got = S.edited_neighbours(df, buckets=buckets).collect()
        assert sorted((r.did, r.n_chars, r.edited_sha256) for r in got) == sorted(w[:3] for w in want)
        assert all(abs(r.near_edited - w[3]) < 1e-9 and abs(r.near_next - w[4]) < 1e-9
                   for r, w in zip(sorted(got, key=lambda r: r.did), sorted(want)))


def test_ties_nulls_and_small_tables(spark):
    rows = [(1, "the a b c"), (1, "the a b c"), (1, "other words of it"), (None, "x"), (None, None), (2, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.edited_neighbours(df).collect()
    assert sorted((r.did is None, r.did, r.n_chars) for r in got) == sorted((d is None, d, len(t or "")) for d, t in rows)
    one = S.edited_neighbours(df.filter("doc_id = 2")).collect()
    assert [(r.near_next, r.near_edited) for r in one] == [(1.0, 1.0)]
    assert S.edited_neighbours(df.limit(0)).count() == 0 and S.near_duplicates(df.limit(0)).count() == 0


def test_rows_without_ids_are_many_ranges(spark):
    rows = [(None if i % 3 == 0 else i, f"the word number {i} of it") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = S.corpus(df).withColumn("k", F.coalesce("did", F.lit(-(2 ** 63)).cast("long"))).withColumn("th", F.xxhash64("text"))
    cuts = S.range_cuts(keyed, 40)
    found = keyed.select("k", "th", S._above(cuts).alias("b")).collect()
    assert all(r.b == sum(c > (r.k, r.th) for c in cuts) for r in found)
    sizes = Counter(r.b for r in found)
    assert len(sizes) == 40 and max(sizes.values()) < 120
    got = S.edited_neighbours(df, buckets=40).collect()
    want = expected([(k, t) for k, _, t in sorted(((r.k, r.th, r.text) for r in keyed.collect()), reverse=True)])
    assert sorted((r.n_chars, r.edited_sha256) for r in got) == sorted((w[1], w[2]) for w in want)


def test_pruned_jaccard_is_exact_and_stops_early(monkeypatch):
    rnd = random.Random(9)
    counted = []
    monkeypatch.setattr(S.np, "intersect1d", lambda *a, f=S.np.intersect1d, **k: counted.append(len(a[0])) or f(*a, **k))
    for _ in range(300):
        a, b = (sorted(rnd.sample(range(60), rnd.randrange(1, 50))) for _ in "ab")
        b = a[:rnd.randrange(1, len(a) + 1)] if rnd.random() < .5 else b
        assert S.pruned_jaccard(S.np.array(a), S.np.array(b), .8) == (jaccard(set(a), set(b)) >= .8)
    counted.clear()
    assert not S.pruned_jaccard(S.np.arange(0, 4000, 2), S.np.arange(1, 4001, 2), .8) and sum(counted) < 600


def test_groups_query_on_whole_documents(spark):
    got = {r.doc_id: r.component_id for r in Q.queries()["spotsigs_groups"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sets, comp = {d.doc_id: slow_signatures(d.text or "") for d in docs}, {d.doc_id: d.doc_id for d in docs}
    for a, b in itertools.combinations(sorted(sets), 2):
        if comp[a] != comp[b] and jaccard(sets[a], sets[b]) >= .8:
            lo, hi = sorted((comp[a], comp[b]))
            comp = {k: lo if c == hi else c for k, c in comp.items()}
    assert got == comp


def test_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 8)
    rnd = random.Random(2)
    words = ["the", "of", "is"] * 20 + [f"w{i}" for i in range(200)]
    texts = [None, "", "solo"]
    for _ in range(15):
        base = [rnd.choice(words) for _ in range(rnd.randrange(10, 120))]
        for _ in range(5):
            t = list(base)
            for _ in range(rnd.randrange(0, 4)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            texts.append(" ".join(t))
    texts += [texts[5]] * 20
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, fid int")
    got = {r.did: r.component_id for r in S.near_duplicates(df).collect()}
    sets = [slow_signatures(t or "") for t in texts]
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if jaccard(sets[a], sets[b]) >= 0.8 and comp[a] != comp[b]:
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if c == hi else c for c in comp]
    assert got == dict(enumerate(comp))


def near_copies(rnd, groups, copies, edits):
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = [w for _ in range(rnd.randrange(4, 50)) for w in ("the", rnd.choice(words), rnd.choice(words))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.randrange(edits)):
                t[3 * rnd.randrange(len(t) // 3) + 1] = rnd.choice(words)
            out.append(" ".join(t))
    return out


def test_a_large_group_is_not_compared_pair_by_pair(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(S, "_alike", lambda pairs, *a, f=S._alike: asked.append(pairs.distinct().count()) or f(pairs, *a))
    rnd = random.Random(4)
    base = [f"{w} x{i} y{i}" for i in range(100) for w in ("the",)]
    texts = [" ".join(c if j != k else f"the new{i} one{i}" for j, c in enumerate(base)) for i, k in ((i, rnd.randrange(100)) for i in range(400))]
    rows = S.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == 400 and {r.component_id for r in rows} == {0}
    assert sum(asked) < 40 * 400  # of 79,800 pairs, once for a few next ones of each bucket


def test_groups_of_far_copies_in_small_blocks(spark, monkeypatch):
    for name, value in (("BUCKET", 3), ("TURNS", 1), ("NEXT", 1), ("FREQUENT", 20)):
        monkeypatch.setattr(S, name, value)
    texts = near_copies(random.Random(5), 12, 25, 9)
    sets = [slow_signatures(t) for t in texts]
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if comp[a] != comp[b] and jaccard(sets[a], sets[b]) >= .8:
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if c == hi else c for c in comp]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (7, texts[7]), (None, "alone the one two")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [*enumerate(comp), (None, comp[3]), (7, comp[7]), (None, None)]
    assert sorted(map(str, ((r.did, r.component_id) for r in got))) == sorted(map(str, want))


def test_query(spark):
    got = Q.queries()["op2_spotsigs"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {w[0]: w for w in expected(sorted(((d.doc_id, d.text) for d in docs), reverse=True))}
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == w[1:3] and abs(r.near_edited - w[3]) < 1e-9 and abs(r.near_next - w[4]) < 1e-9
