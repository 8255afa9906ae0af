"""Benchmark passages: exact and edited copies found, clean texts left alone."""
import random

from feedloom.llm import decontaminate as D
from feedloom.llm import queries as Q


def slow_search(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edit_search_is_exact():
    rnd = random.Random(2)
    for _ in range(200):
        p = bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 12)))
        t = bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(0, 30)))
        want = slow_search(p, t)
        got = D.edit_search(p, t, len(p))
        assert got[0] == want
        assert D.edit_search(p, t, want - 1) is None


def edited(rnd, text, rate):
    out = []
    for c in text:
        x = rnd.random()
        if x < rate / 3:
            continue
        out.append(rnd.choice("abcdefgh") if x < 2 * rate / 3 else c)
        if x > 1 - rate / 3:
            out.append(rnd.choice("abcdefgh "))
    return "".join(out)


def words(rnd, n):
    return " ".join("".join(rnd.choice("aeioubcdfglmnprst") for _ in range(rnd.randrange(2, 9))) for _ in range(n))


def test_recall_and_clean_texts(spark):
    rnd = random.Random(4)
    items = [(i, words(rnd, rnd.choice([5, 16, 30, 60]))) for i in range(60)] + [(100, None), (101, ""), (102, "too short"), (103, "Ä " * 30)]
    rows, want = [], {}
    for d in range(400):
        text = words(rnd, rnd.randrange(0, 120))
        if d % 4 == 0:
            i, t = items[rnd.randrange(60)]
            rate = rnd.choice([0, 0, 0.02, 0.05])
            t = edited(rnd, t, rate).upper() if rnd.random() < .5 else edited(rnd, t, rate).replace(" ", "\n")
            text += " " + t + " " + words(rnd, 20)
            want[d] = i
        rows.append((d, text, "x", d))
    rows += [(1000, None, "x", 0), (1001, "", "x", 0), (1002, rows[0][1], "x", 0), (1002, rows[0][1], "x", 0), (None, rows[0][1], "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string, row long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.scan(docs, bench).collect()
    assert len(got) == len(rows) and got[0].row.asDict().keys() == {"doc_id", "text", "hits", "row"}
    byid = dict(items)
    found, eligible = 0, 0
    for r in got:
        for h in r.hits:
            x, t = D.fold(byid[h.item_id]).strip(), D.fold(r.row.text)
            assert h.distance <= len(x) * D.MAX_EDIT and slow_search(x, t) == h.distance
            assert D.edit_search(x, t[h.start:h.end], len(x))[0] == h.distance
        i = want.get(r.row.doc_id)
        if i is not None and slow_search(D.fold(byid[i]), D.fold(r.row.text)) <= len(byid[i]) * D.MAX_EDIT and len(byid[i]) >= D.MIN_ITEM:
            eligible += 1
            found += i in [h.item_id for h in r.hits]
        elif i is None and r.row.doc_id is not None and r.row.doc_id < 1000:
            assert not r.hits
    assert eligible > 60 and found / eligible >= 0.95, (found, eligible)
    same = [[h.item_id for h in r.hits] for r in got if r.row.doc_id in (0, 1002, None)]
    assert len(same) == 4 and all(x == same[0] == [want[0]] for x in same)


def test_exact_copies_are_found_whatever_stands_around_them(spark):
    rnd = random.Random(8)
    cjk = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(n))
    thai = lambda n: "".join(chr(rnd.randrange(0x0E01, 0x0E2F)) for _ in range(n))
    items = [(0, "which river runs through the old town of the capital?"), (1, "日本で一番高い山の名前と、その山がある二つの県の名前を答えなさい。"), (2, "a" * 60)]
    items += [(10 + n, words(rnd, 40)[:n].replace(" ", "x")) for n in range(24, 120)]
    items += [(200 + n, cjk(n)) for n in range(8, 40)] + [(300 + n, thai(n)) for n in range(8, 40)]
    around = [("plain ", " end"), ('he asked "', '" and'), ("(", ")"), ("**", "**"), ("> x\n>", "\n"), ("[", "]("), (cjk(30), cjk(30)), (thai(9), cjk(5)), ("", ""), ("abc", "def")]
    rows = [(k * 1000 + i, a + t + b) for k, (a, b) in enumerate(around) for i, t in items]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.row.doc_id, h.item_id): (h.distance, h.end - h.start) for r in D.scan(docs, bench).collect() for h in r.hits}
    byid = dict(items)
    missed = [d for d, _ in rows if got.get((d, d % 1000)) != (0, len(byid[d % 1000].encode()))]
    assert not missed, (len(missed), len(rows), missed[:20])


def test_short_items_are_found_verbatim_and_not_inside_words(spark):
    items = [(1, "What is 2+2?"), (2, "cat"), (3, "世界"), (4, "7"), (5, " "), (6, "Cat"), (7, "x" * 23)]
    texts = ["So: what  is 2+2?", "WHAT IS 2+2? what is 2+2?", "concatenate 17 cats", "a cat.", "你好世界人", "7\n", "", "y" + "x" * 23, "(" + "x" * 23 + ")"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: [(h.item_id, h.distance, h.start, h.end) for h in r.hits] for r in D.scan(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {0: [], 1: [(1, 0, 0, 12)], 2: [], 3: [(2, 0, 2, 5), (6, 0, 2, 5)], 4: [(3, 0, 6, 12)], 5: [(4, 0, 0, 1)], 6: [], 7: [], 8: [(7, 0, 1, 24)]}


def test_recall_at_the_edit_limit():
    """Items edited in about a tenth of their bytes: of those still within the limit at least 0.95 are found."""
    rnd = random.Random(17)
    found = eligible = 0
    items = [(i, words(rnd, rnd.choice([6, 12, 25, 50]))) for i in range(150)]
    table = D.Items(items, D.FUNCTIONS, D.MAX_EDIT)
    for k, (i, t) in enumerate(items):
        for _ in range(4):
            text = D.fold(words(rnd, 15) + " " + edited(rnd, t, .09) + " " + words(rnd, 15))
            if slow_search(table.items[k][1], text) <= table.limit(k):
                eligible += 1
                raw = D.np.frombuffer(text + bytes(D.STEPS), dtype=D.np.uint8)
                pairs = table.candidates(raw, D.all_starts(raw))
                found += i in [h["item_id"] for h in D._hits(table, text, pairs)] if len(pairs) else 0
    assert eligible > 300 and found / eligible >= .95, (found, eligible)


def test_item_blocks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BLOCK", 100)
    rnd = random.Random(6)
    items = [(i, words(rnd, 12)) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(D.item_blocks(bench))
    assert sorted(x for b, _ in blocks for x in b) == sorted(items) and len(blocks) > 3 and [m for _, m in blocks] == [True] * (len(blocks) - 1) + [False]
    docs = spark.createDataFrame([(i, f"lead in {t} and out") for i, t in items], "doc_id long, text string")
    assert {(r.row.doc_id, tuple(h.item_id for h in r.hits)) for r in D.scan(docs, bench).collect()} == {(i, (i,)) for i, _ in items}
    assert D.scan(docs.limit(0), bench).count() == 0
    assert all(r.hits == [] for r in D.scan(docs, bench.limit(0)).collect())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id): r.distance for r in Q.queries()["op9_decontaminate"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {}
    for d in docs:
        text = D.fold(d.text)
        for i in items:
            x = D.fold(i.text).strip()
            hit = D.edit_search(x, text, int(len(x) * D.MAX_EDIT))
            if hit:
                want[d.doc_id, i.item_id] = hit[0]
    assert got == want and want
