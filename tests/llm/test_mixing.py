"""Pfair mix: lag below one block, windows kept, every row once, oracle."""
import math
from collections import Counter, defaultdict

import duckdb

from feedloom.llm import mixing as M
from feedloom.llm import queries as Q


def test_schedule_keeps_windows_and_lag(spark):
    w = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 13.0), ("d", 6.9), ("e", 0.1), (None, None)], "source string, weight double")
    quota = M.shares(w, 100)
    q = {r.source: r.q for r in quota.collect()}
    assert sum(q.values()) == 100 and min(q.values()) >= 1 and set(q) == {"a", "b", "c", "d", "e", ""}
    rows = sorted(M.schedule(quota).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(100))
    done = Counter()
    for r in rows:
        assert r.j == done[r.source]
        assert math.floor(r.j * 100 / r.q) <= r.slot < math.ceil((r.j + 1) * 100 / r.q)
        done[r.source] += 1
        for s in q:
            assert abs(done[s] - (r.slot + 1) * q[s] / 100) < 1


def rows_of(spark):
    rows = [(i, f"text {i}", s, 5) for i, s in enumerate(["hot"] * 900 + ["b"] * 200 + ["c"] * 40)]
    rows += [(None, None, None, None), (None, "x", None, 1), (3, "text 3", "hot", 5), (3, "other", "hot", 5)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, slot long")


def test_every_row_once_and_blocks_in_order(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_DOCS", 50)
    rows, df = rows_of(spark)
    got = M.mix(df).collect()
    assert Counter(tuple(r.row) for r in got) == Counter(rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append((r.block, r.pos, r.slot))
    for v in by.values():
        v.sort()
        assert [(b, p) for b, p, _ in v] == [(i // 8, i % 8) for i in range(len(v))]
        slots = [s for _, p, s in v if p == 0]
        assert slots == sorted(set(slots))
    blocks = sorted({(r.slot, r.source) for r in got})
    assert len({s for s, _ in blocks}) == len(blocks)


def test_given_weights(spark):
    _, df = rows_of(spark)
    w = spark.createDataFrame([("hot", 1.0), ("b", 3.0), ("ghost", 2.0)], "source string, weight double")
    got = M.mix(df, w).collect()
    assert len(got) == df.count()
    dry = min(max(r.slot for r in got if r.source == s) for s in ("hot", "b"))
    early = Counter(r.source for r in got if r.slot <= dry and r.pos == 0)
    assert abs(early["b"] - 3 * early["hot"]) <= 4


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(Q.oracle_sql()["op8_pfair_mix"]).fetchall())
    df = Q.queries()["op8_pfair_mix"](spark, sf)
    assert df.columns == ["doc_id", "source", "block", "slot", "pos"]
    assert sorted(map(tuple, df.collect())) == want
