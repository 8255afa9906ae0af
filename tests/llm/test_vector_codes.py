"""Vector codes against a brute-force version of the same fit."""
import hashlib
import math
import random
from collections import defaultdict

import numpy as np

from feedloom.llm import queries as Q
from feedloom.llm import vector_codes as V


def brute(rows, scale=1024, parts=4, entries=256, rounds=4):
    """rows: (vec_id, embedding, label) with unique ids and whole vectors."""
    rows = sorted((r[0], [math.floor(scale * x) for x in r[1]], r[2]) for r in rows)
    x = np.array([r[1] for r in rows], dtype=np.int64)
    codes, error, books = [], np.zeros(len(rows), dtype=np.int64), []
    for part in np.split(x, parts, axis=1):
        book = part[:entries].copy()
        nearest = lambda: ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
        for _ in range(rounds):
            at = nearest().argmin(axis=1)
            for e in range(len(book)):
                if (at == e).any():
                    book[e] = [int(s) // int((at == e).sum()) for s in part[at == e].sum(axis=0)]
        d = nearest()
        codes.append(d.argmin(axis=1))
        error += d.min(axis=1)
        books += book.ravel().tolist()
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    by = defaultdict(int)
    for r, e in zip(rows, error):
        by[r[2]] += int(e)
    return [(r[0], "".join(f"{c[i]:02x}" for c in codes), int(error[i]), by[r[2]], sha) for i, r in enumerate(rows)]


def shown(df):
    return sorted(((r.vid, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_orchard_finds_the_nearest_and_the_lowest_of_ties():
    rng = np.random.default_rng(1)
    for k, m, spread in [(1, 4, 5), (7, 1, 3), (256, 2, 4), (256, 16, 400), (200, 4, 2)]:
        entries, x = rng.integers(-spread, spread, (k, m)), rng.integers(-spread, spread, (500, m))
        o = V.Orchard(entries)
        best, dist = o.nearest(x)
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (best == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    o = V.Orchard(rng.integers(0, 1000, (256, 2)))  # few of all distances are looked at
    o.nearest(rng.integers(0, 1000, (2000, 2)))
    assert o.looked_at < 2000 * 256 / 4


def test_against_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i * 3 - 50, [rnd.gauss(0, .3) for _ in range(8)], rnd.choice([0, 1, None])) for i in range(700)]
    rows += [(5000 + i, rows[i % 3][1], 7) for i in range(300)]  # copies
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, n int, code string").repartition(4)
    for entries in (256, 20):
        assert shown(V.compress(df, entries=entries)) == brute(rows, entries=entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [.5, -.25, 0., 1.], 3), (2, [.1, .2, .3, .4], None), (9, [1e30, -1e30, 0., 0.], 3)]
    bad = [(3, None, 3), (4, [None, 1., 1., 1.], 3), (5, [nan, 1., 1., 1.], 3), (6, [1., inf, 1., -inf], 3), (7, [1., 1.], 3), (8, [], 3)]
    got = shown(V.compress(spark.createDataFrame(good + bad + good[:1] + [(None, good[0][1], None)], "vec_id long, embedding array<double>, label int")))
    assert [r[0] for r in got] == [1, 1, 2, 9, None] and got[0] == got[1] and all(r[2] == 0 and r[3] == 0 for r in got)
    assert V.compress(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0
    assert V.compress(spark.createDataFrame(bad, "vec_id long, embedding array<double>, label int").filter("vec_id in (3, 7, 8)")).count() == 0


def test_labels_hot_and_rare(spark):
    rows = [(i, [float(i % 5), 0., 1., 2.], None if i % 3 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    got = V.compress(df, entries=2).collect()
    by = defaultdict(int)
    for r in got:
        by[r.label] += r.error
    assert len(got) == 3000 and all(r.label_error == by[r.label] for r in got) and len(by) == 1001


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = Q.queries()["op12_vector_codes"](spark, "/root/testdata/sf0.01")
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == brute(rows)
