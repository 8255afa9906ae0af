"""Hard negatives against brute force; the pruning against exact scores."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import hard_negatives as H
from feedloom.llm import queries as Q


def brute(rows, scale=256, anchors=100, positives=5, negatives=10, low=30, high=90):
    """rows: (vec_id, embedding, label), ids unique or null."""
    last = lambda i: (i is None, i or 0)
    rows = [(i, [math.floor(scale * x) for x in v], g) for i, v, g in rows if g is not None and v]
    out = []
    for i, q, g in rows:
        if i is None or i % anchors:
            continue
        others = [(sum(a * b for a, b in zip(q, v)), j, h) for j, v, h in rows if j != i and len(v) == len(q)]
        same = sorted(((s, j) for s, j, h in others if h == g), key=lambda r: (-r[0], last(r[1])))
        for s, j in same[:positives]:
            fit = sorted(((t, n) for t, n, h in others if h != g and low * s <= 100 * t <= high * s), key=lambda r: (-r[0], last(r[1])))
            out += [(i, j, k + 1, n, s, t) for k, (t, n) in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def shown(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def clustered(rnd, n, dim, labels=4):
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [(c + rnd.gauss(0, .2)) * rnd.choice([.05, .2, .2, 1.]) for c in rnd.choice(centres)], rnd.randrange(labels)) for i in range(n)]


def group(rows):
    rows = sorted(rows, key=lambda r: -sum(x * x for x in r[1]))
    return H.Group([pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([str(r[2]) for r in rows]),
                                     pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["vid", "label", "v"])])


@pytest.mark.parametrize("same", [True, False])
def test_a_group_is_searched_exactly_and_pruned(same):
    rnd = random.Random(7)
    rows = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in clustered(rnd, 5000, 6)]
    rows += [(6000 + i, [0] * 6, i % 4) for i in range(5)]
    g, at = group(rows), rnd.sample(range(5000), 40)
    q = np.array([rows[i][1] for i in at])
    exact = np.array([r[1] for r in rows]) @ q.T
    pruned = 0
    plain = H.Bucket.candidates
    H.Bucket.candidates = lambda self, *a: (lambda r: (sizes.append((len(self.v), len(self.v) if r is None else len(r))), r)[1])(plain(self, *a))
    for sizes in ([],):
        lo, hi = np.full((40, 2), H.FAR), np.full((40, 2), -H.FAR)
        for c, i in enumerate(at):
            s = np.sort(exact[:, c])
            lo[c], hi[c] = [s[-30], -H.FAR], [s[-3], s[1000]]
        hi[0, 0], lo[1] = lo[0, 0] - 1, [H.FAR, H.FAR]  # an empty band, an anchor without any
        hi[1] = -H.FAR
        best = g.search(6, q, np.array(at), np.array([g.label[str(rows[i][2])] for i in at]), lo, hi, same, 4)
        got = sorted(zip(best.key.tolist(), best.score.tolist(), best.vid.tolist()))
        want = []
        for c, i in enumerate(at):
            for band in range(2):
                fit = [(-exact[r, c], rows[r][0]) for r in range(len(rows)) if lo[c, band] <= exact[r, c] <= hi[c, band]
                       and rows[r][0] != i and (rows[r][2] == rows[i][2]) == same]
                want += [(2 * c + band, -s, j) for s, j in sorted(fit)[:4]]
        assert got == sorted(want)
        pruned += sum(a - b for a, b in sizes)
    H.Bucket.candidates = plain
    one = g.search(6, q[:1], np.array(at[:1]), np.array([0]), np.array([[np.sort(exact[:, 0])[-5]]]), np.array([[H.FAR]]), False, 4)
    assert len(one.key) <= 5


def test_feasible_ranges_hold_every_row_of_the_band():
    rng = np.random.default_rng(3)
    v = rng.integers(-100, 100, (800, 5)) * rng.choice([1, 3], (800, 1))
    v[:3] = 0
    b = H.Bucket(v, np.arange(800), np.zeros(800, bool), np.zeros(800, int))
    q = np.vstack([rng.integers(-100, 100, (30, 5)), np.zeros((1, 5), int), v[10:12]])
    size = np.sqrt((q ** 2.).sum(axis=1))
    unit, score = q / np.where(size > 0, size, 1)[:, None], v @ q.T
    for lo, hi in ((.5, 1), (.9, .95), (-.2, .1), (-1, -.6), (0, 0)):
        low, high = np.floor(lo * score.max(axis=0)), np.floor(hi * score.max(axis=0))
        possible, focus, a, e = b.feasible(unit, size, low, high)
        for c in range(len(q)):
            inside = np.flatnonzero((score[:, c] >= low[c]) & (score[:, c] <= high[c]))
            assert possible[c] or not len(inside)
            for f, x, y in zip(focus[c], a[c], e[c]):
                assert ((b.unit[inside, f] >= x) & (b.unit[inside, f] <= y)).all()
    # an anchor much like its sought rows leaves most others out
    possible, focus, a, e = b.feasible(unit[:1], size[:1], np.array([.98 * size[0] * b.longest]), np.array([float(H.FAR)]))
    rows = b.candidates(focus[0], a[0], e[0])
    assert rows is not None and len(rows) < 200


@pytest.mark.parametrize("group_rows", [60, 1000])
def test_against_brute_force(spark, monkeypatch, group_rows):
    rnd = random.Random(11)
    monkeypatch.setattr(H, "GROUP_ROWS", group_rows)
    rows = clustered(rnd, 700, 8) + [(1000 + i, [rnd.gauss(0, 1) for _ in range(5)], i % 3) for i in range(130)]
    rows += [(3000 + i, rows[40][1], rows[40][2]) for i in range(60)] + [(4000 + i, rows[40][1], 9) for i in range(60)]  # copies
    rows += [(7000 + i, [0.] * 8, i % 2) for i in range(12)] + [(None, rows[20][1], 2), (None, rows[20][1], 1)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, grp int, row int").repartition(3)
    got = H.mine(df, anchors=20)
    assert shown(got) == brute(rows, anchors=20) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1., 0.], 1), (1, [.9, .1], 1), (2, [.5, 0.], 2), (3, [.5, .5], 3), (None, [.5, 0.], 2)]
    bad = [(100, [1., 0.], None), (4, None, 1), (5, [None, 1.], 2), (6, [nan, 0.], 2), (7, [inf, 0.], 2), (8, [.5, 0., 0.], 2), (9, [], 2)]
    schema = "vec_id long, embedding array<double>, label int"
    assert shown(H.mine(spark.createDataFrame(good + bad, schema))) == brute(good) != []
    twice = shown(H.mine(spark.createDataFrame(good + good[:1] + good[2:3], schema)))  # one anchor, row 2 in the list twice
    assert [r[:4] for r in twice] == [(0, 1, 1, 2), (0, 1, 2, 2), (0, 1, 3, 3), (0, 1, 4, None)]
    assert H.mine(spark.createDataFrame([], schema)).count() == 0
    huge = [(0, [3e38, 0.], 1), (1, [3e38, 0.], 1), (2, [3e30, 0.], 2), (3, [2000., 0.], 2)]
    assert [r[3] for r in shown(H.mine(spark.createDataFrame(huge, schema)))] == [3]


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    assert shown(Q.queries()["op11_hard_negatives"](spark, "/root/testdata/sf0.01")) == brute(moved) != []
