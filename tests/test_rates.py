"""Exact percentiles of long tails, quantile sketches per window, rates of counters with resets."""
import datetime as dt
import math
import random
from collections import defaultdict

from feedloom.operators import monitor as M

T0 = dt.datetime(2024, 1, 1)


def test_percentiles_with_an_outlier_a_million_times_the_median(spark, monkeypatch):
    monkeypatch.setattr(M, "PERCENTILE_VALUES", 20)
    rnd = random.Random(1)
    rows = [("tail", rnd.lognormvariate(0, 1)) for _ in range(3000)] + [("tail", 1e6), ("one", 5.0), (None, 1.0), (None, 3.0), (None, None)]
    rows += [("ties", float(rnd.choice([1, 1, 1, 2, 9]))) for _ in range(500)]
    shares = {"p0": 0.0001, "p50": .5, "p95": .95, "p100": 1.0}
    got = {r.g: r for r in M.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", shares).collect()}
    by = defaultdict(list)
    for g, v in rows:
        if v is not None:
            by[g].append(v)
    assert set(got) == set(by)
    for g, vs in by.items():
        vs.sort()
        assert got[g].n == len(vs) and all(got[g][k] == vs[max(0, math.ceil(q * len(vs) - 1e-9) - 1)] for k, q in shares.items())
    assert M.exact_percentiles(spark.createDataFrame([], "g string, v double"), "g", "v", shares).count() == 0


def test_no_range_with_more_values_than_stated_is_counted_up(spark, monkeypatch):
    monkeypatch.setattr(M, "PERCENTILE_VALUES", 100)
    seen = []
    monkeypatch.setattr(M, "reliable_checkpoint", lambda df, f=M.reliable_checkpoint: (lambda d: ("_m" in d.columns and seen.append(max((r._m for r in d.collect()), default=0)), d)[1])(f(df)))
    df = spark.range(20000).selectExpr("'a' as g", "pow(id, 5) + id as v")
    assert M.exact_percentiles(df, "g", "v", {"p95": .95}).first().p95 == 18999.0 ** 5 + 18999
    assert seen[0] == 20000 and seen[-1] <= 100 and len(seen) <= 4


def test_window_quantiles_are_within_the_bound(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), T0 + dt.timedelta(seconds=rnd.randrange(1200)), rnd.choice([rnd.lognormvariate(3, 2), 0.0])) for _ in range(4000)]
    rows += [("a", None, 1.0), ("a", T0, None)]
    df = spark.createDataFrame(rows, "stage string, at timestamp_ntz, s double")
    sketch = M.merge_sketches(*(M.latency_sketch(df.filter(f"pmod(hash(s, at), 3) = {k}"), "stage", "at", "s") for k in range(3)))
    assert sketch.groupBy("series", "minute", "bucket").count().filter("count > 1").count() == 0
    got = {(r.series, r.until): r for r in M.window_quantiles(sketch, {"p50": .5, "p95": .95}).collect()}
    bound = (M.GAMMA - 1) / (M.GAMMA + 1) + 1e-9
    seen = set()
    for g in "ab":
        for m in range(1, 25):
            until = T0 + dt.timedelta(minutes=m)
            vs = sorted(s for k, at, s in rows if k == g and at and s is not None and until - dt.timedelta(minutes=5) <= at < until)
            if vs:
                seen.add((g, until))
                assert got[g, until].n == len(vs)
                for k, q in (("p50", .5), ("p95", .95)):
                    exact = vs[math.ceil(q * len(vs) - 1e-9) - 1]
                    assert abs(got[g, until][k] - exact) <= bound * exact
    assert seen == set(got)


def brute_rates(rows, minutes=5):
    out, by = {}, defaultdict(list)
    for g, at, v, o in rows:
        by[g].append(((at - T0).total_seconds(), o, v))
    for g, samples in by.items():
        samples.sort()
        for end in range(60, 60 * 60, 60):
            inside = [s for s in samples if end - 60 * minutes <= s[0] < end]
            if len(inside) < 2 or inside[0][0] == inside[-1][0]:
                continue
            up = sum(b[2] if b[2] < a[2] else b[2] - a[2] for a, b in zip(inside, inside[1:]))
            sampled = inside[-1][0] - inside[0][0]
            mean = sampled / (len(inside) - 1)
            start, stop = inside[0][0] - (end - 60 * minutes), end - inside[-1][0]
            if up > 0:
                start = min(start, sampled * inside[0][2] / up)
            reach = sampled + (start if start < 1.1 * mean else mean / 2) + (stop if stop < 1.1 * mean else mean / 2)
            out[g, T0 + dt.timedelta(seconds=end)] = (len(inside), up, up * reach / sampled / (60 * minutes))
    return out


def test_counter_rates_with_resets_and_gaps(spark):
    rnd, rows = random.Random(3), []
    for g in "abc":
        v, s = rnd.randrange(50), 0.0
        for o in range(150):
            s += rnd.choice([0, 1, 7, 20, 20, 40, 400 if rnd.random() < .1 else 5])
            v = rnd.randrange(5) if rnd.random() < .05 else v + rnd.randrange(30)
            if s < 3000:
                rows.append((g, T0 + dt.timedelta(seconds=s), float(v), o))
    rows += [("lone", T0, 3.0, 0), ("same", T0, 3.0, 0), ("same", T0, 5.0, 1)]
    df = spark.createDataFrame(rows + [(None, T0, 1.0, 0), ("a", None, 1.0, 0), ("a", T0, None, 0)], "g string, at timestamp_ntz, v double, o int")
    got = {(r.series, r.until): (r.n, r.increase, r.per_second) for r in M.counter_rates(df, "g", "at", "v", "o").collect()}
    want = brute_rates(rows)
    assert set(got) == set(want) and all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-9 for k in want)
