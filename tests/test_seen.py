"""The seen-store with Bloom filters, and tables by day: no false drop, few reads, restarts, retention."""
import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import ingest
from feedloom.sources.daily import DayTable
from feedloom.sources.seen import SeenStore
from feedloom.streaming import jobs as J

DAY = dt.datetime(2024, 1, 1)


def ids(spark, values):
    return spark.createDataFrame([(v, DAY + dt.timedelta(days=d, hours=5)) for v, d in values], "id string, seen_at timestamp_ntz")


def test_exact_answers_and_few_lookups(spark, tmp_path):
    rnd = random.Random(3)
    store = SeenStore(spark, str(tmp_path / "s"), buckets=4, bits=1 << 12)
    assert store.unseen(ids(spark, [("a", 0)])).count() == 1
    known = {f"k{i}": rnd.randrange(4) for i in range(1200)}
    items = list(known.items())
    for n in range(3):
        assert store.add(ids(spark, items[n::3]), "items", n)
        assert not store.add(ids(spark, [("other", 0)]), "items", n)
    asked = [f"k{rnd.randrange(2400)}" for _ in range(600)] + ["new", None, "k1", "k1"]
    batch = spark.createDataFrame([(i, n) for n, i in enumerate(asked)], "id string, n int")
    got = sorted(r.n for r in store.unseen(batch).collect())
    assert got == [n for n, i in enumerate(asked) if i not in known]
    there = sum(i in known for i in set(asked) - {None})
    assert there <= store.looked_up < there + .2 * (store.asked - there)  # the measured pass rate of new ids


def test_only_folders_that_may_hold_an_id_are_read(spark, tmp_path):
    store = SeenStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(ids(spark, [(f"d{d}-{i}", d) for d in range(5) for i in range(40)]), "items", 0)
    reads = []
    store.keys.read, whole = lambda places, f=store.keys.read: reads.append(places) or f(places=places), store.keys.read
    assert store.unseen(spark.createDataFrame([("d2-7",), ("fresh",)], "id string")).collect() == [("fresh",)]
    bucket = whole().filter("id = 'd2-7'").select(store.keys.bucket().alias("b")).first().b
    assert reads == [{"2024-01-03": [bucket]}]
    assert len({r.f.rsplit("/", 1)[0] for r in whole(places=reads[0]).select(F.input_file_name().alias("f")).collect()}) == 1


def test_filters_of_batches_are_merged(spark, tmp_path):
    store = SeenStore(spark, str(tmp_path / "s"), buckets=1)
    store.add(ids(spark, [("a", 0)]), "items", 0)
    store.add(ids(spark, [("b", 0)]), "items", 1)
    got = {r.id: r.days for r in store.probe(spark.createDataFrame([("a",), ("b",), ("c",)], "id string")).collect()}
    assert got == {"a": ["2024-01-01"], "b": ["2024-01-01"], "c": []}


def test_new_items_across_restarts_and_replays(spark, tmp_path):
    land, out, where = (str(tmp_path / n) for n in ("land", "out", "store"))
    schema = "id string, title string, fetched_at timestamp_ntz"
    for part in ([("a", "A"), ("a", "A2"), ("b", "B")], [("b", "B"), ("c", "C")], [("a", "A"), ("c", "C")]):
        spark.createDataFrame([(*r, DAY) for r in part], schema).coalesce(1).write.mode("append").parquet(land)
        J.stream_new_items(spark.readStream.schema(schema).parquet(land), where, out, checkpoint=str(tmp_path / "ck")).awaitTermination(120)
    count = lambda: sorted(r.id for r in spark.read.parquet(out).collect())
    assert count() == ["a", "b", "c"]
    again = spark.createDataFrame([("a", "A", DAY), ("z", "Z", DAY)], schema)
    assert not J.new_items_once(again, 1, SeenStore(spark, where), out)  # a replayed batch
    assert J.new_items_once(again, 3, SeenStore(spark, where), out) and count() == ["a", "b", "c", "z"]
    assert [r.id for r in J.dedupe_against_store(again, SeenStore(spark, where)).collect()] == []
    plain = str(tmp_path / "plain")
    assert J.dedupe_against_store(again, plain).count() == 2
    spark.createDataFrame([("a",)], "id string").write.parquet(plain)
    assert [r.id for r in J.dedupe_against_store(again, plain).collect()] == ["z"]


def test_a_crash_before_the_keys_count_drops_nothing(spark, tmp_path, monkeypatch):
    store = SeenStore(spark, str(tmp_path / "s"))
    with monkeypatch.context() as m:
        m.setattr(DayTable, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            store.add(ids(spark, [("a", 0)]), "items", 0)
    assert store.unseen(ids(spark, [("a", 0)])).count() == 1  # its filter is there, its key is not
    assert store.add(ids(spark, [("a", 0)]), "items", 0) and store.unseen(ids(spark, [("a", 0)])).count() == 0


def test_retention_drops_whole_days_and_rewrites_one(spark, tmp_path):
    rows = [(f"k{h}", DAY + dt.timedelta(hours=h)) for h in range(96)] + [("no time", None)]
    df = spark.createDataFrame(rows, "id string, created_at timestamp_ntz")
    t = DayTable(spark, str(tmp_path / "t"), df.schema, "id", "created_at", buckets=2)
    t.append(df.filter("hash(id) % 2 = 0"), "items", 0)
    t.append(df.filter("hash(id) % 2 <> 0"), "items", 1)
    files = lambda day: {p: open(p, "rb").read() for p in glob.glob(f"{tmp_path}/t/data/c=*/day={day}/b=*/*.parquet")}
    kept = {d: files(d) for d in ("2024-01-03", "2024-01-04", "none")}
    now = DAY + dt.timedelta(hours=96)
    assert t.retain(now - dt.timedelta(hours=60)) == {"dropped": ["2024-01-01"], "rewritten": "2024-01-02"}
    want = ingest.retention(df, now, 60)
    assert sorted(map(str, t.read().collect())) == sorted(map(str, want.collect()))
    assert {d: files(d) for d in kept} == kept and all(kept.values())  # not touched
    for n in range(2, 7):  # what is in no kept log goes
        t.append(df.limit(0), "items", n)
    assert not files("2024-01-01") and len(files("2024-01-02")) == 2
    assert t.retain(now - dt.timedelta(hours=60)) == {"dropped": [], "rewritten": "2024-01-02"}
    other = DayTable(spark, str(tmp_path / "q"), "id string, at timestamp_ntz", "id", "at", buckets=2)
    other.append(spark.createDataFrame([("k1", DAY), ("k90", DAY), ("k91", None)], other.schema), "q", 0)
    assert [r.id for r in t.orphans(other).collect()] == ["k1"]


def test_store_forgets_old_days(spark, tmp_path):
    store = SeenStore(spark, str(tmp_path / "s"), buckets=2)
    store.add(ids(spark, [("old", 0)]), "items", 0)
    store.add(ids(spark, [("new", 5)]), "items", 1)
    assert store.retain("2024-01-03 00:00:00")["dropped"] == ["2024-01-01"]
    assert [r.id for r in store.unseen(ids(spark, [("old", 0), ("new", 0)])).collect()] == ["old"]
    assert len(glob.glob(f"{tmp_path}/s/bloom/f=*")) == 1
