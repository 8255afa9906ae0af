"""The keyed table: merge on read, deltas, compaction, replays, crashes."""
import glob
import random

import pytest

from feedloom.sources.keyed import KEEP, KeyedTable

SCHEMA = "id string, n long"


def table(spark, path, **how):
    return KeyedTable(spark, str(path), SCHEMA, "id", **{"buckets": 4, "compact_after": 3, **how})


def rows(spark, values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def content(t):
    got = [(r.id, r.n) for r in t.read().collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_a_model_run(spark, tmp_path):
    rnd, want, t = random.Random(1), {}, table(spark, tmp_path / "t")
    assert content(t) == {}
    for batch in range(9):
        change = {f"k{rnd.randrange(30)}": rnd.randrange(1000) for _ in range(rnd.choice([0, 1, 12]))}
        if batch % 4 == 3:
            assert t.upsert(rows(spark, change), "app", batch, gone=True)
            want = {k: v for k, v in want.items() if k not in change}
        else:
            assert t.upsert(rows(spark, change), "app", batch)
            want |= change
        assert not t.upsert(rows(spark, {"k0": -1}), "app", batch)  # a replayed batch
        assert content(table(spark, tmp_path / "t")) == want
        assert len(t.state()["deltas"]) <= 3 and len(t.commits()) <= KEEP


def test_bytes_written_grow_with_the_updates(spark, tmp_path):
    t = table(spark, tmp_path / "t", compact_after=50)
    t.upsert(rows(spark, {f"k{i}": i for i in range(2000)}), "app", 0)
    t.compact()
    count = lambda c: spark.read.parquet(f"{tmp_path}/t/data/c={c}").count()
    assert count(1) == 2000 and t.state()["deltas"] == []
    for batch in range(1, 4):
        t.upsert(rows(spark, {"k7": batch}), "app", batch)
        at = t.state()["commit"]
        assert count(at) == 1 and len(glob.glob(f"{tmp_path}/t/data/c={at}/b=*/*.parquet")) == 1
    base = t.state()["base"]
    t.compact()  # one bucket of four is written anew
    now = t.state()
    assert sum(now["base"][b] != c for b, c in base.items()) == 1 and 300 < count(now["commit"]) < 700
    assert content(t)["k7"] == 3 and len(content(t)) == 2000
    for batch in range(4, 4 + KEEP + 1):  # old versions go
        t.upsert(rows(spark, {"k8": batch}), "app", batch)
    kept = {int(p.rsplit("=", 1)[1]) for p in glob.glob(f"{tmp_path}/t/data/c=*")}
    assert kept == {*t.state()["deltas"], *t.state()["base"].values()}


def test_a_crash_before_the_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    t.upsert(rows(spark, {"a": 1}), "app", 0)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            t.upsert(rows(spark, {"a": 2, "b": 2}), "app", 1)
    assert content(table(spark, tmp_path / "t")) == {"a": 1} and not t.committed("app", 1)
    assert t.upsert(rows(spark, {"a": 3}), "app", 1) and content(t) == {"a": 3}
    assert t.upsert(rows(spark, {"c": 1}), "other", 0) and content(t) == {"a": 3, "c": 1}  # applications count their own batches


def test_two_writers_do_not_overwrite_a_commit(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(rows(spark, {"a": 1}), "app", 0)
    with pytest.raises(FileExistsError):
        t.files.create(f"{tmp_path}/t/log/0.json", "{}")
