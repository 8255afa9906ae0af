"""J4 with timers: leases that run out, quarantine, late and shuffled events, restart; against the batch fold."""
import datetime as dt
import json
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.operators import lifecycle as L
from feedloom.streaming import queue as Q

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "item_id string, ts timestamp_ntz, seq long, action string, worker string, lease_until timestamp_ntz, reason string"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def event(item, minute, action, worker="w", reason="", lease=2, seq=0):
    return (item, at(minute), seq, action, worker, at(minute + lease) if action == "claim" else None, reason)


class Stream:
    """A landing folder and a stream that is restarted for every part."""

    def __init__(self, spark, path, **how):
        self.spark, self.path, self.how, self.n = spark, path, how, 0

    def feed(self, events):
        """The rows that come out when these events land."""
        self.spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(str(self.path / "land"))
        src = self.spark.readStream.schema(SCHEMA).parquet(str(self.path / "land"))
        rows = []
        q = (Q.lease_queue(src, late="0 seconds", **self.how).writeStream.foreachBatch(lambda b, _: rows.extend(b.collect()))
             .outputMode("update").option("checkpointLocation", str(self.path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return [(r.item_id, r.state, r.lease_owner, r.delivery_count, r.last_error) for r in rows]


def test_a_lease_that_ran_out_is_queued_without_an_event(spark, tmp_path):
    s = Stream(spark, tmp_path, max_attempts=3)
    assert s.feed([event("x", 0, "enqueue"), event("x", 1, "claim", "w1", seq=1)])[-1] == ("x", "LEASED", "w1", 1, "")
    assert ("x", "QUEUED", None, 1, "") in s.feed([event("y", 4, "enqueue")])  # another item's event moves the clock, after a restart
    # its old owner may still complete as long as nobody else has claimed
    assert s.feed([event("x", 5, "complete", "w1")])[-1] == ("x", "DONE", None, 1, "")
    assert s.feed([event("", 9, "tick")]) == []


def test_the_third_delivery_is_quarantined(spark, tmp_path):
    s = Stream(spark, tmp_path, max_attempts=3)
    s.feed([event("x", 0, "enqueue")])
    for n in (1, 2):
        s.feed([event("x", 2 * n, "claim", "w")])
        assert s.feed([event("x", 2 * n + 1, "release", "w", " llm status: 503 ")])[-1] == ("x", "QUEUED", None, n, "analysis_failed: llm status: 503")
    s.feed([event("x", 6, "claim", "w")])
    assert s.feed([event("x", 7, "release", "w", "llm status: 503")])[-1] == ("x", "DONE", None, 3, "poison_item: analysis_failed: llm status: 503")
    s.feed([event("z", 8, "enqueue"), event("z", 8, "claim", "w", seq=1)])
    assert s.feed([event("z", 9, "release", "w", "Missing required analyzed fields: role")])[-1][1] == "DONE"


def test_items_are_forgotten_after_the_retention(spark, tmp_path):
    s = Stream(spark, tmp_path, ttl_hours=1)
    s.feed([event("x", 0, "enqueue"), event("x", 1, "claim", "w", seq=1)])
    s.feed([event("", 200, "tick")])
    assert s.feed([event("x", 201, "complete", "w")]) == []  # no item of that name any more
    assert s.feed([event("x", 202, "enqueue")])[-1] == ("x", "QUEUED", None, 0, "")


def test_an_old_item_is_shown_once_before_it_is_forgotten(spark):
    log = spark.createDataFrame([event("old", 0, "enqueue"), event("new", 6000, "enqueue")], SCHEMA)
    for ttl in (1, 10 ** 6):
        assert sorted((r.item_id, r.state) for r in Q.replay(log, ttl_hours=ttl).collect()) == [("new", "QUEUED"), ("old", "QUEUED")]


def log_rows(rnd, n):
    rows = []
    for seq in range(n):
        item, minute = rnd.choice("abcdefgh"), rnd.randrange(0, 120)
        action = rnd.choice(["enqueue", "claim", "claim", "complete", "release", "release", "fail"])
        reason = rnd.choice(["", " why ", "missing required analyzed fields"]) if action in ("release", "fail") else ""
        rows.append((item, at(minute), seq, action, rnd.choice(["w1", "w2"]), at(minute + rnd.choice([1, 5, 30])) if action == "claim" else None, reason))
    return rows


@pytest.mark.parametrize("max_attempts", [None, 2])
def test_replay_of_a_shuffled_log_is_the_batch_fold(spark, max_attempts):
    rows = log_rows(random.Random(5), 300)
    log = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for item, t, seq, a, w, lease, reason in sorted(rows, key=lambda r: r[1:3]):
        want[item] = L.queue_step(want.get(item), item, a, w, t, lease, reason, max_attempts)
    got = {r.item_id: r for r in Q.replay(log, max_attempts=max_attempts).collect()}
    assert set(got) == {i for i, s in want.items() if s}
    end = max(r[1] for r in rows) + dt.timedelta(hours=1)
    for i, s in want.items():
        if s["state"] == "LEASED" and s["lease_until"] <= end:
            s.update(state="QUEUED", lease_owner=None, lease_until=None)
        assert {f: getattr(got[i], f) for f in Q.FIELDS} == {f: s[f] for f in Q.FIELDS}
    if max_attempts is None:
        batch = {r.item_id: (r.delivery_count, r.done_at, r.last_error) for r in L.queue_snapshot(log).collect()}
        assert batch == {i: (r.delivery_count, r.done_at, r.last_error) for i, r in got.items()}


def test_replay_of_an_empty_log(spark):
    assert Q.replay(spark.createDataFrame([], SCHEMA)).count() == 0


class Store:
    """A state store in memory that counts the calls."""

    def __init__(self):
        self.calls, self.value, self.values, self.timers = 0, None, [], set()

    def call(self, fn):
        def counted(*a):
            self.calls += 1
            return fn(*a)
        return counted

    def getValueState(self, *_):
        return SimpleNamespace(get=self.call(lambda: self.value), update=self.call(lambda v: setattr(self, "value", v)),
                               clear=self.call(lambda: setattr(self, "value", None)))

    def getListState(self, *_):
        return SimpleNamespace(get=self.call(lambda: iter(list(self.values))), appendValue=self.call(self.values.append), clear=self.call(self.values.clear))

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.discard(t)


@pytest.mark.parametrize("n", [1, 300])
def test_an_item_costs_few_calls_of_the_store_whatever_its_events(n):
    """a call is a round trip; waiting events are one value, and events come in in any order."""
    store, queue = Store(), Q.LeaseQueue(10 ** 9, None, True)
    queue.init(store)
    clock = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    events = [{"ts": i * 1000, "seq": i, "action": "claim" if i > 1 else "enqueue", "worker": f"w{i}", "lease_until": i * 1000} for i in range(n, 0, -1)]
    assert not list(queue.handleInputRows(("x",), iter([pd.DataFrame({"ts": [e["ts"] for e in events], "event": [json.dumps(e) for e in events]})]), clock(0)))
    assert store.calls == 4 and len(store.values) == 1 and store.timers == {1}
    out = list(queue.handleExpiredTimer(("x",), clock(n), SimpleNamespace(getExpiryTimeInMs=lambda: 1)))
    got = json.loads(out[0].control[0])
    assert len(out) == 1 and (got["item_id"], got["delivery_count"], got["updated_at"]) == ("x", n - 1, n * 1000)
    assert store.calls <= 9 and not store.values
