"""J1 by ticks: due feeds only, cooldown, forced requests, no document twice, restart, crash."""
import datetime as dt

import pytest

from feedloom.sources.keyed import KeyedTable
from feedloom.streaming import poll as P

T0 = dt.datetime(2024, 1, 1)


def rss(*guids):
    return "<rss version='2.0'><channel>" + "".join(f"<item><guid>{g}</guid><title>T{g}</title><link>https://x/{g}</link></item>" for g in guids) + "</channel></rss>"


class World:
    """Tables that change between ticks."""

    def __init__(self, spark, path):
        self.spark, self.path, self.docs, self.asked = spark, path, [], []
        self.on = {"a": True, "b": True, "off": False}

    def landed(self):
        return self.spark.createDataFrame(self.docs, "feed_url string, path string, doc string")

    def feeds(self):
        return self.spark.createDataFrame(list(self.on.items()), "feed_url string, enabled boolean")

    def requests(self):
        return self.spark.createDataFrame(self.asked, "feed_url string, requested_at timestamp_ntz")

    def table(self):
        return P.poll_table(self.spark, f"{self.path}/poll")

    def tick(self, n, minute):
        return P.poll_once(n, T0 + dt.timedelta(minutes=minute), self.landed(), self.feeds(), self.requests(), self.table(), f"{self.path}/out", cooldown_minutes=30)

    def got(self):
        return sorted((r.tick, r.guid) for r in P.items(self.spark, f"{self.path}/out", self.table()).collect())


def test_ticks(spark, tmp_path):
    w = World(spark, tmp_path)
    w.docs = [("a", "a/1", rss(1, 2)), ("b", "b/1", "<rss></rss>"), ("off", "off/1", rss(9))]
    assert w.tick(0, 0) and not w.tick(0, 0)
    assert w.got() == [(0, "1"), (0, "2")]
    state = {r.k: (r.failure_count, r.down_until) for r in w.table().read().collect() if r.k.startswith("feed:")}
    assert state == {"feed:a": (0, None), "feed:b": (5, T0 + dt.timedelta(minutes=30))}
    w.docs += [("a", "a/2", rss(3)), ("b", "b/2", rss(4))]
    w.tick(1, 15)  # b cools down
    assert w.got()[2:] == [(1, "3")]
    w.asked = [("b", T0 + dt.timedelta(minutes=16)), (" off ", T0 + dt.timedelta(minutes=17)), ("a", T0 + dt.timedelta(hours=9))]
    w.tick(2, 20)  # requests ignore cooldown and the switch; one is not yet made
    assert w.got()[3:] == [(2, "4"), (2, "9")]
    w.docs += [("off", "off/2", rss(10))]
    w.tick(3, 40)  # a request is done once
    assert len(w.got()) == 5


def test_a_tick_that_broke_off_runs_again(spark, tmp_path, monkeypatch):
    w = World(spark, tmp_path)
    w.docs = [("a", "a/1", rss(1))]
    w.tick(0, 0)
    w.docs += [("a", "a/2", rss(2))]
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            w.tick(1, 15)
    assert w.got() == [(0, "1")]
    w.docs += [("a", "a/3", rss(3))]
    assert w.tick(1, 15) and w.got() == [(0, "1"), (1, "2"), (1, "3")]


def test_the_stream_of_ticks_and_its_restart(spark, tmp_path):
    w = World(spark, tmp_path)
    w.docs = [("a", "a/1", rss(1))]

    def some_ticks(n):
        before = w.table().state()["batches"].get(P.APP, -1)
        q = P.stream_polls(spark, T0, 15, w.landed, w.feeds, None, f"{tmp_path}/poll", f"{tmp_path}/out", f"{tmp_path}/ck").trigger(processingTime="0 seconds").start()
        end = dt.datetime.now() + dt.timedelta(seconds=120)
        while w.table().state()["batches"].get(P.APP, -1) < before + n and dt.datetime.now() < end:
            q.awaitTermination(1)
        q.stop()
        q.awaitTermination(60)
    some_ticks(2)
    done = w.table().state()["batches"][P.APP]
    assert w.got() == [(0, "1")]
    w.docs += [("a", "a/2", rss(2))]
    some_ticks(2)  # from the next offset on
    got = w.got()
    assert got[0] == (0, "1") and len(got) == 2 and got[1][0] > done and got[1][1] == "2"
    times = {r.tick: r.fetched_at for r in P.items(spark, f"{tmp_path}/out", w.table()).collect()}
    assert times == {t: T0 + dt.timedelta(minutes=15 * t) for t, _ in got}
