"""The lease queue as keyed state with timers.

Each item's control record is one value in a RocksDB state store.  Events are
applied with the transition of the batch fold; timers on the event-time
watermark do what no event says: a lease that has run out puts its item back
into the queue, and an item untouched for the retention time is forgotten.

Every call into the state store is a round trip, so an item costs a fixed few
a micro-batch whatever its number of events: the control record also holds the
timers that are set, and events that wait are kept as JSON arrays of up to
CHUNK events.  Events and controls go in and out as JSON, one column each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedloom.operators import lifecycle as L
from feedloom.session import scratch_path, ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are microseconds since the epoch in state and on the way.
FIELDS = ["state", "lease_owner", "lease_until", "delivery_count", "enqueued_at", "done_at", "last_error", "updated_at"]
_TIMES = ("lease_until", "enqueued_at", "done_at", "updated_at")
_TYPES = {f: "long" if f in _TIMES else "int" if f == "delivery_count" else "string" for f in FIELDS}
_FIELDS_SCHEMA = ", ".join(f"{f} {t}" for f, t in _TYPES.items())
#: The control's fields (without a ``state``: no item yet) and its timers in milliseconds.
CONTROL_SCHEMA = f"{_FIELDS_SCHEMA}, forget_at long, lease_at long, wait_at long"
WAITING_SCHEMA = "events string"
OUT_SCHEMA = f"item_id string, {_FIELDS_SCHEMA}"
#: Waiting events in one value of the state store.
CHUNK = 10_000


def _ms(micros: int) -> int:
    """The first whole millisecond that is not before a time."""
    return -(-micros // 1000)


class LeaseQueue(StatefulProcessor):
    """One item's queue control.

    ``hold`` keeps events in the state store until the watermark passes them, so
    that they are applied in (ts, seq) order however they arrive; without it a
    micro-batch's events of an item are applied at once, in that order."""

    def __init__(self, ttl_ms: int, max_attempts: int | None, hold: bool):
        self.ttl_ms, self.max_attempts, self.hold = ttl_ms, max_attempts, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.control = handle.getValueState("control", CONTROL_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def _keep(self, events: list[str]) -> None:
        for i in range(0, len(events), CHUNK):
            self.waiting.appendValue((f"[{','.join(events[i:i + CHUNK])}]",))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        due, first = [], None
        for pdf in rows:
            later = []
            for ts, event in zip(pdf["ts"].tolist(), pdf["event"].tolist()):
                if self.hold and ts > now * 1000:
                    later.append(event)
                    first = ts if first is None else min(first, ts)
                else:
                    due.append(json.loads(event))
            self._keep(later)
        held = self.control.get()
        times = [t for t in (held and held[-1], None if first is None else _ms(first)) if t is not None]
        yield from self._advance(key[0], held, due, now, not self.hold, min(times, default=None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held, due = self.control.get(), []
        wait_at = held and held[-1]
        if wait_at is not None and wait_at <= now:
            rest = []
            for (chunk,) in self.waiting.get():
                for e in json.loads(chunk):
                    (due if e["ts"] <= now * 1000 else rest).append(e)
            self.waiting.clear()
            self._keep([json.dumps(e) for e in rest])
            wait_at = min((_ms(e["ts"]) for e in rest), default=None)
        yield from self._advance(key[0], held, due, now, True, wait_at, fired=expiredTimerInfo.getExpiryTimeInMs())

    def _advance(self, iid, held, due, now, seen, wait_at, fired=None) -> Iterator[pd.DataFrame]:
        before = None if held is None or held[0] is None else {"item_id": iid, **dict(zip(FIELDS, held))}
        s = None if before is None else dict(before)
        for e in sorted(due, key=lambda e: (e["ts"], e["seq"])):
            s = L.queue_step(s, iid, *(e.get(k) for k in ("action", "worker", "ts", "lease_until", "reason")), self.max_attempts)
        forgotten = s is not None and s["updated_at"] + self.ttl_ms * 1000 <= now * 1000
        left = None if forgotten else s
        timers = (*self._timers(left, now), wait_at)
        self._schedule({*held[len(FIELDS):]} if held else set(), {*timers}, fired)
        new = (*((left[f] for f in FIELDS) if left else [None] * len(FIELDS)), *timers)
        if left is None and wait_at is None:
            if held is not None:
                self.control.clear()
        elif new != held:
            self.control.update(new)
        if s is not None and ((seen and not forgotten) or s != before):
            shown = dict(s)
            if s["state"] == "LEASED" and s["lease_until"] is not None and s["lease_until"] <= now * 1000:
                # the control keeps the owner, who may still complete before another worker claims
                shown.update(state="QUEUED", lease_owner=None, lease_until=None)
            yield pd.DataFrame({"control": [json.dumps(shown)]})

    def _timers(self, s, now) -> tuple[int | None, int | None]:
        """When the item is forgotten and when its lease runs out, if that is to come."""
        if s is None:
            return None, None
        forget = _ms(s["updated_at"] + self.ttl_ms * 1000)
        lease = _ms(s["lease_until"]) if s["state"] == "LEASED" and s["lease_until"] is not None else now
        return forget if forget > now else None, lease if lease > now else None

    def _schedule(self, known: set, wanted: set, fired: int | None) -> None:
        for t in known - wanted - {None, fired}:
            self.handle.deleteTimer(t)
        for t in wanted - known - {None}:
            self.handle.registerTimer(t)

    def close(self) -> None:
        pass


def lease_queue(log: DataFrame, ttl_hours: int = 168, late: str = "1 hour", max_attempts: int | None = None, hold: bool = False) -> DataFrame:
    """One row per item and micro-batch that changed it, its control then.

    ``max_attempts`` turns on F4: a release of the last allowed delivery, or one
    for missing required fields, quarantines the item.  A lease that ran out by
    the watermark shows as QUEUED without an event.  Rows without an item (clock
    ticks) only move the watermark; events behind it are dropped.
    """
    spark = log.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("ts", "lease_until")}
    event = F.to_json(F.struct(micros["ts"], F.col("seq").cast("long").alias("seq"), "action", "worker", micros["lease_until"], "reason"))
    src = log.select(F.coalesce("item_id", F.lit("")).alias("item_id"), F.col("ts").cast("timestamp").alias("at"), micros["ts"],
                     event.alias("event")).withWatermark("at", late)
    out = src.groupBy("item_id").transformWithStateInPandas(
        statefulProcessor=LeaseQueue(ttl_hours * 3600 * 1000, max_attempts, hold), outputStructType="control string", outputMode="Update", timeMode="EventTime")
    return out.select(F.from_json("control", OUT_SCHEMA).alias("c")).select("c.*").select("item_id", *(F.timestamp_micros(f).alias(f) if f in _TIMES else F.col(f) for f in FIELDS))


def replay(log: DataFrame, late_hours: int = 1, batches: int = 4, ttl_hours: int = 10 ** 6, **how) -> DataFrame:
    """The queue stream over a stored log, landed in ``batches`` parts that interleave in time,
    with a last tick that lets the watermark pass all events.  One row per item: its last.
    No item is forgotten meanwhile, as in the batch fold."""
    spark: SparkSession = log.sparkSession
    land, out, state = (scratch_path(spark) for _ in range(3))
    cols = ["item_id", "ts", "seq", "action", "worker", "lease_until", "reason"]
    events = log.select(*cols)
    for k in range(batches):  # files land one after another; each holds every ``batches``-th event of all times
        events.filter(F.pmod(F.xxhash64("item_id", "seq"), F.lit(batches)) == k).write.parquet(f"{land}/part={k}")
    last = events.agg(F.max("ts")).first()[0]
    if last is None:
        return spark.createDataFrame([], spark.createDataFrame([], OUT_SCHEMA).select(
            "item_id", *(F.timestamp_micros(f).alias(f) if f in _TIMES else F.col(f) for f in FIELDS)).schema)
    tick = events.limit(1).select(F.lit("").alias("item_id"), (F.lit(last) + F.make_dt_interval(hours=F.lit(2 * late_hours))).alias("ts"),
                                  F.lit(0).cast("long").alias("seq"), F.lit("tick").alias("action"), F.lit("").alias("worker"),
                                  F.lit(None).cast("timestamp_ntz").alias("lease_until"), F.lit("").alias("reason"))
    tick.write.parquet(f"{land}/part={batches}")
    # all parts may be one micro-batch: no event is late, whatever the order of the files
    src = spark.readStream.schema(events.schema).parquet(f"{land}/part=*")

    def run(b, bid):
        b.withColumn("batch", F.lit(bid)).write.mode("overwrite").parquet(f"{out}/batch_id={bid}")
    queue = lease_queue(src, late=f"{late_hours} hours", ttl_hours=ttl_hours, hold=True, **how)
    q = queue.writeStream.foreachBatch(run).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{out}/batch_id=*")
    top = rows.groupBy("item_id").agg(F.max_by(F.struct(*FIELDS), "batch").alias("s"))
    return top.select("item_id", "s.*")
