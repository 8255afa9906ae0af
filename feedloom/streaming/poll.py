"""Polling as a stream of ticks over due feeds.

A tick is a poll time (a row of Spark's micro-batch rate source, whose offsets
are kept in the stream's checkpoint).  At every tick the feeds that are due
(E5: enabled, out of cooldown, or asked for) are polled: their landed documents
that no tick has read yet become raw items in the tick's own folder.  A feed
whose documents hold no entry, or of which nothing new has landed while it was
asked for, has failed and cools down (F5).  What was read, the feeds' state and
the requests that are done are one commit of one keyed table, so a tick that
broke off runs again as if it never had, and one that runs again does nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import ingest
from feedloom.operators import lifecycle as L
from feedloom.session import ts_lit
from feedloom.sources import feeds as S
from feedloom.sources.keyed import KeyedTable

#: Keys are ``file:<path>``, ``feed:<url>`` and ``asked:<url>@<time>``.
POLL_SCHEMA = "k string, at timestamp_ntz, failure_count int, down_until timestamp_ntz"
APP = "poll"


def poll_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, POLL_SCHEMA, "k")


def _keys(table: DataFrame, kind: str, name: str, *more: str) -> DataFrame:
    return table.filter(F.col("k").startswith(f"{kind}:")).select(F.substring("k", len(kind) + 2, 2 ** 31 - 1).alias(name), *more)


def poll_once(tick: int, now, landed: DataFrame, feeds: DataFrame, requests: DataFrame | None, table: KeyedTable, out_dir: str,
              cooldown_minutes: int = 30, max_requests: int = 20) -> bool:
    """One tick.  ``landed`` has ``feed_url, path, doc``; ``feeds`` ``feed_url,
    enabled``; ``requests`` ``feed_url, requested_at``.  False if the tick was done before."""
    if table.committed(APP, tick):
        return False
    spark, stamp = table.spark, ts_lit(now)
    known = table.read()
    asked = None
    if requests is not None:
        key = F.concat(F.trim("feed_url"), F.lit("@"), F.coalesce(F.col("requested_at").cast("string"), F.lit("")))
        asked = requests.withColumn("_key", key).join(_keys(known, "asked", "_key"), "_key", "left_anti").filter(F.col("requested_at").isNull() | (F.col("requested_at") <= stamp))
    due = ingest.due_feeds(feeds, _keys(known, "feed", "feed_url", "down_until"), asked.select("feed_url", "requested_at") if asked is not None else None, now,
                           max_requests).persist()
    new = landed.join(due, "feed_url").join(_keys(known, "file", "path"), "path", "left_anti").persist()
    try:
        entries = S.feed_items(new.select("feed_url", "path", "doc"), keep=("feed_url", "path")).withColumnRenamed("link", "url").withColumnRenamed("position", "pos")
        out = f"{out_dir.rstrip('/')}/tick={tick}"
        ingest.raw_items(entries, now).write.mode("overwrite").parquet(out)
        full = entries.groupBy("feed_url").agg(F.count(F.lit(1)).alias("n"))
        seen = new.groupBy("feed_url").agg(F.count(F.lit(1)).alias("files"))
        polled = due.join(seen, "feed_url", "left").join(full, "feed_url", "left").filter(F.col("files").isNotNull() | F.col("force"))
        state = L.feed_state(polled.select("feed_url", stamp.alias("ts"), F.coalesce(F.col("n") > 0, F.lit(False)).alias("ok")), cooldown_minutes)
        row = lambda k, at, count=F.lit(0), until=F.lit(None): (k.alias("k"), at.alias("at"), count.cast("int").alias("failure_count"),
                                                                until.cast("timestamp_ntz").alias("down_until"))
        rows = new.select(*row(F.concat(F.lit("file:"), "path"), stamp)).distinct().unionByName(
            state.select(*row(F.concat(F.lit("feed:"), "feed_url"), F.col("updated_at"), F.col("failure_count"), F.col("down_until"))))
        if asked is not None:
            done = asked.withColumn("_f", F.trim("feed_url")).join(due.filter("force").select(F.col("feed_url").alias("_f")), "_f", "left_semi")
            rows = rows.unionByName(done.select(*row(F.concat(F.lit("asked:"), "_key"), stamp)).distinct())
        return table.upsert(rows, APP, tick)
    finally:
        new.unpersist()
        due.unpersist()


def items(spark: SparkSession, out_dir: str, table: KeyedTable) -> DataFrame:
    """The raw items of all committed ticks."""
    last = table.state()["batches"].get(APP, -1)
    done = [n for n in table.files.names(out_dir) if n.startswith("tick=") and int(n[5:]) <= last]
    return spark.read.option("basePath", out_dir).parquet(*[f"{out_dir.rstrip('/')}/{n}" for n in done])


def stream_polls(spark: SparkSession, start, every_minutes: int, landed: Callable[[], DataFrame], feeds: Callable[[], DataFrame],
                 requests: Callable[[], DataFrame] | None, table_path: str, out_dir: str, checkpoint: str, cooldown_minutes: int = 30):
    """The polling loop's writer (not started): one tick a micro-batch, ``every_minutes`` apart from ``start`` on (UTC).
    Tables are loaded anew at every tick."""
    at = dt.datetime.fromisoformat(str(start)).replace(tzinfo=dt.timezone.utc)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1) \
        .option("startTimestamp", int(at.timestamp() * 1000)).option("advanceMillisPerBatch", every_minutes * 60_000).load()

    def run(batch, batch_id):
        for r in batch.select(F.unix_millis("timestamp").alias("ms")).collect():  # one row
            now = dt.datetime.fromtimestamp(r.ms / 1000, dt.timezone.utc).replace(tzinfo=None)
            poll_once(batch_id, now, landed(), feeds(), requests() if requests else None, poll_table(spark, table_path), out_dir, cooldown_minutes)
    return ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
