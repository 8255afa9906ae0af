"""Structured Streaming versions of the continuous jobs.

The batch operators are reused on streaming DataFrames; state lives in the
state store (checkpointed under the cluster's ``spark.checkpoint.dir``),
late data is bounded by watermarks, and sinks are idempotent per batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import ingest
from feedloom.operators import lifecycle as L
from feedloom.operators import monitor as M
from feedloom.operators import publish as P
from feedloom.sources import feeds as S
from feedloom.sources.keyed import KeyedTable
from feedloom.sources.seen import SeenStore
from feedloom.streaming import outbox, queue


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-stream checkpoint folder inside ``spark.checkpoint.dir``, which
    must be set: a folder that changes with every start would replay all."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir, or give the stream a checkpoint location")
    return f"{folder.rstrip('/')}/streams/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; any other storage error is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ---------------------------------------------------------------- J1
def stream_items(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Landed feed documents (one file per document) -> RawItem rows.

    ``fetched_at`` / default ``published_at`` is the micro-batch clock.
    """
    docs = (spark.readStream.format("text").option("wholetext", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger).load(landing)
            .select(F.col("value").alias("doc"), F.input_file_name().alias("feed_url")))
    entries = S.feed_items(docs, keep=("feed_url",)).withColumnRenamed("link", "url").withColumnRenamed(
        "position", "pos")
    return ingest.raw_items(entries, F.current_timestamp().cast("timestamp_ntz"))


# ---------------------------------------------------------------- J2
def stream_dedupe(items: DataFrame, delay: str = "168 hours", ts: str = "fetched_at") -> DataFrame:
    """Hash uniqueness within the retention horizon (state bounded by the
    watermark on the arrival time: old-dated and future-dated posts pass)."""
    wm = items.withColumn("_wm", F.col(ts).cast("timestamp")).withWatermark("_wm", delay)
    return wm.dropDuplicatesWithinWatermark(["id"]).drop("_wm")


def dedupe_against_store(batch: DataFrame, store: str | SeenStore) -> DataFrame:
    """J2 across restarts: rows of a micro-batch whose ids are not stored, in a
    :class:`SeenStore` or in a plain table of ids."""
    if isinstance(store, SeenStore):
        return store.unseen(batch)
    spark = batch.sparkSession
    if not _exists(spark, store):  # first run: no store yet
        return batch
    return batch.join(spark.read.parquet(store).select("id"), "id", "left_anti")


def new_items_once(batch: DataFrame, batch_id: int, store: SeenStore, out_dir: str, ts: str = "fetched_at") -> bool:
    """J2 body: the batch's new items, one row an id, into the batch's own folder, then
    their ids into the store.  False, and nothing happens, if this batch was stored before."""
    if store.keys.committed("items", batch_id):
        return False
    order = F.xxhash64(F.to_json(F.struct(*[batch[c] for c in batch.columns])))
    one = batch.groupBy("id").agg(F.min_by(F.struct(*[batch[c] for c in batch.columns]), order).alias("r")).select("r.*")
    out = f"{out_dir.rstrip('/')}/batch_id={batch_id}"
    dedupe_against_store(one, store).write.mode("overwrite").parquet(out)
    fresh = batch.sparkSession.read.schema(batch.schema).parquet(out)
    return store.add(fresh.select("id", F.col(ts).cast("timestamp_ntz").alias("seen_at")), "items", batch_id)


def stream_new_items(items: DataFrame, store_path: str, out_dir: str, name: str = "items", checkpoint: str | None = None, ts: str = "fetched_at"):
    """J2 over a store that outlives the stream's state: every id comes out once,
    whatever is replayed, for as long as the store keeps it (``SeenStore.retain``)."""
    spark = items.sparkSession

    def run(batch, batch_id):
        new_items_once(batch, batch_id, SeenStore(spark, store_path), out_dir, ts)
    return (items.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint or stream_checkpoint(spark, name))
            .trigger(availableNow=True).start())


# ---------------------------------------------------------------- J3
def stream_minutes(items: DataFrame, ts: str = "created_at", delay: str = "10 minutes") -> DataFrame:
    """Per-minute counts; rows later than the watermark are dropped."""
    t = F.col(ts).cast("timestamp")
    return (items.withColumn("_t", t).withWatermark("_t", delay)
            .groupBy(F.window("_t", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("minute"), "n"))


def stream_rates(items: DataFrame, ts: str = "created_at", delay: str = "10 minutes") -> DataFrame:
    """Five-minute windows, one a minute, with the count and the rate per minute."""
    return (items.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
            .groupBy(F.window("_t", "5 minutes", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.end").cast("timestamp_ntz").alias("until"), "n", (F.col("n") / 5).alias("per_minute")))


# ---------------------------------------------------------------- J4
def stream_queue(log: DataFrame, ttl_hours: int = 168, late: str = "1 hour", max_attempts: int | None = None, hold: bool = False) -> DataFrame:
    """The lease state machine as keyed state with timers (:mod:`feedloom.streaming.queue`).

    Each micro-batch's events of an item are applied in (ts, seq) order on top
    of the stored state with the same transition as F1 (and F4 with
    ``max_attempts``).  Leases run out by the event-time watermark (``late``);
    an item's state is dropped ``ttl_hours`` after its last update.  Output
    mode: update.
    """
    return queue.lease_queue(log, ttl_hours, late, max_attempts, hold)


# ---------------------------------------------------------------- J5
def publish_batch(batch: DataFrame, batch_id: int, items: DataFrame, out_dir: str, now, layout: str = "chat") -> None:
    """J5 body: skip already dispatched (D6), render (C16/C17), write the
    batch's records to its own folder (overwrite = exactly once per batch id)."""
    q = L.already_dispatched(batch, items).filter(~F.col("skip")).drop("skip")
    rendered = P.render_messages(q, layout)
    recs = P.file_records(rendered, now).select("value")
    recs.write.mode("overwrite").text(f"{out_dir.rstrip('/')}/batch_id={batch_id}")


def stream_publish(analyzed: DataFrame, items: DataFrame | Callable[[], DataFrame] | None, out_dir: str, name: str = "publish", now=None,
                   trigger_once: bool = True, checkpoint: str | None = None):
    """Dispatch loop through the transactional outbox (:mod:`feedloom.streaming.outbox`):
    every item once, across batches, replays and crashes."""
    w = outbox.stream(analyzed, out_dir, checkpoint or stream_checkpoint(analyzed.sparkSession, name), items, now)
    return (w.trigger(availableNow=True) if trigger_once else w).start()


# ---------------------------------------------------------------- J6
def monitor_batch(aq: DataFrame, dq: DataFrame, items: DataFrame) -> DataFrame:
    """J6 body: G2 + G4 + G5 gauges as one long table (metric, key, value)."""
    g2 = M.queue_state_counts(aq, dq).select(F.lit("queue_items").alias("metric"),
                                             F.concat_ws("/", "queue", "state").alias("key"), "n")
    g4 = M.status_counts(items).select(F.lit("item_status").alias("metric"), F.col("status").alias("key"), "n")
    g5 = M.derived_state_counts(items, aq).select(F.lit("item_queue_state").alias("metric"),
                                                  F.col("queue_state").alias("key"), "n")
    return g2.unionByName(g4).unionByName(g5)


def snapshot_table(spark: SparkSession, snap_dir: str, schema) -> KeyedTable:
    """The snapshot as a keyed table: a micro-batch writes its own rows only."""
    return KeyedTable(spark, snap_dir, schema, "item_id")


def upsert_snapshot(updates: DataFrame, snap_dir: str, batch_id: int) -> DataFrame:
    """Merge updated snapshot rows into the snapshot table, and return it.  A
    batch id that is in already changes nothing, so the sink is idempotent."""
    table = snapshot_table(updates.sparkSession, snap_dir, updates.schema)
    table.upsert(updates, "monitor", batch_id)
    return table.read()


def stream_monitor(queue_updates: DataFrame, dq: DataFrame, items: DataFrame, out_dir: str,
                   name: str = "monitor", checkpoint: str | None = None):
    """Each micro-batch of J4 updates is upserted into the snapshot table,
    then the gauges (G2, G4, G5) are computed on the whole snapshot."""
    spark = queue_updates.sparkSession
    snap_dir = f"{out_dir.rstrip('/')}/snapshot"

    def run(b, bid):
        snap = upsert_snapshot(b, snap_dir, bid)
        gauges = monitor_batch(snap, dq, items).withColumn("batch_id", F.lit(bid))
        gauges.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/gauges/batch_id={bid}")
    return (queue_updates.writeStream.foreachBatch(run).outputMode("update")
            .option("checkpointLocation", checkpoint or stream_checkpoint(spark, name)).trigger(availableNow=True).start())
