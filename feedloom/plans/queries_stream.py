"""Registered queries that run the continuous jobs (J1-J6) over landed parts of
the tables, and the tables they keep: seen ids, days, repeated and null rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.operators import ingest
from feedloom.operators import lifecycle as L
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import _benchmark_seen, _sql_dedupe_keys, register
from feedloom.plans.queries_publish import _sql_chat
from feedloom.plans.queries_state import AQ, DQ, NOW, SNAP_COLS, TSN, _d2_sql, _dq, _w, _zero_sql
from feedloom.session import scratch_path
from feedloom.sources import feeds as S
from feedloom.sources.daily import DayTable
from feedloom.sources.seen import SeenStore
from feedloom.streaming import jobs as J
from feedloom.streaming import outbox
from feedloom.streaming import queue as Q


def _last(spark: SparkSession, updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Run an update-mode stream over all that has landed; the last row of each key."""
    out, state = scratch_path(spark), scratch_path(spark)

    def run(b, bid):
        b.withColumn("batch", F.lit(bid)).write.mode("overwrite").parquet(f"{out}/batch_id={bid}")
    updates.writeStream.foreachBatch(run).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema] + ["batch long"])).parquet(f"{out}/batch_id=*")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("s")).select(*keys, "s.*")


def _landed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The table as a stream of files."""
    land = scratch_path(spark)
    df.write.parquet(land)
    return spark.readStream.schema(df.schema).parquet(land)


# ====================================================================== J4
def _sql_queue_replay() -> str:
    return _w([O.v_log(), O.queue_fold("v_log", "aq", max_attempts=3)], rec=True) + """, m AS (SELECT max(ts) + INTERVAL 1 HOUR AS at FROM v_log),
x AS (SELECT aq.*, state = 'LEASED' AND lease_until <= m.at AS out FROM aq, m)
SELECT item_id, CASE WHEN out THEN 'QUEUED' ELSE state END AS state, CASE WHEN out THEN NULL ELSE lease_owner END AS lease_owner,
  CASE WHEN out THEN NULL ELSE lease_until END AS lease_until, delivery_count, enqueued_at, done_at, last_error, updated_at FROM x"""


def _plain_times(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@register("stream_queue_replay", _sql_queue_replay)
def q_stream_queue_replay(spark: SparkSession, sf: str) -> DataFrame:
    """J4 (F1, F4): the queue stream over the transition log, with leases that run out and three deliveries at most."""
    return _plain_times(Q.replay(V.v_log(spark, sf), max_attempts=3)).select(*SNAP_COLS.split(", "))


# ====================================================================== J5
@register("stream_publish_replay", lambda: re.sub(
    r"SELECT id, (.*) AS message FROM v_analyzed$", r"""SELECT '2024-01-31T00:00:00Z' || chr(10) || \1 || chr(10) || chr(10) || '---' || chr(10) || chr(10) AS value
FROM v_analyzed WHERE CAST(id AS BIGINT) % 7 <> 0""", _sql_chat(), flags=re.S))
def q_stream_publish_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Analysed items through the outbox in three overlapping batches, the last of which runs twice; every seventh was sent before."""
    rows = V.v_analyzed(spark, sf).withColumnRenamed("id", "item_id")
    n = F.col("item_id").cast("long")
    items = V.v_analyzed(spark, sf).filter(F.col("id").cast("long") % 7 == 0).select(
        "id", F.lit("DISPATCHED").alias("status"), F.lit(None).cast("timestamp_ntz").alias("dispatched_at"))
    out = scratch_path(spark)
    for batch, part in enumerate((n % 3 == 0, n % 3 != 1, F.lit(True))):
        for _ in range(2 if batch == 2 else 1):
            outbox.publish_once(rows.filter(part), batch, out, NOW, items=items)
    return outbox.messages(spark, out).select("value")


# ====================================================================== J6
def _sql_monitor_replay() -> str:
    base = _w([O.v_log(), O.queue_fold("v_log", "aq0")], DQ, O.v_status(), rec=True) + """, m AS (SELECT max(ts) - INTERVAL 1 HOUR AS at FROM v_log),
aq AS (SELECT aq0.* REPLACE (CASE WHEN state = 'LEASED' AND lease_until <= m.at THEN 'QUEUED' ELSE state END AS state) FROM aq0, m),
d2 AS (""" + _d2_sql() + ")\n"
    states = ["QUEUED", "LEASED", "DONE"]
    nine = ["not_enqueued_raw", "queued_raw", "inflight_raw", "processed_raw", "not_enqueued_analyzed", "queued_analyzed", "dispatched", "failed", "unknown"]
    return base + f"""SELECT 'queue_items' AS metric, 'analyzer_queue/' || state AS key, n FROM ({_zero_sql('state', states, 'aq', 'state')})
UNION ALL SELECT 'queue_items', 'dispatch_queue/' || state, n FROM ({_zero_sql('state', states, 'dq', 'state')})
UNION ALL SELECT 'item_status', status, n FROM ({_zero_sql('status', ['NEW', 'ANALYZED', 'DISPATCHED', 'FAILED'], 'v_status', 'status')})
UNION ALL SELECT 'item_queue_state', queue_state, n FROM ({_zero_sql('queue_state', nine, 'd2', 'queue_state')})"""


@register("stream_monitor_replay", _sql_monitor_replay)
def q_stream_monitor_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The queue stream kept as a snapshot table, and the gauges after its last batch."""
    out, state = scratch_path(spark), scratch_path(spark)
    queue = J.stream_queue(_landed(spark, V.v_log(spark, sf).select(*L.LOG_COLUMNS)))
    J.stream_monitor(queue, _dq(spark, sf), V.v_status(spark, sf), out, checkpoint=state).awaitTermination()
    gauges = spark.read.schema("metric string, key string, n long, batch_id int").option("basePath", f"{out}/gauges").parquet(f"{out}/gauges/batch_id=*")
    return gauges.join(gauges.agg(F.max("batch_id").alias("batch_id")), "batch_id").select("metric", "key", "n")


# ====================================================================== J3
@register("stream_minutes_replay", lambda: _w(O.v_status()) + """
SELECT date_trunc('minute', created_at) AS minute, count(*) AS n FROM v_status GROUP BY 1""")
def q_stream_minutes_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Items per minute."""
    return _last(spark, J.stream_minutes(_landed(spark, V.v_status(spark, sf).select("created_at"))), ["minute"], ["n"])


@register("stream_rates_replay", lambda: _w(O.v_status()) + """
SELECT date_trunc('minute', created_at) + to_minutes(k) AS until, count(*) AS n, round(count(*) / 5.0, 6) AS per_minute
FROM v_status, range(1, 6) t(k) GROUP BY 1""")
def q_stream_rates_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Items per five-minute window, one a minute."""
    rates = _last(spark, J.stream_rates(_landed(spark, V.v_status(spark, sf).select("created_at"))), ["until"], ["n", "per_minute"])
    return rates.select("until", "n", F.round("per_minute", 6).alias("per_minute"))


# ====================================================================== J1
@register("stream_items_replay", lambda: O.with_(O.v_items(), O.raw_items()) + """
SELECT id, guid, url, title, CASE WHEN length(guid) > 0 THEN published_at END AS published_at FROM raw WHERE pos % 11 = 0""")
def q_stream_items_replay(spark: SparkSession, sf: str) -> DataFrame:
    """One landed feed document per file, parsed as a stream (every eleventh posting's first entry)."""
    land = scratch_path(spark)
    docs = S.rss_document(V.v_items(spark, sf).filter("pos % 11 = 0")).select("doc")
    docs.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(land)
    items = J.stream_items(spark, land).select("id", "guid", "url", "title", "published_at", "pos")
    found = _last(spark, items.filter("pos = 0").drop("pos"), ["id", "guid", "url", "title"], ["published_at"])
    return found.select("id", "guid", "url", "title", F.when(F.length("guid") > 0, F.col("published_at")).alias("published_at"))


# ====================================================================== J2, D5
def _doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    return V.v_doc_items(spark, sf).select(T.item_hash("guid", "url", "title").alias("id"), "pos", F.col("published").alias("fetched_at"))


def _sql_doc_ids() -> str:
    return O.with_(O.v_doc_items(), f"ids AS (SELECT {O.item_hash('guid', 'url', 'title')} AS id, pos, published AS fetched_at FROM v_doc_items)")


@register("stream_new_items_replay", lambda: _sql_doc_ids() + "\nSELECT id, CAST(min(pos % 3) AS INTEGER) AS batch_id FROM ids GROUP BY id")
def q_stream_new_items_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Items that land in three parts, the stream restarted for each; every id comes out once, in its first part."""
    ids, land, out, store, state = _doc_ids(spark, sf), *(scratch_path(spark) for _ in range(4))
    for part in range(3):
        ids.filter(F.col("pos") % 3 == part).select("id", "pos", "fetched_at").write.mode("append").parquet(land)
        J.stream_new_items(spark.readStream.schema(ids.schema).parquet(land), store, out, checkpoint=state).awaitTermination()
    return spark.read.schema("id string, pos long, fetched_at timestamp_ntz, batch_id int").option("basePath", out).parquet(f"{out}/batch_id=*") \
        .select("id", "batch_id")


@register("seen_ids", lambda: _sql_doc_ids() + """
SELECT DISTINCT id FROM ids WHERE id NOT IN (SELECT id FROM ids WHERE pos % 5 < 2)""")
def q_seen_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that are not in the seen-store, by its Bloom filters and the folders they name."""
    ids = _doc_ids(spark, sf)
    store = SeenStore(spark, scratch_path(spark))
    for part in range(2):
        store.add(ids.filter(F.col("pos") % 5 == part).select("id", F.col("fetched_at").alias("seen_at")), "items", part)
    return store.unseen(ids.select("id").distinct())


# ====================================================================== H4
@register("retention_by_day", lambda: _w(O.v_status()) + f"""
SELECT id, created_at FROM v_status WHERE created_at IS NULL OR created_at >= {TSN} - INTERVAL 100 HOUR""")
def q_retention_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """H4 on a table by day: whole days dropped, the boundary day written anew."""
    rows = V.v_status(spark, sf).select("id", "created_at")
    table = DayTable(spark, scratch_path(spark), rows.schema, "id", "created_at")
    table.append(rows, "items", 0)
    cutoff = rows.select((F.lit(NOW).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(100))).alias("at")).limit(1).first()
    if cutoff is not None:
        table.retain(cutoff.at)
    return table.read()


@register("orphans_by_bucket", lambda: _w(AQ, O.v_status(), rec=True) + f""", k AS (
  SELECT id FROM v_status WHERE created_at IS NULL OR created_at >= {TSN} - INTERVAL 100 HOUR)
SELECT item_id, enqueued_at FROM aq WHERE item_id NOT IN (SELECT id FROM k)""")
def q_orphans_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """H4: queue rows whose item is gone, bucket by bucket."""
    queue = L.queue_snapshot(V.v_log(spark, sf)).select("item_id", "enqueued_at")
    rows = ingest.retention(V.v_status(spark, sf), NOW, 100).select("id", "created_at")
    items = DayTable(spark, scratch_path(spark), rows.schema, "id", "created_at")
    queued = DayTable(spark, scratch_path(spark), queue.schema, "item_id", "enqueued_at")
    items.append(rows, "items", 0)
    queued.append(queue, "queue", 0)
    return items.orphans(queued)


# ====================================================================== E1, E2
def _odd_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Document items, every fifth twice, some without a feed and some without a position."""
    d = V.v_doc_items(spark, sf)
    lost = F.when(F.col("pos") % 11 == 0, F.lit(None).cast("string")).when(F.col("pos") % 13 == 0, F.concat("feed_url", F.lit("/"), F.col("pos").cast("string")))
    odd = d.withColumn("feed_url", F.when((F.col("pos") % 11 == 0) | (F.col("pos") % 13 == 0), lost).otherwise(F.col("feed_url"))) \
        .withColumn("pos", F.when((F.col("pos") % 13 == 0) & (F.col("pos") % 11 != 0), F.lit(None).cast("long")).otherwise(F.col("pos")))
    return odd.unionByName(odd.filter(F.coalesce("pos", F.lit(0)) % 5 == 0))


def _sql_odd_posts() -> str:
    return """odd AS (SELECT CASE WHEN pos % 11 = 0 THEN NULL WHEN pos % 13 = 0 THEN feed_url || '/' || pos ELSE feed_url END AS feed_url,
    CASE WHEN pos % 13 = 0 AND pos % 11 <> 0 THEN NULL ELSE pos END AS pos, guid, url, title, published FROM v_doc_items),
posts AS (SELECT * FROM odd UNION ALL SELECT * FROM odd WHERE coalesce(pos, 0) % 5 = 0)"""


@register("dedupe_hash_repeats", lambda: O.with_(O.v_doc_items(), _sql_odd_posts(), f"""h AS (
  SELECT {O.item_hash('guid', 'url', 'title')} AS id, feed_url, pos, url, title FROM posts)""") + """
SELECT id, feed_url, pos, url, title FROM h
QUALIFY row_number() OVER (PARTITION BY id ORDER BY feed_url NULLS FIRST, pos NULLS FIRST) = 1""")
def q_dedupe_hash_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """E1 with repeated rows and rows without feed or position."""
    return ingest.dedupe_hash(_odd_posts(spark, sf).select(T.item_hash("guid", "url", "title").alias("id"), "feed_url", "pos", "url", "title"))


@register("dedupe_keys_repeats", lambda: _sql_dedupe_keys().replace("FROM v_doc_items),\nks", "FROM posts),\nks").replace(
    "ORDER BY feed_url, pos)", "ORDER BY feed_url NULLS FIRST, pos NULLS FIRST)").replace("seen AS (", _sql_odd_posts() + ",\nseen AS (", 1))
def q_dedupe_keys_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """E2 with repeated rows and rows without feed or position."""
    return ingest.dedupe_keys(_odd_posts(spark, sf), _benchmark_seen(spark, sf)).select("feed_url", "pos", "url", "title", "accepted")
