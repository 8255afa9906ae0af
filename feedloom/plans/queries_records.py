"""Registered queries: dispatch payloads (A5), whole item records (F2), stored analyses (F7), feed state of
removed feeds (F11), page fetch failures (G13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import enrich as N
from feedloom.operators import lifecycle as L
from feedloom.operators import monitor as M
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import register
from feedloom.plans.queries_state import _ADMIN_OPS, NOW, TSN, _admin_changes, _sql_status_log, _status_log, _w
from feedloom.sources import feeds as S
from feedloom.sources.tables import read_pages, read_table


# ====================================================================== A5
@register("analyzed_payloads", lambda: O.with_(O.v_analyzed()) + """, p AS (SELECT *, CAST(id AS BIGINT) AS n FROM v_analyzed)
SELECT id AS item_id, CASE WHEN n % 10 = 3 THEN 'q' || id ELSE id END AS id, role, company, array_to_string(tech_stack, ' ') AS tech_stack,
  array_to_string(tags, ' ') AS tags, job_post_quality_score, CAST(round(confidence, 2) AS DOUBLE) AS confidence, created_at, '' AS reason
FROM p WHERE n % 9 <> 0 AND n % 14 <> 5
UNION ALL SELECT id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'invalid_dispatch_payload' FROM p WHERE n % 9 = 0 OR n % 14 = 5""")
def q_analyzed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """AnalyzedItem -> JSON -> AnalyzedItem; some texts cut short, some with a field of another type, some without an id."""
    a = V.v_analyzed(spark, sf)
    n = F.col("item_id").cast("long")
    enc = S.encode_analyzed(a.withColumn("item_id", F.col("id")).withColumn("id", F.when(n % 10 == 3, F.lit(" ")).otherwise(F.col("id")))).select("item_id", "payload_json")
    enc = enc.withColumn("payload_json", F.when(n % 9 == 0, F.substring("payload_json", 1, 60)).when(
        n % 14 == 5, F.regexp_replace("payload_json", '"job_post_quality_score":([0-9]+)', '"job_post_quality_score":"$1"')).otherwise(F.col("payload_json")))
    good, bad = S.analyzed_payloads(enc)
    rows = good.select("item_id", F.when((n % 10 == 3) & (F.col("id") == F.col("item_id")), F.concat(F.lit("q"), "item_id")).otherwise(F.col("id")).alias("id"), "role", "company",
                       F.array_join("tech_stack", " ").alias("tech_stack"), F.array_join("tags", " ").alias("tags"), "job_post_quality_score",
                       F.round("confidence", 2).alias("confidence"), "created_at", F.lit("").alias("reason"))
    return rows.unionByName(bad.select("item_id", "reason"), allowMissingColumns=True)


# ====================================================================== F2
def _log(spark, sf):
    """The status log with payloads on some analyses and some requeues."""
    seq = F.col("seq")
    return _status_log(spark, sf).withColumn("payload", F.when((F.col("status") == "ANALYZED") & (seq % 3 != 0), F.concat(F.lit('{"n":'), seq.cast("string"), F.lit("}")))) \
        .withColumn("requeue", F.col("status").isin("ANALYZED", "NEW") & (seq % 5 == 0))


@register("item_record", lambda: _w(_sql_status_log(), """lg AS (SELECT *, CASE WHEN status = 'ANALYZED' AND seq % 3 <> 0 THEN '{"n":' || seq || '}' END AS payload,
    status IN ('ANALYZED', 'NEW') AND seq % 5 = 0 AS requeue, row_number() OVER (PARTITION BY item_id ORDER BY ts, seq) AS rn FROM v_status_log),
fo(item_id, rn, status, last_error, updated_at, analyzed_at, first_analyzed_at, analyzed_payload_json, dispatched_at, first_dispatched_at) AS (
  SELECT DISTINCT item_id, CAST(0 AS BIGINT), '', '', CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR),
    CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM lg
  UNION ALL
  SELECT f.item_id, e.rn, CASE WHEN e.ok THEN e.status ELSE f.status END, CASE WHEN e.ok THEN coalesce(e.error, '') ELSE f.last_error END,
    CASE WHEN e.ok THEN e.ts ELSE f.updated_at END, CASE WHEN e.an THEN e.ts ELSE f.analyzed_at END,
    CASE WHEN e.an THEN coalesce(f.first_analyzed_at, e.ts) ELSE f.first_analyzed_at END,
    CASE WHEN e.an THEN coalesce(e.payload, f.analyzed_payload_json) ELSE f.analyzed_payload_json END,
    CASE WHEN e.status = 'DISPATCHED' THEN e.ts WHEN e.status = 'NEW' OR e.requeue THEN NULL ELSE f.dispatched_at END,
    CASE WHEN e.status = 'DISPATCHED' THEN coalesce(f.first_dispatched_at, e.ts) ELSE f.first_dispatched_at END
  FROM fo f JOIN LATERAL (SELECT *, (status IN ('NEW', 'DISPATCHED') OR requeue OR f.status <> 'DISPATCHED') AS ok,
      status = 'ANALYZED' AND NOT requeue AND f.status <> 'DISPATCHED' AS an FROM lg WHERE lg.item_id = f.item_id AND lg.rn = f.rn + 1) e ON true)""", rec=True) + """
SELECT * EXCLUDE (rn) FROM fo QUALIFY rn = max(rn) OVER (PARTITION BY item_id)""")
def q_item_record(spark: SparkSession, sf: str) -> DataFrame:
    """status, error, times and stored payload of every item."""
    return L.item_record(_log(spark, sf))


# ====================================================================== F7
@register("store_analyzed", lambda: _w(O.v_status()) + f""", a AS (SELECT CAST(event_id AS VARCHAR) AS id, '{{"v":' || user_id || '}}' AS payload FROM events WHERE event_id % 2 = 0)
SELECT s.id, CASE WHEN hit THEN 'ANALYZED' ELSE status END AS status, CASE WHEN hit THEN {TSN} ELSE analyzed_at END AS analyzed_at,
  CASE WHEN hit THEN payload ELSE analyzed_payload_json END AS analyzed_payload_json, CASE WHEN hit THEN {TSN} ELSE analyzed_enqueued_at END AS analyzed_enqueued_at,
  CASE WHEN hit THEN '' ELSE last_error END AS last_error, CASE WHEN hit THEN {TSN} ELSE updated_at END AS updated_at
FROM (SELECT s.*, a.payload, a.id IS NOT NULL AND s.status <> 'DISPATCHED' AS hit FROM v_status s LEFT JOIN a ON a.id = s.id) s""")
def q_store_analyzed(spark: SparkSession, sf: str) -> DataFrame:
    """items after analyses were stored, those already dispatched untouched; older records lose."""
    e = read_table(spark, sf, "events").filter("event_id % 2 = 0")
    new = e.select(F.col("event_id").cast("string").alias("id"), F.concat(F.lit('{"v":'), F.col("user_id").cast("string"), F.lit("}")).alias("payload_json"),
                   F.lit(2).alias("created_at"))
    old = new.select("id", F.lit("old").alias("payload_json"), F.lit(1).alias("created_at"))
    blank = new.limit(1).withColumn("id", F.lit(" "))
    return L.store_analyzed(V.v_status(spark, sf), new.unionByName(old).unionByName(blank), NOW).select(
        "id", "status", "analyzed_at", "analyzed_payload_json", "analyzed_enqueued_at", "last_error", "updated_at")


# ====================================================================== F11
@register("feed_admin_state", lambda: f"""WITH c AS (SELECT 'https://src' || CAST(user_id % 23 AS VARCHAR) || '.example.org/feed' AS feed_url, CAST(ts AS TIMESTAMP) AS ts,
    {O._map_case('event_type', _ADMIN_OPS)} AS op FROM events),
s AS (SELECT feed_url, max(ts) - INTERVAL 20 HOUR AS updated_at, count(*) % 6 AS failure_count FROM c GROUP BY 1)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.feed_url = s.feed_url AND op = 'remove' AND c.ts >= s.updated_at)""")
def q_feed_admin_state(spark: SparkSession, sf: str) -> DataFrame:
    """the feed state that removals leave."""
    c = _admin_changes(spark, sf).withColumn("ts", F.col("ts.col1"))
    state = c.groupBy("feed_url").agg((F.max("ts") - F.make_dt_interval(hours=F.lit(20))).alias("updated_at"), (F.count(F.lit(1)) % 6).alias("failure_count"))
    return L.feed_admin_state(c, state)


# ====================================================================== G13
@register("scrape_failures", lambda: O.with_(O.v_items()) + f""", t AS (SELECT i.url, p.url AS purl, {O.html_to_text('p.html')} AS txt FROM v_items i
  LEFT JOIN (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1) p ON p.url = i.url),
r AS (SELECT CASE WHEN purl IS NULL THEN 'fetch_failed' WHEN txt = '' THEN 'empty_text' END AS basic, purl FROM t)
SELECT 'basic' AS extractor, basic AS reason, count(*) AS n FROM r WHERE basic IS NOT NULL GROUP BY 2
UNION ALL SELECT 'scrapling', 'fetch_failed', count(*) FROM r WHERE purl IS NULL HAVING count(*) > 0
UNION ALL SELECT 'hybrid', 'basic: fetch_failed; main: fetch_failed', count(*) FROM r WHERE purl IS NULL HAVING count(*) > 0""")
def q_scrape_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Page fetch failures by extractor."""
    items, pages = V.v_items(spark, sf).select("pos", "url"), read_pages(spark, sf)
    parts = [M.scrape_failures(N.page_excerpt(items, pages, mode), mode) for mode in ("basic", "scrapling", "hybrid")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
