"""Registered queries over the item / queue / feed state (F, D, G, H, E5, E6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.operators import ingest
from feedloom.operators import lifecycle as L
from feedloom.operators import monitor as M
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import register
from feedloom.sources.tables import read_table

NOW = V.NOW_EVENTS
TSN = O.ts(NOW)


def _aq(spark, sf):
    return L.queue_snapshot(V.v_log(spark, sf))


def _dq(spark, sf):
    return L.queue_snapshot(V.v_log_dispatch(spark, sf))


def _status_log(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return e.select(F.col("user_id").cast("string").alias("item_id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                    F.col("event_id").alias("seq"),
                    F.element_at(V._map_lit(V.STATUS_BY_EVENT), F.col("event_type")).alias("status"),
                    F.when(F.col("event_type") == "error", F.concat(F.lit("error "), F.col("props")))
                    .otherwise(F.lit("")).alias("error"))


def _sql_status_log() -> str:
    return f"""v_status_log AS (
  SELECT CAST(user_id AS VARCHAR) AS item_id, CAST(ts AS TIMESTAMP) AS ts, event_id AS seq,
         {O._map_case('event_type', V.STATUS_BY_EVENT)} AS status,
         CASE WHEN event_type = 'error' THEN 'error ' || props ELSE '' END AS error FROM events)"""


AQ = [O.v_log(), O.queue_fold("v_log", "aq")]
DQ = [O.v_log_dispatch(), O.queue_fold("v_log_dispatch", "dq")]


def _w(*ctes, rec=False):
    flat = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    return (O.with_rec if rec else O.with_)(*flat)


SNAP_COLS = "item_id, state, lease_owner, lease_until, delivery_count, enqueued_at, done_at, last_error, updated_at"


# ====================================================================== F
@register("queue_snapshot_raw", lambda: _w(AQ, rec=True) + f"SELECT {SNAP_COLS} FROM aq")
def q_queue_snapshot_raw(spark: SparkSession, sf: str) -> DataFrame:
    """analyzer-queue snapshot folded from the transition log."""
    return _aq(spark, sf)


@register("queue_snapshot_dispatch", lambda: _w(DQ, rec=True) + f"SELECT {SNAP_COLS} FROM dq")
def q_queue_snapshot_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """dispatch-queue snapshot folded from its transition log."""
    return _dq(spark, sf)


@register("item_status_fold", lambda: _w(_sql_status_log(), O.status_fold("v_status_log", "st"), rec=True)
          + "SELECT item_id, status, last_error, status_at, dispatched_at FROM st")
def q_item_status_fold(spark: SparkSession, sf: str) -> DataFrame:
    """item status from a status-write log with the DISPATCHED guard."""
    return L.item_status(_status_log(spark, sf))


@register("claim_batch", lambda: _w(AQ, rec=True) + f"""
SELECT item_id, {TSN} AS ts, 'claim' AS action, 'w-claim' AS worker, {TSN} + INTERVAL 2 MINUTE AS lease_until,
       delivery_count + 1 AS delivery_count
FROM aq WHERE state = 'QUEUED' OR (state = 'LEASED' AND lease_until IS NOT NULL AND lease_until <= {TSN})
ORDER BY enqueued_at NULLS FIRST, item_id LIMIT 10""")
def q_claim_batch(spark: SparkSession, sf: str) -> DataFrame:
    """the 10 oldest claimable items -> claim events."""
    return L.claim_batch(_aq(spark, sf), 10, NOW, "w-claim")


def _failures(snap: DataFrame) -> DataFrame:
    leased = snap.filter(F.col("state") == "LEASED")
    return leased.select("item_id", F.when(F.col("item_id").cast("long") % 5 == 0,
                                           F.lit("missing required analyzed fields"))
                         .otherwise(F.lit("llm status: 503")).alias("error"))


@register("quarantine", lambda: _w(AQ, rec=True) + """, fl AS (
  SELECT item_id, CASE WHEN CAST(item_id AS BIGINT) % 5 = 0 THEN 'missing required analyzed fields'
                       ELSE 'llm status: 503' END AS error FROM aq WHERE state = 'LEASED'),
j AS (SELECT fl.item_id, fl.error, coalesce(aq.delivery_count, 0) AS dc FROM fl LEFT JOIN aq USING (item_id)),
d AS (SELECT *, (lower(error) LIKE '%missing required analyzed fields%' OR dc >= 3) AS qq FROM j)
SELECT item_id, CASE WHEN qq THEN 'fail' ELSE 'release' END AS action,
       CASE WHEN qq THEN 'poison_item: analysis_failed: ' || error ELSE 'analysis_failed: ' || error END AS reason,
       CASE WHEN qq THEN 'FAILED' END AS item_status, dc AS delivery_count FROM d""")
def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """failed claims -> quarantine (fail) or release, max attempts 3."""
    snap = _aq(spark, sf)
    return L.quarantine(_failures(snap), snap, 3)


@register("quarantine_stale", lambda: _w(AQ, rec=True) + f"""
SELECT item_id, 'DONE' AS new_state, 'FAILED' AS item_status, 'stale_queue_item: older than 30m' AS reason
FROM aq WHERE state IN ('QUEUED', 'LEASED') AND enqueued_at <= {TSN} - INTERVAL 30 MINUTE""")
def q_quarantine_stale(spark: SparkSession, sf: str) -> DataFrame:
    """bulk repair of queue rows older than 30 minutes."""
    return L.quarantine_stale(_aq(spark, sf), NOW, 30)


@register("enqueue_counters", lambda: _w(O.v_log()) + """
SELECT item_id, max(ts) AS last_enqueued_at, CAST(count(*) AS INTEGER) AS enqueue_count
FROM v_log WHERE action = 'enqueue' GROUP BY item_id""")
def q_enqueue_counters(spark: SparkSession, sf: str) -> DataFrame:
    """enqueue counters per item."""
    return L.enqueue_counters(V.v_log(spark, sf))


def _outcomes(spark, sf):
    e = read_table(spark, sf, "events").select("ts", "user_id", "event_type")
    return e.select(F.concat(F.lit("https://src"), (F.col("user_id") % 23).cast("string"),
                             F.lit(".example.org/feed")).alias("feed_url"),
                    F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("event_type") != "error").alias("ok"))


@register("feed_state", lambda: """WITH o AS (
  SELECT 'https://src' || CAST(user_id % 23 AS VARCHAR) || '.example.org/feed' AS feed_url, CAST(ts AS TIMESTAMP) AS ts,
         event_type <> 'error' AS ok FROM events),
l AS (SELECT feed_url, max({'ts': ts, 'ok': ok}) AS s FROM o GROUP BY feed_url)
SELECT feed_url, CASE WHEN s.ok THEN 0 ELSE 5 END AS failure_count,
       CASE WHEN NOT s.ok THEN s.ts + INTERVAL 30 MINUTE END AS down_until, s.ts AS updated_at FROM l""")
def q_feed_state(spark: SparkSession, sf: str) -> DataFrame:
    """latest poll outcome per feed -> failure_count / down_until (30 min cooldown)."""
    return L.feed_state(_outcomes(spark, sf), 30)


def _requeue_ids(spark, sf):
    e = read_table(spark, sf, "events").select("user_id").distinct()
    return e.select((F.col("user_id") * 67).cast("string").alias("id"))


@register("requeue", lambda: _w(O.v_status()) + f""", r AS (SELECT DISTINCT CAST(user_id * 67 AS VARCHAR) AS id FROM events),
j AS (SELECT r.id, s.analyzed_payload_json, s.status, s.id IS NOT NULL AS known, s.source_feed_url AS feed, s.url, s.title
  FROM r LEFT JOIN v_status s ON s.id = r.id)
SELECT id,
  CASE WHEN NOT known THEN 'not_found' WHEN {O.trim_space("coalesce(analyzed_payload_json, '')")} <> ''
       THEN 'dispatch_queue' ELSE 'analyzer_queue' END AS target,
  CASE WHEN NOT known THEN NULL WHEN {O.trim_space("coalesce(analyzed_payload_json, '')")} <> ''
       THEN 'ANALYZED' ELSE 'NEW' END AS new_status,
  coalesce(status, '') AS old_status,
  CASE WHEN known THEN {TSN} END AS enqueued_at,
  CASE WHEN {O.trim_space("coalesce(analyzed_payload_json, '')")} <> '' THEN analyzed_payload_json
       WHEN known THEN '{{"schema_version":"v1","id":"' || id || '","feed_url":"' || feed || '","source_label":"' || {O.source_label('feed')}
         || '","url":"' || url || '","title":"' || title || '","published_at":"{NOW[:10]}T{NOW[11:]}Z","fetched_at":"{NOW[:10]}T{NOW[11:]}Z"}}' END AS payload_json,
  CASE WHEN known THEN 1 ELSE 0 END AS enqueue_count_add FROM j""")
def q_requeue(spark: SparkSession, sf: str) -> DataFrame:
    """requeue plan: dispatch or raw queue by stored payload; unknown ids flagged."""
    return L.requeue(_requeue_ids(spark, sf), V.v_status(spark, sf), NOW)


def _receipts(spark, sf):
    s = V.v_status(spark, sf).filter(F.col("status") == "DISPATCHED")
    return s.select(F.when(F.col("id").cast("long") % 2 == 0, F.col("id")).otherwise(F.lit("")).alias("item_id"),
                    "guid", "url", "title", F.col("dispatched_at").alias("processed_at"))


@register("apply_receipts", lambda: _w(O.v_status()) + f""", r AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN id ELSE '' END AS item_id, guid, url, title,
         dispatched_at AS processed_at FROM v_status WHERE status = 'DISPATCHED')
SELECT CASE WHEN {O.trim_space('item_id')} <> '' THEN {O.trim_space('item_id')}
            ELSE {O.item_hash('guid', 'url', 'title')} END AS item_id,
       processed_at AS ts, 'DISPATCHED' AS status, '' AS error, {O.norm_url('url')} AS url
FROM r WHERE {O.trim_space("coalesce(item_id, '')")} <> '' OR {O.trim_space("coalesce(url, '')")} <> ''""")
def q_apply_receipts(spark: SparkSession, sf: str) -> DataFrame:
    """F8: processed receipts -> DISPATCHED writes; blank id -> item hash."""
    return L.apply_receipts(_receipts(spark, sf))


_ADMIN_OPS = {"signup": "add", "click": "disable", "view": "enable", "error": "remove", "purchase": "seed"}


def _admin_changes(spark, sf):
    e = read_table(spark, sf, "events").select("ts", "user_id", "event_type", "event_id")
    return e.select(F.concat(F.lit("https://src"), (F.col("user_id") % 23).cast("string"),
                             F.lit(".example.org/feed")).alias("feed_url"),
                    F.struct(F.col("ts").cast("timestamp_ntz"), F.col("event_id")).alias("ts"),
                    F.element_at(V._map_lit(_ADMIN_OPS), F.col("event_type")).alias("op"))


@register("feed_admin", lambda: _w(O.v_feeds(), rec=True) + f""", c AS (
  SELECT 'https://src' || CAST(user_id % 23 AS VARCHAR) || '.example.org/feed' AS feed_url,
         {{'ts': CAST(ts AS TIMESTAMP), 'event_id': event_id}} AS ts, {O._map_case('event_type', _ADMIN_OPS)} AS op
  FROM events),
cr AS (SELECT *, row_number() OVER (PARTITION BY feed_url ORDER BY ts) AS rn FROM c),
init AS (SELECT coalesce(f.feed_url, k.feed_url) AS feed_url, f.enabled AS e0
         FROM v_feeds f FULL OUTER JOIN (SELECT DISTINCT feed_url FROM c) k USING (feed_url)),
fo(feed_url, rn, ex, en) AS (
  SELECT feed_url, CAST(0 AS BIGINT), e0 IS NOT NULL, e0 FROM init
  UNION ALL
  SELECT fo.feed_url, cr.rn,
    CASE WHEN cr.op IN ('add', 'seed') THEN true WHEN cr.op = 'remove' THEN false ELSE fo.ex END,
    CASE WHEN cr.op = 'add' THEN true
         WHEN cr.op = 'seed' THEN CASE WHEN fo.ex THEN fo.en ELSE true END
         WHEN cr.op = 'remove' THEN NULL
         WHEN cr.op IN ('enable', 'disable') AND fo.ex THEN cr.op = 'enable'
         ELSE fo.en END
  FROM fo JOIN cr ON cr.feed_url = fo.feed_url AND cr.rn = fo.rn + 1),
fin AS (SELECT * FROM fo QUALIFY rn = max(rn) OVER (PARTITION BY feed_url))
SELECT feed_url, en AS enabled FROM fin WHERE ex""")
def q_feed_admin(spark: SparkSession, sf: str) -> DataFrame:
    """admin changes applied to the feed dimension (seed never re-enables)."""
    return L.feed_admin(_admin_changes(spark, sf), V.v_feeds(spark, sf))


@register("status_lookup", lambda: _w(O.v_status()) + """, r AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events)
SELECT r.id, s.status, s.last_error, s.updated_at, s.analyzed_at, s.dispatched_at, s.id IS NOT NULL AS found
FROM r LEFT JOIN v_status s ON s.id = r.id""")
def q_status_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """status lookup for a list of ids."""
    ids = read_table(spark, sf, "events").select(F.col("user_id").cast("string").alias("id"))
    return L.item_status_lookup(ids, V.v_status(spark, sf))


# ====================================================================== D
@register("already_dispatched", lambda: _w(DQ, O.v_status(), rec=True) + f"""
SELECT dq.item_id, dq.state, ((upper({O.trim_space("coalesce(s.status, '')")}) = 'DISPATCHED')
       OR s.dispatched_at IS NOT NULL) AS skip
FROM dq LEFT JOIN v_status s ON s.id = dq.item_id""")
def q_already_dispatched(spark: SparkSession, sf: str) -> DataFrame:
    """Dispatch-queue rows whose item is already dispatched are skipped."""
    return L.already_dispatched(_dq(spark, sf).select("item_id", "state"), V.v_status(spark, sf))


@register("already_analyzed", lambda: _w(AQ, O.v_status(), rec=True) + f"""
SELECT aq.item_id, aq.state,
       CASE WHEN s.id IS NOT NULL THEN {O.trim_space("coalesce(s.analyzed_payload_json, '')")} END AS stored_payload,
       coalesce({O.trim_space("coalesce(s.analyzed_payload_json, '')")} <> '', false) AS cached
FROM aq LEFT JOIN v_status s ON s.id = aq.item_id""")
def q_already_analyzed(spark: SparkSession, sf: str) -> DataFrame:
    """Analyzer-queue rows with a stored payload are forwarded without analysis."""
    r = L.already_analyzed(_aq(spark, sf).select("item_id", "state"), V.v_status(spark, sf))
    return r.select("item_id", "state", "stored_payload", "cached")


@register("poll_request_valid", lambda: _w(O.v_feeds()) + """, r AS (
  SELECT DISTINCT 'https://src' || CAST(user_id % 23 AS VARCHAR) || '.example.org/feed' AS feed_url FROM events)
SELECT feed_url FROM r WHERE feed_url IN (SELECT feed_url FROM v_feeds)""")
def q_poll_request_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Poll requests only for known feeds."""
    req = _outcomes(spark, sf).select("feed_url").distinct()
    return L.poll_request_valid(req, V.v_feeds(spark, sf))


@register("feeds_with_state", lambda: _w(O.v_feeds()) + """
SELECT feed_url, enabled, coalesce(failure_count, 0) AS failure_count, down_until FROM v_feeds""")
def q_feeds_with_state(spark: SparkSession, sf: str) -> DataFrame:
    """Feeds left-joined with feed state."""
    f = V.v_feeds(spark, sf)
    return M.feeds_with_state(f.select("feed_url", "enabled"), f.select("feed_url", "failure_count", "down_until"))


def _d2_sql() -> str:
    return """SELECT s.id, s.status, CASE
    WHEN s.status = 'NEW' AND aq.item_id IS NULL THEN 'not_enqueued_raw'
    WHEN s.status = 'NEW' AND aq.state = 'QUEUED' THEN 'queued_raw'
    WHEN s.status = 'NEW' AND aq.state = 'LEASED' THEN 'inflight_raw'
    WHEN s.status = 'NEW' AND aq.state = 'DONE' THEN 'processed_raw'
    WHEN s.status = 'ANALYZED' AND s.analyzed_enqueued_at IS NULL THEN 'not_enqueued_analyzed'
    WHEN s.status = 'ANALYZED' THEN 'queued_analyzed'
    WHEN s.status = 'DISPATCHED' THEN 'dispatched'
    WHEN s.status = 'FAILED' THEN 'failed' ELSE 'unknown' END AS queue_state,
  (aq.item_id IS NOT NULL OR s.status IN ('ANALYZED', 'DISPATCHED')) AS raw_enqueued,
  (s.analyzed_enqueued_at IS NOT NULL OR s.status = 'DISPATCHED') AS analyzed_enqueued,
  (trim(coalesce(s.analyzed_payload_json, '')) <> '') AS has_analyzed
FROM v_status s LEFT JOIN aq ON aq.item_id = s.id"""


@register("items_with_queue_state", lambda: _w(AQ, O.v_status(), rec=True) + _d2_sql())
def q_items_with_queue_state(spark: SparkSession, sf: str) -> DataFrame:
    """D2 + D3: item view with derived queue state and flags."""
    d = M.item_flags(M.items_with_queue_state(V.v_status(spark, sf), _aq(spark, sf)))
    return d.select("id", "status", "queue_state", "raw_enqueued", "analyzed_enqueued", "has_analyzed")


def _board_sql() -> str:
    return f"""SELECT s.id, s.title, s.url, s.status,
  CASE WHEN aq.state = 'LEASED' THEN 'raw_inflight' WHEN aq.state = 'QUEUED' THEN 'raw_backlog'
       WHEN dq.state = 'LEASED' THEN 'analyzed_inflight' WHEN dq.state = 'QUEUED' THEN 'analyzed_backlog'
       WHEN s.status = 'FAILED' THEN 'failed' WHEN s.status = 'DISPATCHED' THEN ''
       WHEN s.status = 'ANALYZED' AND dq.state = 'DONE' THEN 'anomalies'
       WHEN s.status = 'NEW' AND aq.state = 'DONE' THEN 'anomalies'
       WHEN s.status = 'ANALYZED' AND dq.item_id IS NULL THEN 'anomalies'
       WHEN s.status = 'NEW' AND aq.item_id IS NULL THEN 'anomalies' ELSE '' END AS lane,
  CASE WHEN aq.state = 'LEASED' THEN 'inflight_raw' WHEN aq.state = 'QUEUED' THEN 'queued_raw'
       WHEN aq.state = 'DONE' THEN 'processed_raw' WHEN dq.state = 'LEASED' THEN 'inflight_analyzed'
       WHEN dq.state = 'QUEUED' THEN 'queued_analyzed' WHEN dq.state = 'DONE' THEN 'processed_analyzed'
       WHEN s.status = 'NEW' AND aq.item_id IS NULL THEN 'not_enqueued_raw'
       WHEN s.status = 'ANALYZED' AND dq.item_id IS NULL THEN 'not_enqueued_analyzed'
       WHEN s.status = 'DISPATCHED' THEN 'dispatched' WHEN s.status = 'FAILED' THEN 'failed' ELSE 'unknown' END AS queue_state,
  s.source_feed_url, {O.source_label('s.source_feed_url')} AS source_label, s.created_at, s.updated_at,
  coalesce(s.last_error, '') AS last_error,
  CASE WHEN aq.state = 'QUEUED' THEN 1 WHEN aq.state = 'LEASED' THEN 2 WHEN dq.state = 'QUEUED' THEN 3
       WHEN dq.state = 'LEASED' THEN 4 WHEN s.status = 'FAILED' THEN 5 ELSE 6 END AS priority,
  CASE WHEN s.status = 'NEW' THEN coalesce(aq.enqueued_at, s.created_at, s.updated_at)
       WHEN s.status = 'ANALYZED' THEN coalesce(dq.enqueued_at, s.analyzed_enqueued_at, s.updated_at, s.created_at)
       ELSE coalesce(s.updated_at, s.created_at) END AS fifo_ts
FROM v_status s LEFT JOIN aq ON aq.item_id = s.id LEFT JOIN dq ON dq.item_id = s.id"""


def _board(spark, sf):
    return M.board(V.v_status(spark, sf), _aq(spark, sf), _dq(spark, sf))


@register("board", lambda: _w(AQ, DQ, O.v_status(), rec=True) + _board_sql())
def q_board(spark: SparkSession, sf: str) -> DataFrame:
    """Board rows with lane, board queue state, priority and fifo timestamp."""
    return _board(spark, sf)


# ====================================================================== G
@register("overview", lambda: _w(O.v_feeds(), O.v_status()) + """
SELECT (SELECT count(*) FILTER (WHERE enabled) FROM v_feeds) AS feeds_enabled,
       (SELECT count(*) FILTER (WHERE NOT enabled) FROM v_feeds) AS feeds_disabled,
       (SELECT count(*) FILTER (WHERE status = 'NEW') FROM v_status) AS items_new,
       (SELECT count(*) FILTER (WHERE status = 'DISPATCHED') FROM v_status) AS items_dispatched,
       (SELECT count(*) FILTER (WHERE status = 'ANALYZED') FROM v_status) AS items_analyzed""")
def q_overview(spark: SparkSession, sf: str) -> DataFrame:
    """G1: one-row overview of feeds and item statuses."""
    return M.overview(V.v_feeds(spark, sf), V.v_status(spark, sf))


def _zero_sql(name: str, values: list[str], src: str, col: str) -> str:
    dom = " UNION ALL ".join(f"SELECT {O.q(v)} AS {name}" for v in values)
    return (f"SELECT d.{name}, coalesce(c.n, 0) AS n FROM ({dom}) d LEFT JOIN "
            f"(SELECT {col} AS {name}, count(*) AS n FROM {src} GROUP BY 1) c USING ({name})")


@register("queue_state_counts", lambda: _w(AQ, DQ, rec=True) + f"""
SELECT 'analyzer_queue' AS queue, 'raw' AS pipeline_stage, state, n FROM ({_zero_sql('state', ['QUEUED', 'LEASED', 'DONE'], 'aq', 'state')})
UNION ALL
SELECT 'dispatch_queue', 'analyzed', state, n FROM ({_zero_sql('state', ['QUEUED', 'LEASED', 'DONE'], 'dq', 'state')})""")
def q_queue_state_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Queue state counts of both queues, zero-filled."""
    return M.queue_state_counts(_aq(spark, sf), _dq(spark, sf))


@register("status_counts", lambda: _w(O.v_status()) + _zero_sql(
    "status", ["NEW", "ANALYZED", "DISPATCHED", "FAILED"], "v_status", "status"))
def q_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Item counts per status, zero-filled."""
    return M.status_counts(V.v_status(spark, sf))


@register("derived_state_counts", lambda: _w(AQ, O.v_status(), rec=True) + ", d2 AS (" + _d2_sql() + ")\n" +
          _zero_sql("queue_state", ["not_enqueued_raw", "queued_raw", "inflight_raw", "processed_raw",
                                    "not_enqueued_analyzed", "queued_analyzed", "dispatched", "failed", "unknown"],
                    "d2", "queue_state"))
def q_derived_state_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per derived queue state, zero-filled over nine states."""
    return M.derived_state_counts(V.v_status(spark, sf), _aq(spark, sf))


@register("feed_report", lambda: _w(O.v_feeds(), O.v_status()) + f""", c AS (
  SELECT source_feed_url AS feed_url, count(*) AS items_count FROM v_status GROUP BY 1)
SELECT f.feed_url, f.enabled, coalesce(f.failure_count, 0) AS failure_count, f.down_until,
  CASE WHEN NOT f.enabled THEN 'disabled' WHEN f.down_until IS NOT NULL AND f.down_until > {TSN} THEN 'broken' ELSE 'ok' END AS health_status,
  CASE WHEN NOT f.enabled THEN 'feed disabilitato' WHEN f.down_until IS NOT NULL AND f.down_until > {TSN}
       THEN 'feed in errore (cooldown attivo)' ELSE '' END AS health_reason,
  {O.source_label('f.feed_url')} AS source_label, coalesce(c.items_count, 0) AS items_count
FROM v_feeds f LEFT JOIN c USING (feed_url)""")
def q_feed_report(spark: SparkSession, sf: str) -> DataFrame:
    """Feed list with state, health and item counts (one aggregate + join)."""
    f = V.v_feeds(spark, sf)
    return M.feed_report(f.select("feed_url", "enabled"), f.select("feed_url", "failure_count", "down_until"),
                         V.v_status(spark, sf), NOW)


@register("queue_monitor", lambda: _w(AQ, DQ, O.v_status(), rec=True) + f""", x AS (SELECT
  (SELECT count(*) FILTER (WHERE state = 'QUEUED') FROM aq) AS raw_backlog,
  (SELECT count(*) FILTER (WHERE state = 'LEASED') FROM aq) AS raw_inflight,
  (SELECT count(*) FILTER (WHERE state = 'QUEUED') FROM dq) AS analyzed_backlog,
  (SELECT count(*) FILTER (WHERE state = 'LEASED') FROM dq) AS analyzed_inflight,
  (SELECT count(*) FILTER (WHERE status = 'FAILED') FROM v_status) AS failed,
  (SELECT count(*) FILTER (WHERE status = 'DISPATCHED' AND dispatched_at IS NOT NULL) FROM v_status) AS dispatched_total,
  (SELECT count(*) FILTER (WHERE state IN ('QUEUED', 'LEASED') AND enqueued_at <= {TSN} - INTERVAL 10 MINUTE) FROM aq) AS stuck_new_10m,
  (SELECT count(*) FILTER (WHERE status = 'ANALYZED' AND analyzed_at < {TSN} - INTERVAL 10 MINUTE) FROM v_status) AS stuck_analyzed_10m,
  (SELECT count(*) FILTER (WHERE created_at >= {TSN} - INTERVAL 5 MINUTE) FROM v_status) AS new_last_5m,
  (SELECT count(*) FILTER (WHERE dispatched_at >= {TSN} - INTERVAL 5 MINUTE) FROM v_status) AS dispatched_last_5m)
SELECT *, (stuck_new_10m > 0 AND raw_backlog > 0) AS consumer_blocked_raw,
          (stuck_analyzed_10m > 0 AND analyzed_backlog > 0) AS consumer_blocked_analyzed FROM x""")
def q_queue_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """One-row queue monitor."""
    return M.queue_monitor(V.v_status(spark, sf), _aq(spark, sf), _dq(spark, sf), NOW)


def _minute_sql(col: str, since: str) -> str:
    return (f"SELECT date_trunc('minute', {col}) AS minute, count(*) AS n FROM v_status "
            f"WHERE {col} IS NOT NULL AND {col} >= {since} GROUP BY 1")


@register("minute_counts", lambda: _w(O.v_status()) + _minute_sql("created_at", O.ts("2024-01-30 00:00:00")))
def q_minute_counts(spark: SparkSession, sf: str) -> DataFrame:
    """New items per minute since a given time."""
    return M.minute_counts(V.v_status(spark, sf), "created_at", "2024-01-30 00:00:00")


@register("ratio_series", lambda: _w(O.v_status()) + f""", g AS (
  SELECT date_trunc('minute', {TSN}) - INTERVAL 179 MINUTE + to_minutes(i) AS minute FROM range(180) t(i)),
nw AS ({_minute_sql('created_at', f"date_trunc('minute', {TSN}) - INTERVAL 179 MINUTE")}),
dp AS ({_minute_sql('dispatched_at', f"date_trunc('minute', {TSN}) - INTERVAL 179 MINUTE")})
SELECT g.minute, coalesce(nw.n, 0) AS new_count, coalesce(dp.n, 0) AS dispatched_count,
  CASE WHEN coalesce(dp.n, 0) > 0 THEN round(CAST(coalesce(nw.n, 0) AS DOUBLE) / dp.n, 6) END AS ratio
FROM g LEFT JOIN nw USING (minute) LEFT JOIN dp USING (minute)""")
def q_ratio_series(spark: SparkSession, sf: str) -> DataFrame:
    """Dense 180-minute new/dispatched ratio series."""
    return M.ratio_series(V.v_status(spark, sf), NOW, 180)


@register("lane_counts", lambda: _w(AQ, DQ, O.v_status(), rec=True) + ", b AS (" + _board_sql() + ")\n" + """
SELECT z.lane, CASE z.lane WHEN 'raw_backlog' THEN 'Raw Backlog' WHEN 'raw_inflight' THEN 'Raw Inflight'
  WHEN 'analyzed_backlog' THEN 'Analyzed Backlog' WHEN 'analyzed_inflight' THEN 'Analyzed Inflight'
  WHEN 'failed' THEN 'Failed' WHEN 'anomalies' THEN 'Anomalies' END AS title, z.n FROM (""" + _zero_sql(
    "lane", ["raw_backlog", "raw_inflight", "analyzed_backlog", "analyzed_inflight", "failed", "anomalies"],
    "(SELECT * FROM b WHERE lane <> '')", "lane") + ") z")
def q_lane_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Items per board lane, zero-filled."""
    return M.lane_counts(_board(spark, sf))


@register("board_lanes", lambda: _w(AQ, DQ, O.v_status(), rec=True) + ", b AS (" + _board_sql() + ")\n" + """
SELECT *, CAST(row_number() OVER (PARTITION BY lane ORDER BY priority, fifo_ts NULLS FIRST, created_at NULLS FIRST, id) AS INTEGER) AS rank
FROM b WHERE lane <> '' QUALIFY rank <= 20""")
def q_board_lanes(spark: SparkSession, sf: str) -> DataFrame:
    """H2: per-lane top 20 board items (two-stage skew-safe ranking)."""
    return M.board_lanes(_board(spark, sf), 20)


@register("feed_items_page", lambda: _w(AQ, O.v_status(), rec=True) + ", d AS (" + _d2_sql().replace(
    "SELECT s.id, s.status,", "SELECT s.id, s.created_at, s.title, s.url, s.source_feed_url, s.status,") + ")\n" + """
SELECT id, created_at, title, url, status, queue_state, raw_enqueued, analyzed_enqueued, has_analyzed FROM d
WHERE source_feed_url = 'https://src3.example.org/feed' ORDER BY created_at DESC NULLS LAST, id LIMIT 100""")
def q_feed_items_page(spark: SparkSession, sf: str) -> DataFrame:
    """H3: newest 100 items of one feed with state and flags."""
    return M.feed_items_page(V.v_status(spark, sf), _aq(spark, sf), "https://src3.example.org/feed", 100)


@register("rate_windows", lambda: """WITH w AS (
  SELECT event_type, date_trunc('minute', CAST(ts AS TIMESTAMP)) - to_minutes(k) AS window_start
  FROM events, range(5) r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS n,
       round(count(*) / 300.0, 6) AS per_second FROM w GROUP BY 1, 2, 3""")
def q_rate_windows(spark: SparkSession, sf: str) -> DataFrame:
    """5-minute sliding (1-minute step) per-second rates by event type."""
    e = read_table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return M.rate_windows(e, "ts", "event_type")


def _lat_sql() -> str:
    secs = "(epoch_us({b}) - epoch_us({a})) / 1e6"
    parts = [("analyze", "created_at", "analyzed_at"), ("dispatch", "analyzed_at", "dispatched_at"),
             ("end_to_end", "created_at", "dispatched_at")]
    u = " UNION ALL ".join(f"SELECT '{n}' AS stage, {secs.format(a=a, b=b)} AS s FROM v_status" for n, a, b in parts)
    return f"d AS ({u})"


@register("stage_latency", lambda: _w(O.v_status(), _lat_sql()) + """
SELECT stage, count(*) AS n, round(avg(s), 6) AS mean_s, round(min(s), 6) AS min_s, round(max(s), 6) AS max_s
FROM d WHERE s IS NOT NULL GROUP BY stage""")
def q_stage_latency(spark: SparkSession, sf: str) -> DataFrame:
    """Per-stage latency from item timestamps (replaces the zero-duration metric)."""
    return M.stage_latency(V.v_status(spark, sf))


@register("stage_latency_p95", lambda: _w(O.v_status(), _lat_sql()) + """
SELECT stage, count(*) AS n, quantile_disc(s, 0.5) AS p50_s, quantile_disc(s, 0.95) AS p95_s
FROM d WHERE s IS NOT NULL GROUP BY stage""")
def q_stage_latency_p95(spark: SparkSession, sf: str) -> DataFrame:
    """Exact p50/p95 per stage."""
    return M.stage_latency_p95(V.v_status(spark, sf))


@register("stage_latency_windows", lambda: _w(O.v_status(), _lat_sql().replace(" AS stage, ", " AS stage, created_at, analyzed_at, dispatched_at, ")) + """,
a AS (SELECT stage, CASE WHEN stage = 'analyze' THEN analyzed_at ELSE dispatched_at END AS ended, s FROM d WHERE s IS NOT NULL),
b AS (SELECT stage, date_trunc('minute', ended) AS minute, CASE WHEN s > 0 THEN CAST(ceil(round(ln(s) / ln(1.02), 9)) AS INTEGER) END AS bucket, count(*) AS n
  FROM a WHERE ended IS NOT NULL GROUP BY 1, 2, 3),
w AS (SELECT stage, minute + to_minutes(k) AS until, bucket, sum(n) AS n FROM b, range(1, 6) r(k) GROUP BY 1, 2, 3),
u AS (SELECT *, sum(n) OVER (PARTITION BY stage, until) AS total, sum(n) OVER (PARTITION BY stage, until ORDER BY bucket NULLS FIRST) AS cum,
  coalesce(2 / 2.02 * pow(1.02, bucket), 0) AS middle FROM w)
SELECT stage AS series, until, CAST(max(total) AS BIGINT) AS n, round(min(middle) FILTER (WHERE cum >= ceil(0.5 * total - 1e-9)), 6) AS p50_s,
  round(min(middle) FILTER (WHERE cum >= ceil(0.95 * total - 1e-9)), 6) AS p95_s FROM u GROUP BY stage, until""")
def q_stage_latency_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Five-minute p50 and p95 per stage, one window a minute, from per-minute sketches."""
    return M.stage_latency_windows(V.v_status(spark, sf)).select("series", "until", "n", F.round("p50_s", 6).alias("p50_s"), F.round("p95_s", 6).alias("p95_s"))


@register("counter_rates", lambda: """WITH e AS (SELECT event_type AS series, epoch_us(CAST(ts AS TIMESTAMP)) / 1e6 AS t, event_id AS o,
    row_number() OVER (PARTITION BY event_type, epoch_us(CAST(ts AS TIMESTAMP)) // 21600000000 ORDER BY ts, event_id) AS v FROM events),
w AS (SELECT *, CAST(floor(t / 60) AS BIGINT) + k AS pane FROM e, range(5) r(k)),
x AS (SELECT *, lag(v) OVER (PARTITION BY series, pane ORDER BY t, o) AS pv FROM w),
g AS (SELECT series, pane, count(*) AS n, min(t) AS t1, max(t) AS t2, list(v ORDER BY t, o)[1] AS v1,
  CAST(sum(CASE WHEN pv IS NULL THEN 0 WHEN v < pv THEN v ELSE v - pv END) AS DOUBLE) AS up FROM x GROUP BY series, pane),
f AS (SELECT *, t2 - t1 AS sampled, (t2 - t1) / (n - 1) AS mean, (pane + 1) * 60 - t2 AS to_end,
  least(t1 - (pane - 4) * 60, CASE WHEN up > 0 THEN (t2 - t1) * v1 / up ELSE t1 - (pane - 4) * 60 END) AS to_start FROM g WHERE n > 1 AND t2 > t1)
SELECT series, TIMESTAMP '1970-01-01 00:00:00' + to_seconds((pane + 1) * 60) AS until, n, up AS increase,
  round(up * (sampled + CASE WHEN to_start < mean * 1.1 THEN to_start ELSE mean / 2 END
                      + CASE WHEN to_end < mean * 1.1 THEN to_end ELSE mean / 2 END) / sampled / 300.0, 6) AS per_second FROM f""")
def q_counter_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of counters that restart every six hours, from cumulative samples."""
    e = read_table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")
    block = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 21600000000)
    samples = e.withColumn("value", F.row_number().over(Window.partitionBy("event_type", block).orderBy("ts", "event_id")))
    return M.counter_rates(samples, "event_type", "ts", "value", "event_id").withColumn("per_second", F.round("per_second", 6))


@register("stage_latency_tail", lambda: _w(O.v_status(), _lat_sql()) + """
, t AS (SELECT stage, CASE WHEN s = max(s) OVER (PARTITION BY stage) THEN s * 1e6 ELSE s END AS s FROM d WHERE s IS NOT NULL)
SELECT stage, count(*) AS n, quantile_disc(s, 0.5) AS p50_s, quantile_disc(s, 0.95) AS p95_s, quantile_disc(s, 1.0) AS most_s FROM t GROUP BY stage""")
def q_stage_latency_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentiles where the largest latencies are a million times as large."""
    d = M._stage_durations(V.v_status(spark, sf))
    most = d.groupBy("stage").agg(F.max("s").alias("m"))
    tail = d.join(most, "stage").select("stage", F.when(F.col("s") == F.col("m"), F.col("s") * 1e6).otherwise(F.col("s")).alias("s"))
    return M.exact_percentiles(tail, "stage", "s", {"p50_s": 0.5, "p95_s": 0.95, "most_s": 1.0})


@register("sla_report", lambda: _w(O.v_status()) + """
SELECT week, items, dispatched, dispatched_5m, with_payload,
  CASE WHEN dispatched > 0 THEN round(dispatched_5m / dispatched, 6) END AS share_5m,
  round(with_payload / items, 6) AS payload_share
FROM (SELECT date_trunc('week', created_at) AS week, count(*) AS items,
        count(*) FILTER (WHERE dispatched_at IS NOT NULL) AS dispatched,
        count(*) FILTER (WHERE dispatched_at IS NOT NULL AND epoch_us(dispatched_at) - epoch_us(created_at) <= 300000000) AS dispatched_5m,
        count(*) FILTER (WHERE trim(coalesce(analyzed_payload_json, '')) <> '') AS with_payload
      FROM v_status GROUP BY 1)""")
def q_sla_report(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly SLA ratios (dispatch within 5 minutes, stored payloads)."""
    return M.sla_report(V.v_status(spark, sf))


# ====================================================================== E5 / E6 / H
@register("due_feeds", lambda: _w(O.v_feeds()) + f""", reg AS (
  SELECT feed_url, false AS force FROM v_feeds WHERE enabled AND NOT coalesce({TSN} < down_until, false)),
req AS (SELECT feed_url, true AS force FROM v_feeds WHERE requested_at IS NOT NULL AND trim(feed_url) <> ''
        ORDER BY requested_at NULLS FIRST, feed_url LIMIT 20)
SELECT feed_url, max(force) AS force FROM (SELECT * FROM reg UNION ALL SELECT * FROM req) GROUP BY feed_url""")
def q_due_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """E5: feeds due for polling plus forced requests."""
    f = V.v_feeds(spark, sf)
    return ingest.due_feeds(f.select("feed_url", "enabled"), f.select("feed_url", "down_until"),
                            f.filter(F.col("requested_at").isNotNull()).select("feed_url", "requested_at"), NOW)


@register("duplicate_rate", lambda: _w(O.v_doc_items()) + f""", h AS (
  SELECT feed_url, row_number() OVER (PARTITION BY {O.item_hash('guid', 'url', 'title')} ORDER BY feed_url, pos) AS rn
  FROM v_doc_items)
SELECT feed_url, count(*) FILTER (WHERE rn = 1) AS enqueued, count(*) FILTER (WHERE rn > 1) AS duplicate,
       CAST(0 AS BIGINT) AS error, count(*) AS total, round(count(*) FILTER (WHERE rn > 1) / count(*), 6) AS duplicate_rate
FROM h GROUP BY feed_url""")
def q_duplicate_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Enqueued / duplicate counts per feed from the hash dedupe of document items."""
    d = V.v_doc_items(spark, sf).select(T.item_hash("guid", "url", "title").alias("id"), "feed_url", "pos")
    firsts = ingest.dedupe_hash(d).select("id", "feed_url", "pos", F.lit(True).alias("_first"))
    o = d.join(firsts, ["id", "feed_url", "pos"], "left").select(
        "feed_url", F.when(F.col("_first"), "enqueued").otherwise("duplicate").alias("outcome"))
    return ingest.duplicate_rate(o).withColumn("error", F.col("error").cast("long"))


@register("seen_keys", lambda: _w(O.v_doc_items()) + f"""
SELECT DISTINCT key FROM (
  SELECT 'u:' || {O.norm_url('url')} AS key FROM v_doc_items
  UNION ALL SELECT 't:' || {O.norm_title('title')} FROM v_doc_items)""")
def q_seen_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Seen-key set (pending + processed) from document items."""
    d = V.v_doc_items(spark, sf)
    pending = d.select("guid", T.normalize_url(F.col("url")).alias("url"), T.normalize_title("title").alias("title_norm"))
    return ingest.seen_keys(pending)


@register("retention", lambda: _w(O.v_status()) + f"""
SELECT id, created_at FROM v_status WHERE created_at IS NULL OR created_at >= {TSN} - INTERVAL 168 HOUR""")
def q_retention(spark: SparkSession, sf: str) -> DataFrame:
    """H4: items kept by a 168 h retention at the monitor clock."""
    return ingest.retention(V.v_status(spark, sf), NOW, 168).select("id", "created_at")


@register("retention_orphans", lambda: _w(AQ, O.v_status(), rec=True) + f""", k AS (
  SELECT id FROM v_status WHERE created_at IS NULL OR created_at >= {TSN} - INTERVAL 168 HOUR)
SELECT item_id, state FROM aq WHERE item_id NOT IN (SELECT id FROM k)""")
def q_retention_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """H4/Q10: queue rows left without their item after retention."""
    kept = ingest.retention(V.v_status(spark, sf), NOW, 168)
    return ingest.retention_orphans(_aq(spark, sf).select("item_id", "state"), kept)


@register("feed_list_sorted", lambda: _w(O.v_feeds()) + "SELECT feed_url FROM v_feeds WHERE enabled")
def q_feed_list_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """H7: enabled feeds ordered by url."""
    return ingest.feed_list_sorted(V.v_feeds(spark, sf))


@register("delete_items", lambda: _w(AQ, O.v_status(), rec=True) + """, r AS (
  SELECT DISTINCT CAST(user_id * 67 AS VARCHAR) AS id FROM events)
SELECT 'not_found' AS part, id FROM r WHERE id NOT IN (SELECT id FROM v_status) AND id NOT IN (SELECT item_id FROM aq)
UNION ALL SELECT 'kept_item', id FROM v_status WHERE id NOT IN (SELECT id FROM r)
UNION ALL SELECT 'kept_queue', item_id FROM aq WHERE item_id NOT IN (SELECT id FROM r)""")
def q_delete_items(spark: SparkSession, sf: str) -> DataFrame:
    """H5: cascade delete over items and the raw queue: what stays, and the unknown ids."""
    out = L.delete_items(_requeue_ids(spark, sf),
                         {"items": (V.v_status(spark, sf), "id"), "aq": (_aq(spark, sf), "item_id")})
    parts = [out["not_found"].select(F.lit("not_found").alias("part"), "id"),
             out["items"].select(F.lit("kept_item").alias("part"), "id"),
             out["aq"].select(F.lit("kept_queue").alias("part"), F.col("item_id").alias("id"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("backoff_plan", lambda: _w(O.v_status()) + """
SELECT id, CAST(a AS INTEGER) AS attempt, 2.0 * pow(2, a - 1) AS delay_s, created_at + to_microseconds(CAST(2.0 * pow(2, a - 1) * 1e6 AS BIGINT)) AS retry_at
FROM v_status, range(1, 4) t(a) WHERE status = 'FAILED'""")
def q_backoff_plan(spark: SparkSession, sf: str) -> DataFrame:
    """H8: retry plan (3 attempts, 2 s base, doubling) for failed items."""
    f = V.v_status(spark, sf).filter(F.col("status") == "FAILED").select("id", F.col("created_at").alias("ts"))
    return L.backoff_plan(f, 3, 2.0).select("id", "attempt", "delay_s", F.col("retry_at"))


@register("cascade_orphans", lambda: _w(AQ, O.v_status(), rec=True) + """
SELECT item_id FROM aq WHERE item_id NOT IN (SELECT id FROM v_status WHERE status <> 'FAILED')
UNION ALL SELECT 'item:' || id FROM v_status WHERE status <> 'FAILED' AND id NOT IN (SELECT item_id FROM aq)""")
def q_cascade_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """H9: raw-queue rows without a live item, and live items without a queue row."""
    live = V.v_status(spark, sf).filter(F.col("status") != "FAILED").select("id")
    q_orph, i_orph = L.cascade_orphans(live, _aq(spark, sf).select("item_id"))
    return q_orph.unionByName(i_orph.select(F.concat(F.lit("item:"), "id").alias("item_id")))


@register("job_counters", lambda: """
SELECT 'analyze' AS stage, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'cached' ELSE 'success' END AS outcome,
       CASE WHEN event_type = 'error' THEN 'analysis_failed' ELSE '' END AS reason, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def q_job_counters(spark: SparkSession, sf: str) -> DataFrame:
    """processed/failed counters by outcome and reason."""
    e = read_table(spark, sf, "events").select("event_type")
    o = e.select(F.lit("analyze").alias("stage"),
                 F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "cached")
                 .otherwise("success").alias("outcome"),
                 F.when(F.col("event_type") == "error", "analysis_failed").otherwise("").alias("reason"))
    return M.job_counters(o)


@register("runtime_latest", lambda: f"""WITH s AS (
  SELECT 'analyzer-' || CAST(user_id % 4 AS VARCHAR) AS worker_id, CAST(ts AS TIMESTAMP) AS updated_at,
         'model-' || CAST(event_id % 3 AS VARCHAR) AS model FROM events),
l AS (SELECT worker_id, max({{'updated_at': updated_at, 'model': model}}) AS m FROM s GROUP BY worker_id),
r AS (SELECT worker_id, m.model AS model, m.updated_at AS updated_at FROM l WHERE m.updated_at >= {TSN} - INTERVAL 20 MINUTE)
SELECT worker_id, model, updated_at FROM r
UNION ALL SELECT NULL, '', NULL WHERE NOT EXISTS (SELECT 1 FROM r)""")
def q_runtime_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest runtime snapshot per worker within 20 minutes, else a default row."""
    e = read_table(spark, sf, "events").select("event_id", "ts", "user_id")
    snaps = e.select(F.concat(F.lit("analyzer-"), (F.col("user_id") % 4).cast("string")).alias("worker_id"),
                     F.col("ts").cast("timestamp_ntz").alias("updated_at"),
                     F.concat(F.lit("model-"), (F.col("event_id") % 3).cast("string")).alias("model"))
    for c, v in M.RUNTIME_DEFAULT.items():
        if c != "model":
            snaps = snaps.withColumn(c, F.lit(v))
    return M.runtime_latest(snaps, NOW, 20).select("worker_id", "model", "updated_at")

