"""Registered queries for sources: feed documents, payloads, text times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import ingest
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import register
from feedloom.sources import feeds as S
from feedloom.sources.tables import read_table

_XWS = "'^[ \\t\\n\\r]+|[ \\t\\n\\r]+$'"


@register("feed_items_xml", lambda: O.with_(O.v_items()) + f"""
SELECT feed_url, pos, 0 AS position, regexp_replace(guid, {_XWS}, '', 'g') AS guid,
       regexp_replace(title, {_XWS}, '', 'g') AS title, url AS link, published, 0 AS n_content FROM v_items
UNION ALL SELECT feed_url, pos, 1, '', regexp_replace(title, {_XWS}, '', 'g'), url, NULL,
       CAST(length(regexp_replace(description, {_XWS}, '', 'g')) AS INTEGER) FROM v_items""")
def q_feed_items_xml(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + A3 dates: landed RSS documents of two entries parsed back into entries."""
    docs = S.rss_document(V.v_items(spark, sf))
    it = S.feed_items(docs, keep=("feed_url", "pos"))
    return it.select("feed_url", "pos", "position", "guid", "title", "link", "published",
                     F.length("content").alias("n_content"))


_FMT = 6


def _time_texts(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    k = F.col("event_id") % _FMT
    ts = F.col("ts")
    txt = (F.when(F.col("event_id") % 13 == 0, F.lit("n/a"))
           .when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(k == 1, F.concat(F.date_format(ts + F.make_dt_interval(hours=F.lit(2)), "yyyy-MM-dd'T'HH:mm:ss"),
                                  F.lit("+02:00")))
           .when(k == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" +0000 UTC")))
           .when(k == 3, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000 UTC")))
           .when(k == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
           .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", txt.alias("text"))


@register("parse_times", lambda: f"""
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL
  WHEN event_id % {_FMT} IN (0, 2, 4) THEN CAST(ts AS TIMESTAMP)
  ELSE date_trunc('second', CAST(ts AS TIMESTAMP)) END AS parsed FROM events""")
def q_parse_times(spark: SparkSession, sf: str) -> DataFrame:
    """Six text time layouts (fractions, offsets, zone names) -> UTC timestamps."""
    t = _time_texts(spark, sf)
    return t.select("event_id", S.parse_times(F.col("text")).alias("parsed"))


def _raw(spark, sf):
    return ingest.raw_items(V.v_items(spark, sf), V.NOW_ITEMS)


@register("payload_roundtrip", lambda: O.with_(O.v_items(), O.raw_items()) + """
SELECT pos AS item_id, id, feed_url, guid, url, title, links, published_at, fetched_at FROM raw""")
def q_payload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A6 then A5: RawItem -> JSON (omitempty) -> RawItem."""
    enc = S.encode_payload(_raw(spark, sf)).select(F.col("pos").alias("item_id"), "payload_json")
    good, _ = S.queue_payloads(enc)
    return good.select("item_id", "id", "feed_url", "guid", "url", "title",
                       F.array_join("links", " ").alias("links"), "published_at", "fetched_at")


@register("payload_invalid", lambda: O.with_(O.v_items()) + """
SELECT pos AS item_id, 'invalid_raw_payload' AS reason FROM v_items WHERE pos % 9 = 0""")
def q_payload_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """A5: undecodable payloads are diverted (every 9th payload is cut short)."""
    enc = S.encode_payload(_raw(spark, sf)).select(F.col("pos").alias("item_id"), "payload_json")
    enc = enc.withColumn("payload_json", F.when(F.col("item_id") % 9 == 0, F.substring("payload_json", 1, 40))
                         .otherwise(F.col("payload_json")))
    _, bad = S.queue_payloads(enc)
    return bad.select("item_id", "reason")
