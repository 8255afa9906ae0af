"""Registered queries: one per operator of the inventory, each with the
DuckDB oracle text where the result is expressible in SQL.

Every query reads the driver tables through the adapter views, so its work
grows with the tables.  Arrays are emitted as space-joined text and doubles
rounded to 6 places so the two engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.operators import ingest
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.sources.tables import read_pages, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _arr_text(c) -> F.Column:
    return F.array_join(c, " ")


# ====================================================================== ingest
def _stored_items(spark, sf):
    items = V.v_items(spark, sf).filter(F.col("published") < F.lit(V.STORED_BEFORE).cast("timestamp_ntz"))
    return items.select(T.item_hash("guid", "url", "title").alias("id"))


_ITEM_OUT = ["id", "feed_url", "source_label", "guid", "url", "title", "links", "image_urls",
             "published_at", "fetched_at", "pos"]


def _items_out(df: DataFrame) -> DataFrame:
    return df.select(*[(_arr_text(F.col(c)).alias(c) if c in ("links", "image_urls") else F.col(c))
                       for c in _ITEM_OUT])


def _sql_ingest(cap: int) -> str:
    return O.with_(O.v_items(), O.raw_items(), f"""stored AS (
  SELECT DISTINCT id FROM raw WHERE published_at < {O.ts(V.STORED_BEFORE)}),
firsts AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY feed_url, pos) = 1),
fresh AS (SELECT * FROM firsts WHERE id NOT IN (SELECT id FROM stored)),
capped AS (SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= {cap})""") + \
        "SELECT " + ", ".join(_ITEM_OUT) + " FROM capped"


@register("ingest_items", lambda: _sql_ingest(100))
def q_ingest_items(spark: SparkSession, sf: str) -> DataFrame:
    """A3 + B1-B8 + E1 + H1 (default cap 100): new items of one poll."""
    batch = V.v_items(spark, sf)
    return _items_out(ingest.ingest_items(batch, _stored_items(spark, sf), V.NOW_ITEMS, 100))


@register("cap_per_feed", lambda: _sql_ingest(1))
def q_cap_per_feed(spark: SparkSession, sf: str) -> DataFrame:
    """H1 with a binding cap of one new item per feed."""
    batch = V.v_items(spark, sf)
    return _items_out(ingest.ingest_items(batch, _stored_items(spark, sf), V.NOW_ITEMS, 1))


def label_counts(items: DataFrame) -> DataFrame:
    """Per source label: items, links, images, newest publication."""
    return items.groupBy("source_label").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.size("links")).alias("n_links"),
        F.sum(F.size("image_urls")).alias("n_images"),
        F.max("published_at").alias("last_published"))


@register("label_counts", lambda: O.with_(O.v_items(), O.raw_items(), f"""stored AS (
  SELECT DISTINCT id FROM raw WHERE published_at < {O.ts(V.STORED_BEFORE)}),
firsts AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY feed_url, pos) = 1),
fresh AS (SELECT * FROM firsts WHERE id NOT IN (SELECT id FROM stored)),
capped AS (SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= 100)""") + """
SELECT source_label, count(*) AS n_items,
       CAST(sum(CASE WHEN links = '' THEN 0 ELSE len(string_split(links, ' ')) END) AS BIGINT) AS n_links,
       CAST(sum(CASE WHEN image_urls = '' THEN 0 ELSE len(string_split(image_urls, ' ')) END) AS BIGINT) AS n_images,
       max(published_at) AS last_published
FROM capped GROUP BY source_label""")
def q_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: ingest one poll of page items and count the new items per label."""
    batch = V.v_items(spark, sf)
    return label_counts(ingest.ingest_items(batch, _stored_items(spark, sf), V.NOW_ITEMS, 100))


@register("page_text", lambda: f"""SELECT page_id, url, {O.html_to_text('html')} AS text,
  CAST(length({O.html_to_text('html')}) AS INTEGER) AS n_chars FROM pages""")
def q_page_text(spark: SparkSession, sf: str) -> DataFrame:
    """A4 + B9 + B10: whole page body to plain text."""
    p = read_pages(spark, sf)
    return p.select("page_id", "url", T.html_to_text("html").alias("text")).withColumn(
        "n_chars", F.length("text"))


@register("page_excerpt_clamped", lambda: f"""SELECT page_id,
  {O.clamp(O.html_to_text('html'), 2500)} AS excerpt FROM pages""")
def q_page_excerpt_clamped(spark: SparkSession, sf: str) -> DataFrame:
    """B11 over B10: excerpt clamped to 2 500 code points."""
    p = read_pages(spark, sf)
    return p.select("page_id", T.clamp_text(T.html_to_text("html"), 2500).alias("excerpt"))


@register("dedupe_hash_docs", lambda: O.with_(O.v_doc_items(), f"""h AS (
  SELECT {O.item_hash('guid', 'url', 'title')} AS id, feed_url, pos, url, title FROM v_doc_items)""") + """
SELECT id, feed_url, pos, url, title FROM h
QUALIFY row_number() OVER (PARTITION BY id ORDER BY feed_url, pos) = 1""")
def q_dedupe_hash_docs(spark: SparkSession, sf: str) -> DataFrame:
    """E1 over document items (real exact copies): first occurrence per hash."""
    d = V.v_doc_items(spark, sf).select(
        T.item_hash("guid", "url", "title").alias("id"), "feed_url", "pos", "url", "title")
    return ingest.dedupe_hash(d)


def _benchmark_seen(spark, sf):
    b = read_table(spark, sf, "benchmark").select(
        F.split(F.col("text"), "\n", 2).getItem(0).alias("t"))
    return b.select(F.concat(F.lit("t:"), T.normalize_title("t")).alias("key")).distinct()


def _sql_dedupe_keys() -> str:
    title = "split_part(text, chr(10), 1)"
    g = O.trim_space("coalesce(guid, '')")
    return O.with_rec(O.v_doc_items(), f"""seen AS (SELECT DISTINCT 't:' || {O.norm_title(title)} AS key FROM benchmark),
k AS (SELECT feed_url, pos, url, title, row_number() OVER (ORDER BY feed_url, pos) AS rn,
        list_filter([CASE WHEN {g} <> '' THEN 'g:' || {g} END, 'u:' || {O.norm_url('url')},
                     't:' || {O.norm_title('title')}], lambda x: x IS NOT NULL) AS keys FROM v_doc_items),
ks AS (SELECT k.*, EXISTS (SELECT 1 FROM seen WHERE list_contains(k.keys, seen.key)) AS is_seen FROM k),
g(rn, acc_keys, accepted) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(NULL AS BOOLEAN)
  UNION ALL
  SELECT ks.rn,
    CASE WHEN NOT ks.is_seen AND NOT list_has_any(g.acc_keys, ks.keys) THEN list_concat(g.acc_keys, ks.keys)
         ELSE g.acc_keys END,
    NOT ks.is_seen AND NOT list_has_any(g.acc_keys, ks.keys)
  FROM g JOIN ks ON ks.rn = g.rn + 1)""") + """
SELECT ks.feed_url, ks.pos, ks.url, ks.title, g.accepted FROM ks JOIN g USING (rn)"""


@register("dedupe_keys_docs", _sql_dedupe_keys)
def q_dedupe_keys_docs(spark: SparkSession, sf: str) -> DataFrame:
    """E2 greedy three-key dedupe over document items; seen keys from ``benchmark``."""
    d = V.v_doc_items(spark, sf)
    return ingest.dedupe_keys(d, _benchmark_seen(spark, sf)).select("feed_url", "pos", "url", "title", "accepted")


from feedloom.plans import queries_state  # noqa: E402,F401  (registers state queries)
from feedloom.plans import queries_extract  # noqa: E402,F401  (registers extraction queries)
from feedloom.plans import queries_enrich  # noqa: E402,F401  (registers enrichment queries)
from feedloom.plans import queries_publish  # noqa: E402,F401  (registers publish queries)
from feedloom.plans import queries_sources  # noqa: E402,F401  (registers source queries)
from feedloom.plans import queries_more  # noqa: E402,F401  (registers remaining queries)
from feedloom.plans import queries_records  # noqa: E402,F401  (registers records and payloads)
from feedloom.plans import queries_stream  # noqa: E402,F401  (registers the continuous jobs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
