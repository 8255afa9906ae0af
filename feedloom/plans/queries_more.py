"""Registered queries: generator (A10, A11), URL checks (B2, B5, B26), offline completion (C11),
cold start (E3), analysed projection (F7), extraction counters (G15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.operators import enrich as N
from feedloom.operators import extract as X
from feedloom.operators import ingest
from feedloom.operators import lifecycle as L
from feedloom.operators import monitor as M
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import _benchmark_seen, _sql_dedupe_keys, register
from feedloom.sources import synth as Y
from feedloom.sources.tables import read_pages, read_table

BASE = "http://jobs.local"
NOW_EPOCH = "CAST(epoch(TIMESTAMP '" + V.NOW_EVENTS + "') AS BIGINT)"


def _slug_sql(x: str) -> str:
    s = f"translate(lower({O.trim_space(x)}), ' /_().,:', '---')"
    return f"trim(regexp_replace({s}, '-{{2,}}', '-', 'g'), '-')"


def _postings_sql(src: str) -> str:
    i = "idx"

    def pool(vals):
        return O._pick(vals, i)
    stack = " || ',' || ".join(f"{O._arr(fixed.SYNTH_STACK)}[({i} + {k}) % {len(fixed.SYNTH_STACK)} + 1]"
                               for k in range(4))
    company, role, region = pool(fixed.SYNTH_COMPANIES), pool(fixed.SYNTH_ROLES), pool(fixed.SYNTH_REGIONS)
    slug = _slug_sql(f"{company} || ' ' || {role} || ' ' || CAST({i} AS VARCHAR)")
    desc = fixed.SYNTH_DESCRIPTION.replace("'", "''").replace("{company}", "' || company || '").replace(
        "{role}", "' || role || '").replace("{region}", "' || region || '")
    return f"""g AS (SELECT {i} AS idx, published_at, {company} AS company, {role} AS role, {region} AS region,
    {slug} AS slug, {stack} AS stack FROM {src})
SELECT idx AS index, published_at, company, role, region, 'Remote (' || region || ')' AS location,
  CAST(95 + (idx % 5) * 10 AS INTEGER) AS salary_min_k, CAST(120 + (idx % 5) * 10 AS INTEGER) AS salary_max_k,
  slug, '{BASE}{fixed.SYNTH_JOBS_PATH}' || slug AS url, role || ' at ' || company AS title,
  '{desc}' AS description, '{fixed.SYNTH_CATEGORY}' AS category, '{fixed.SYNTH_CONTRACT}' AS contract_type,
  stack FROM g"""


def _synth(spark, sf):
    pos = read_table(spark, sf, "pages").select(F.col("page_id").alias("i"))
    return Y.synth_postings(pos, V.NOW_EVENTS, 300, BASE)


@register("synth_postings", lambda: f"""WITH s AS (
  SELECT ({NOW_EPOCH} // 300) * 300 - page_id * 300 AS slot_s FROM pages),
src AS (SELECT slot_s // 300 AS idx, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(slot_s) AS published_at FROM s),
""" + _postings_sql("src"))
def q_synth_postings(spark: SparkSession, sf: str) -> DataFrame:
    """A10 (+B25): one deterministic posting per page slot."""
    return _synth(spark, sf).withColumn("stack", F.array_join("stack", ","))


@register("posting_from_slug", lambda: f"""WITH s AS (
  SELECT ({NOW_EPOCH} // 300) * 300 - page_id * 300 AS slot_s, page_id FROM pages),
src AS (SELECT slot_s // 300 AS idx, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(slot_s) AS published_at, page_id
        FROM s WHERE page_id % 4 <> 0),
""" + _postings_sql("src"))
def q_posting_from_slug(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs -> regenerated posting, exact slug match required (every 4th slug is altered)."""
    pos = read_table(spark, sf, "pages").select(F.col("page_id").alias("i"))
    gen = Y.synth_postings(pos, V.NOW_EVENTS, 300, BASE, keep=("i",))
    req = gen.select(F.when(F.col("i") % 4 == 0, F.regexp_replace("slug", "^[a-z]+", "x"))
                     .otherwise(F.col("slug")).alias("slug"))
    return Y.posting_from_slug(req, 300, BASE).withColumn("stack", F.array_join("stack", ","))


@register("url_checks", lambda: f"""SELECT page_id, url,
  (lower(regexp_extract({O.trim_space('url')}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) IN ('http', 'https')
    AND NOT {O.parse_error(O.trim_space('url'))}) AS valid_feed,
  {O.norm_url('url')} AS normalized,
  {O.host("CASE WHEN contains(url, '://') THEN url ELSE 'http://' || url END")} AS host
FROM pages""")
def q_url_checks(spark: SparkSession, sf: str) -> DataFrame:
    """B2, B5, B26 over every page url."""
    p = read_table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", "url", T.valid_feed_url(F.col("url")).alias("valid_feed"),
                    T.normalize_url(F.col("url")).alias("normalized"),
                    T.endpoint_parts(F.col("url"))["host"].alias("host"))


@register("complete_offline", lambda: O.with_(O.v_doc_raw(), O.v_responses()) + """
SELECT d.id AS item_id, r.content FROM v_doc_raw d LEFT JOIN v_responses r ON r.item_id = d.id""")
def q_complete_offline(spark: SparkSession, sf: str) -> DataFrame:
    """C11 without a live client: prompts joined with the offline responses table."""
    p = X.build_prompts(V.v_doc_raw(spark, sf)).select(F.col("id").alias("item_id"), "prompt")
    return X.complete(p, responses=V.v_responses(spark, sf)).select("item_id", "content")


@register("cold_start_docs", lambda: _sql_dedupe_keys().replace(
    "SELECT ks.feed_url, ks.pos, ks.url, ks.title, g.accepted FROM ks JOIN g USING (rn)",
    """, acc AS (SELECT ks.feed_url, ks.pos, ks.guid_, ks.url, ks.title FROM ks JOIN g USING (rn) WHERE g.accepted)
SELECT feed_url, pos, url, title FROM acc QUALIFY row_number() OVER (PARTITION BY feed_url ORDER BY pos) <= 2""")
    .replace("SELECT feed_url, pos, url, title, row_number()", "SELECT feed_url, pos, guid AS guid_, url, title, row_number()"))
def q_cold_start_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Cold start over document items: all accepted marked seen, first 2 per feed enqueued."""
    enq, _marked = ingest.cold_start(V.v_doc_items(spark, sf), _benchmark_seen(spark, sf), 2)
    return enq.select("feed_url", "pos", "url", "title")


def _analyzed_log(spark, sf):
    a = V.v_analyzed(spark, sf).select("id", "job_category", "role", "company", "created_at")
    older = a.select("id", F.lit("").alias("job_category"), F.lit("old").alias("role"), "company",
                     (F.col("created_at") - F.make_dt_interval(days=F.lit(1))).alias("created_at"))
    blank = a.filter(F.col("id").cast("long") % 3 == 0).select(F.lit(" ").alias("id"), "job_category", "role",
                                                            "company", "created_at")
    newer_blank_cat = a.filter(F.col("id").cast("long") % 5 == 0).select(
        "id", F.lit(" ").alias("job_category"), "role", "company",
        (F.col("created_at") + F.make_dt_interval(days=F.lit(1))).alias("created_at"))
    return a.unionByName(older).unionByName(blank).unionByName(newer_blank_cat)


@register("analyzed_projection", lambda: O.with_(O.v_analyzed()) + """, a AS (SELECT id, job_category, role, company, created_at FROM v_analyzed),
lg AS (SELECT * FROM a
  UNION ALL SELECT id, '', 'old', company, created_at - INTERVAL 1 DAY FROM a
  UNION ALL SELECT ' ', job_category, role, company, created_at FROM a WHERE CAST(id AS BIGINT) % 3 = 0
  UNION ALL SELECT id, ' ', role, company, created_at + INTERVAL 1 DAY FROM a WHERE CAST(id AS BIGINT) % 5 = 0),
l AS (SELECT * FROM lg WHERE trim(id) <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC) = 1)
SELECT id, created_at, CASE WHEN trim(job_category) = '' THEN 'Altri ruoli' ELSE trim(job_category) END AS job_category,
  role, company FROM l""")
def q_analyzed_projection(spark: SparkSession, sf: str) -> DataFrame:
    """latest analysed record per id; blank ids dropped; blank category -> default."""
    return L.analyzed_projection(_analyzed_log(spark, sf)).select("id", "created_at", "job_category", "role",
                                                                  "company")


def _extractions(spark, sf):
    items = V.v_items(spark, sf).select("pos", "url")
    ex = N.page_excerpt_basic(items, read_pages(spark, sf), 2500)
    return ex.select(F.when(F.col("excerpt_reason") == "", "ok").otherwise(F.col("excerpt_reason")).alias("result"),
                     F.floor(F.length("excerpt") / 10).cast("int").alias("duration_ms"))


_EXTRACT = f"""t AS (
  SELECT i.url, p.url AS purl, {O.clamp(O.html_to_text('p.html'), 2500)} AS txt
  FROM v_items i LEFT JOIN (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1) p ON p.url = i.url),
r AS (SELECT CASE WHEN lower(regexp_extract({O.trim_space('url')}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) NOT IN ('http', 'https')
  THEN 'unsupported_scheme' WHEN purl IS NULL THEN 'fetch_failed' WHEN txt = '' THEN 'empty_text' ELSE 'ok' END AS result,
  CASE WHEN purl IS NOT NULL AND txt <> '' THEN CAST(floor(length(txt) / 10) AS INTEGER) ELSE 0 END AS duration_ms FROM t)"""


@register("extract_counters", lambda: O.with_(O.v_items()) + f""", {_EXTRACT}
SELECT result, count(*) AS n, round(avg(duration_ms), 6) AS mean_ms, min(duration_ms) AS min_ms,
       max(duration_ms) AS max_ms FROM r GROUP BY result""")
def q_extract_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction outcomes by result (duration = text-size proxy)."""
    return M.extract_counters(_extractions(spark, sf))


@register("extract_duration_p95", lambda: O.with_(O.v_items()) + f""", {_EXTRACT}
SELECT result, quantile_disc(duration_ms, 0.95) AS p95_ms FROM r GROUP BY result""")
def q_extract_duration_p95(spark: SparkSession, sf: str) -> DataFrame:
    """Exact p95 duration per result."""
    return M.extract_duration_p95(_extractions(spark, sf))


@register("sla_duplicates", lambda: O.with_(O.v_doc_items()) + f""", h AS (
  SELECT published, row_number() OVER (PARTITION BY {O.item_hash('guid', 'url', 'title')} ORDER BY feed_url, pos) AS rn
  FROM v_doc_items)
SELECT date_trunc('week', published) AS week, count(*) AS items, count(*) FILTER (WHERE rn > 1) AS duplicates,
       round(count(*) FILTER (WHERE rn > 1) / count(*), 6) AS duplicate_share FROM h GROUP BY 1""")
def q_sla_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly duplicate share from the hash dedupe of document items."""
    d = V.v_doc_items(spark, sf).select(T.item_hash("guid", "url", "title").alias("id"), "feed_url", "pos",
                                         "published")
    firsts = ingest.dedupe_hash(d).select("id", "feed_url", "pos", F.lit(True).alias("_first"))
    o = d.join(firsts, ["id", "feed_url", "pos"], "left").select(
        "published", F.when(F.col("_first"), "enqueued").otherwise("duplicate").alias("outcome"))
    return M.sla_duplicates(o)


@register("sla_quality", lambda: O.with_(O.v_analyzed()) + f""", c AS (SELECT
  count(*) AS items,
  count(*) FILTER (WHERE {O.trim_space("coalesce(role, '')")} <> '' AND {O.trim_space("coalesce(company, '')")} <> ''
    AND ({O.trim_space("coalesce(location, '')")} <> '' OR {O.trim_space("coalesce(remote_type, '')")} <> '')
    AND {O.trim_space("coalesce(summary_it, '')")} <> '') AS complete,
  count(*) FILTER (WHERE len(original_links) > 0) AS with_links,
  count(*) FILTER (WHERE len(original_images) > 0) AS with_images FROM v_analyzed)
SELECT *, round(complete / items, 6) AS completeness, round(with_links / items, 6) AS link_coverage,
       round(with_images / items, 6) AS image_coverage FROM c""")
def q_sla_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Completeness and link/image coverage of analysed items."""
    return M.sla_quality(V.v_analyzed(spark, sf))


@register("feed_list", lambda: f"""WITH l AS (SELECT doc_id AS pos, CASE WHEN doc_id % 5 = 0 THEN '# ' || source WHEN doc_id % 7 = 0 THEN '  '
  ELSE ' https://' || source || '.example.org/' || (doc_id // 2) || '/feed ' END AS line FROM documents)
SELECT min(pos) AS pos, {O.trim_space('line')} AS feed_url FROM l
WHERE {O.trim_space('line')} <> '' AND NOT starts_with({O.trim_space('line')}, '#') GROUP BY 2""")
def q_feed_list(spark: SparkSession, sf: str) -> DataFrame:
    """A1: a feed list of one line per document: comments and blanks skipped, first position wins."""
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    i = F.col("doc_id")
    line = F.when(i % 5 == 0, F.concat(F.lit("# "), "source")).when(i % 7 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" https://"), "source", F.lit(".example.org/"), F.floor(i / 2).cast("string"), F.lit("/feed ")))
    return ingest.feed_lines(d.select(i.alias("pos"), line.alias("line")))
