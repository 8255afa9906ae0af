"""Registered queries for rendering and delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.operators import publish as P
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import register

NOW = V.NOW_EVENTS


def _join(lst: str, fn: str, sep: str) -> str:
    return f"array_to_string(list_transform(coalesce({lst}, []), lambda x: {fn}), {O.q(sep)})"


def _sql_default() -> str:
    first = "CASE WHEN len(original_links) > 0 THEN original_links[1] ELSE source_url END"
    tags = (f"CASE WHEN len(tags) > 0 THEN '- Tags: ' || {_join('tags', chr(39) + '#' + chr(39) + ' || ' + O.md('x'), ' ')}"
            f" || chr(10) ELSE '' END")
    links = (f"CASE WHEN len(original_links) > 0 THEN chr(10) || '*Link Originali*' || chr(10) || "
             f"{_join('original_links', chr(39) + '- ' + chr(39) + ' || x || chr(10)', '')} ELSE '' END")
    images = (f"CASE WHEN len(original_images) > 0 THEN chr(10) || '*Immagini*' || chr(10) || "
              f"{_join('original_images', chr(39) + '- ' + chr(39) + ' || x || chr(10)', '')} ELSE '' END")
    nl = "chr(10)"
    msg = (f"'{fixed.DEFAULT_LAYOUT_HEADER}' || {nl} || {O.md('source_label')} || {nl} || {nl} || {first} || {nl} || {nl}"
           f" || '*Categoria:* ' || {O.md('job_category')} || {nl} || '*' || {O.md('role')} || '* @ *' || {O.md('company')}"
           f" || '*' || {nl} || {O.md('summary_it')} || {nl} || {nl} || '- Seniority: ' || {O.md('seniority')}"
           f" || {nl} || '- Location: ' || {O.md('location')} || ' (' || {O.md('remote_type')} || ')'"
           f" || {nl} || '- Contratto: ' || {O.md('contract_type')} || {nl} || '- Salary: ' || {O.md('salary')}"
           f" || {nl} || '- Stack: ' || {_join('tech_stack', O.md('x'), ', ')} || {nl} || {tags} || {nl} || {nl}"
           f" || {links} || {nl} || {nl} || {images} || {nl} || {nl} || '[Annuncio originale](' || source_url || ')' || {nl}")
    return O.with_(O.v_analyzed()) + f"SELECT id, {msg} AS message FROM v_analyzed"


@register("render_default", _sql_default)
def q_render_default(spark: SparkSession, sf: str) -> DataFrame:
    """Default message layout with markdown escaping."""
    return P.render_messages(V.v_analyzed(spark, sf), "default").select("id", "message")


def _hashtags_sql(lst: str) -> str:
    tags = f"list_filter(list_transform(coalesce({lst}, []), lambda x: {O.norm_tag('x')}), lambda x: x <> '')"
    return f"array_to_string(list_transform({tags}, lambda x: ' #' || x), '')"


def _sql_chat() -> str:
    nl = "chr(10)"
    role = f"CASE WHEN coalesce(role, '') <> '' THEN {O.md('role')} ELSE {O.md('title')} END"
    line = "━" * 22
    msg = (f"'┏{line}' || {nl} || '┃ 🚀 *' || {role} || '*' || {nl} || '┃ 🏢 ' || {O.md('company')} || {nl} || '┃ 🏠 ' || {O.md('location')}"
           f" || {nl} || '┃ 💰 ' || {O.md('salary')} || {nl} || '┗{line}'"
           f" || CASE WHEN len(tech_stack) > 0 THEN {nl} || {nl} || '🧩 *Stack:*' || {_hashtags_sql('tech_stack')} ELSE '' END"
           f" || CASE WHEN coalesce(summary_it, '') <> '' THEN {nl} || {nl} || '📝 *Sintesi:*  ' || {nl} || {O.md('summary_it')} ELSE '' END"
           f" || {nl} || {nl} || '├ 📈 ' || {O.md('seniority')} || {nl} || '├ 🏷 ' || {O.md('contract_type')} || {nl} || '├ 🌍 ' || {O.md('language')}"
           f" || {nl} || '└ ⭐ ' || job_post_quality_rank || ' (' || CAST(job_post_quality_score AS VARCHAR) || '/100)'"
           f" || CASE WHEN len(tags) > 0 THEN {nl} || '🏷' || {_hashtags_sql('tags')} ELSE '' END"
           f" || {nl} || {nl} || '🔗 [candidati](' || source_url || ')' || {nl}")
    return O.with_(O.v_analyzed()) + f"SELECT id, {msg} AS message FROM v_analyzed"


@register("render_chat", _sql_chat)
def q_render_chat(spark: SparkSession, sf: str) -> DataFrame:
    """C17: chat layout with hashtags (B18), summary, rank."""
    return P.render_messages(V.v_analyzed(spark, sf), "chat").select("id", "message")


_USER = """{{/* a user's own layout */}}{{$who := or .Company "?"}}{{if and .Role (ne .Seniority "unknown")}}{{.Role | md}} [{{.Seniority}}]
{{- else if .Role}}{{md .Role}}{{else}}-{{end}} @ {{$who}}: {{len .Tags}} {{range $i, $t := .Tags}}{{if not $i}}first {{end}}{{tgtag $t}};{{else}}none{{end}}
{{- if eq .JobPostQualityScore 100}} full{{end}}"""


def _sql_user() -> str:
    tag = f"list_transform(coalesce(tags, []), lambda t, i: CASE WHEN i = 1 THEN 'first ' ELSE '' END || {O.norm_tag('t')} || ';')"
    return O.with_(O.v_analyzed()) + f"""SELECT id, CASE WHEN coalesce(role, '') = '' THEN '-'
    WHEN coalesce(seniority, '') <> 'unknown' THEN {O.md('role')} || ' [' || coalesce(seniority, '') || ']' ELSE {O.md('role')} END
  || ' @ ' || CASE WHEN coalesce(company, '') = '' THEN '?' ELSE company END || ': ' || len(coalesce(tags, [])) || ' '
  || CASE WHEN len(coalesce(tags, [])) = 0 THEN 'none' ELSE array_to_string({tag}, '') END
  || CASE WHEN job_post_quality_score = 100 THEN ' full' ELSE '' END AS message FROM v_analyzed"""


@register("render_user", _sql_user)
def q_render_user(spark: SparkSession, sf: str) -> DataFrame:
    """A user's template with variables, pipes, conditions and loops."""
    return P.render_messages(V.v_analyzed(spark, sf), P.user_layout(_USER)).select("id", "message")


@register("file_records", lambda: _sql_chat().replace(
    "SELECT id, ", "SELECT '2024-01-31T00:00:00Z' || chr(10) || ", 1).replace(
    " AS message FROM v_analyzed", " || chr(10) || chr(10) || '---' || chr(10) || chr(10) AS value, DATE '2024-01-31' AS date FROM v_analyzed"))
def q_file_records(spark: SparkSession, sf: str) -> DataFrame:
    """File-sink records (time, message, separator) for the chat layout."""
    return P.file_records(P.render_messages(V.v_analyzed(spark, sf), "chat"), NOW)


@register("delivery_requests", lambda: _sql_chat().replace(
    "SELECT id, ", "SELECT id, CASE WHEN id::BIGINT % 2 = 0 THEN 'Markdown' ELSE '' END AS parse_mode, ", 1).replace(
    "FROM v_analyzed", "FROM v_analyzed") .replace("WITH v_analyzed", "WITH v_analyzed", 1)
    .replace("\nSELECT id,", "\n, m AS (SELECT id,", 1) + """)
SELECT id, parse_mode, replace(replace(replace(CASE WHEN parse_mode <> ''
  THEN to_json({'chat_id': '-100123', 'disable_web_page_preview': true, 'parse_mode': parse_mode, 'text': message})
  ELSE to_json({'chat_id': '-100123', 'disable_web_page_preview': true, 'text': message}) END,
  '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e') AS request, '' AS request_error FROM m""")
def q_delivery_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Chat delivery request bodies (parse_mode only when set)."""
    r = P.render_messages(V.v_analyzed(spark, sf), "chat")
    pm = F.when(F.col("id").cast("long") % 2 == 0, F.lit("Markdown")).otherwise(F.lit(""))
    return P.delivery_requests(r, "-100123", parse_mode_col=pm).select("id", "parse_mode", "request", "request_error")


_BODIES = ['{"ok":true}', '{"ok":false,"description":"Bad Request: can\'t parse entities"}', "not json",
           '{"ok":false}', "rate limited"]


def _responses(spark, sf):
    a = V.v_analyzed(spark, sf).select("id")
    i = F.col("id").cast("long")
    return a.select(F.col("id").alias("item_id"), V._pick(_BODIES, i).alias("body"),
                    F.when(i % 5 == 4, F.lit(429)).otherwise(F.lit(200)).alias("status_code"),
                    F.when(i % 2 == 0, F.lit("Markdown")).otherwise(F.lit("")).alias("parse_mode"))


@register("delivery_outcomes", lambda: O.with_(O.v_analyzed()) + f""", r AS (
  SELECT id AS item_id, {O._pick(_BODIES, 'CAST(id AS BIGINT)')} AS body,
         CASE WHEN CAST(id AS BIGINT) % 5 = 4 THEN 429 ELSE 200 END AS status_code FROM v_analyzed),
v AS (SELECT *, CASE WHEN json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT'
                     THEN body END AS jb FROM r)
SELECT item_id, body, status_code,
  CASE WHEN status_code >= 300 THEN 'telegram send failed status=' || CAST(status_code AS VARCHAR) || ' body=' || trim(body)
       WHEN jb IS NULL THEN 'telegram response decode failed'
       WHEN NOT coalesce(CAST(json_extract(jb, '$.ok') AS BOOLEAN), false)
         THEN 'telegram api not ok: ' || coalesce(json_extract_string(jb, '$.description'), '')
       ELSE '' END AS error
FROM v""")
def q_delivery_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery responses -> delivered or error text."""
    o = P.delivery_outcomes(_responses(spark, sf).drop("parse_mode"))
    return o.select("item_id", "body", "status_code", "error")


@register("delivery_fallback", lambda: O.with_(O.v_analyzed()) + f""", r AS (
  SELECT id AS item_id, {O._pick(_BODIES, 'CAST(id AS BIGINT)')} AS body,
         CASE WHEN CAST(id AS BIGINT) % 5 = 4 THEN 429 ELSE 200 END AS status_code,
         CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'Markdown' ELSE '' END AS parse_mode FROM v_analyzed)
SELECT item_id FROM r WHERE status_code < 300 AND json_valid(body)
  AND lower(json_extract_string(CASE WHEN json_valid(body) THEN body END, '$.description')) LIKE '%can''t parse entities%' AND parse_mode <> ''""")
def q_delivery_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries to resend without parse_mode."""
    o = P.delivery_outcomes(_responses(spark, sf)).withColumn("message", F.lit("")).withColumn("chat_id", F.lit(""))
    return P.delivery_fallback(o).select("item_id")


@register("pace", lambda: O.with_(O.v_analyzed()) + """, q AS (
  SELECT id AS item_id, source_label AS dest, created_at AS ready_at FROM v_analyzed),
r AS (SELECT *, row_number() OVER (PARTITION BY dest ORDER BY ready_at, item_id) - 1 AS i FROM q),
m AS (SELECT *, max(epoch_us(ready_at) - i * 2000000) OVER (PARTITION BY dest ORDER BY ready_at, item_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mx FROM r)
SELECT item_id, dest, ready_at, make_timestamp(i * 2000000 + mx) AS send_at FROM m""")
def q_pace(spark: SparkSession, sf: str) -> DataFrame:
    """H6: send times under a 30 messages/minute token bucket per destination."""
    a = V.v_analyzed(spark, sf).select(F.col("id").alias("item_id"), F.col("source_label").alias("dest"),
                                       F.col("created_at").alias("ready_at"))
    return P.pace(a, 30)


@register("item_export", lambda: O.with_(O.v_status(), O.v_analyzed()) + """
SELECT s.id, CASE WHEN trim(coalesce(s.analyzed_payload_json, '')) <> '' THEN s.analyzed_payload_json
  WHEN a.id IS NULL THEN ''
  ELSE coalesce(to_json({'schema_version': 'v1', 'id': a.id, 'source_label': a.source_label, 'source_url': a.source_url,
    'title': a.title, 'job_category': a.job_category, 'role': a.role, 'company': a.company, 'seniority': a.seniority,
    'confidence': a.confidence, 'created_at': strftime(a.created_at, '%Y-%m-%d %H:%M:%S')})::VARCHAR, '') END AS analyzed_payload_json
FROM v_status s LEFT JOIN v_analyzed a ON a.id = s.id""")
def q_item_export(spark: SparkSession, sf: str) -> DataFrame:
    """Stored payload, else a JSON built from the analysed projection."""
    return P.item_export(V.v_status(spark, sf), V.v_analyzed(spark, sf))
