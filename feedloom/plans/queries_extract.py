"""Registered queries for prompts, requests, model-call outcomes and conform."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.operators import extract as X
from feedloom.plans import oracle as O
from feedloom.plans import views as V
from feedloom.plans.catalog import register
from feedloom.sources.tables import read_table

NOW = V.NOW_EVENTS
USER_TEMPLATE = "Titolo={{.Title}} | URL={{.URL}}\n{{.Description}}\nPagina: {{.SourcePageText}}"


def _sql_template(tpl: str, cols: dict[str, str]) -> str:
    out = []
    for i, p in enumerate(re.split(r"\{(\w+)\}", tpl)):
        if i % 2 == 0:
            if p:
                out.append(O.q(p))
        else:
            out.append(cols[p])
    return " || ".join(out)


def _sql_prompt_cols(compact: bool) -> dict[str, str]:
    desc = f"substr({O.trim_space('coalesce(description, ' + O.q('') + ')')}, 1, {1200 if compact else 1800})"
    exc = O.clamp("excerpt", 1600) if compact else O.trim_space("coalesce(excerpt, '')")
    return {"categories": O.q(X.CATEGORIES_CSV), "title": "coalesce(title, '')", "url": "coalesce(url, '')",
            "description": desc, "excerpt": f"CASE WHEN {exc} = '' THEN 'N/D' ELSE {exc} END",
            "links": "array_to_string(coalesce(links, []), ', ')",
            "images": "array_to_string(coalesce(image_urls, []), ', ')"}


def _sql_prompts(compact: bool) -> str:
    tpl = fixed.PROMPT_COMPACT if compact else fixed.PROMPT_FULL
    return f"SELECT id AS item_id, {_sql_template(tpl, _sql_prompt_cols(compact))} AS prompt FROM v_doc_raw"


@register("prompts_full", lambda: O.with_(O.v_doc_raw()) + _sql_prompts(False))
def q_prompts_full(spark: SparkSession, sf: str) -> DataFrame:
    """Default prompts (description cut 1800, excerpt unclamped, N/D default)."""
    return X.build_prompts(V.v_doc_raw(spark, sf)).select(F.col("id").alias("item_id"), "prompt")


@register("prompts_compact", lambda: O.with_(O.v_doc_raw()) + _sql_prompts(True))
def q_prompts_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Compact prompts (description 1200, excerpt 1600)."""
    return X.build_prompts(V.v_doc_raw(spark, sf), compact=True).select(F.col("id").alias("item_id"), "prompt")


def _sql_user_template() -> str:
    cols = _sql_prompt_cols(False)
    exc = O.clamp("excerpt", 2500)
    vars_ = {"Title": cols["title"], "URL": cols["url"], "Description": cols["description"],
             "SourcePageText": f"CASE WHEN {exc} = '' THEN 'N/D' ELSE {exc} END"}
    t = USER_TEMPLATE.replace("{{.", "{").replace("}}", "}")
    rendered = O.trim_space(_sql_template(t, vars_))
    default = _sql_template(fixed.PROMPT_FULL, cols)
    return (f"SELECT id AS item_id, CASE WHEN {rendered} <> '' THEN {rendered} ELSE {default} END AS prompt "
            f"FROM v_doc_raw")


@register("prompts_template", lambda: O.with_(O.v_doc_raw()) + _sql_user_template())
def q_prompts_template(spark: SparkSession, sf: str) -> DataFrame:
    """User template over the template variables (excerpt clamped 2500)."""
    p = X.build_prompts(V.v_doc_raw(spark, sf), template=USER_TEMPLATE)
    return p.select(F.col("id").alias("item_id"), "prompt")


@register("request_timeouts", lambda: O.with_(O.v_doc_raw(), "p AS (" + _sql_prompts(False) + ")") + f"""
SELECT item_id, CAST(greatest(least(20 + CASE WHEN octet_length(encode({O.trim_space('prompt')})) > 0
  THEN ceil(octet_length(encode({O.trim_space('prompt')})) / 1000.0) * 25 ELSE 0 END + ceil(512 / 256.0) * 20, 600), 20)
  AS BIGINT) AS timeout_s FROM p""")
def q_request_timeouts(spark: SparkSession, sf: str) -> DataFrame:
    """Per-request timeout from prompt bytes and max tokens."""
    p = X.build_prompts(V.v_doc_raw(spark, sf)).select(F.col("id").alias("item_id"), "prompt")
    return X.request_timeout(p, 512).select("item_id", "timeout_s")


def _json_lit(obj) -> str:
    """A literal JSON value as a DuckDB struct/list expression with sorted keys."""
    if isinstance(obj, dict):
        return "{" + ", ".join(f"{O.q(k)}: {_json_lit(obj[k])}" for k in sorted(obj)) + "}"
    if isinstance(obj, list):
        return "[" + ", ".join(_json_lit(v) for v in obj) + "]"
    if isinstance(obj, bool):
        return "true" if obj else "false"
    if isinstance(obj, str):
        return O.q(obj)
    return str(obj)


def _sql_request_bodies() -> str:
    schema = _json_lit(X.response_schema())
    body = (f"to_json({{'json_schema': {schema}, 'max_tokens': 512, 'messages': [{{'content': {O.q(fixed.SYSTEM_MESSAGE)}, "
            f"'role': 'system'}}, {{'content': prompt, 'role': 'user'}}], 'model': 'local-model', "
            f"'response_format': {{'schema': {schema}, 'type': 'json_schema'}}, 'temperature': 0.1}})")
    esc = f"replace(replace(replace(CAST({body} AS VARCHAR), '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e')"
    return O.with_(O.v_doc_raw(), "p AS (" + _sql_prompts(False) + ")") + f"SELECT item_id, {esc} AS body FROM p"


@register("request_bodies", _sql_request_bodies)
def q_request_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Strict-schema chat request bodies (sorted keys, Go-style escaping of & < >)."""
    p = X.build_prompts(V.v_doc_raw(spark, sf)).select(F.col("id").alias("item_id"), "prompt")
    return X.request_body(p, "local-model", 512, strict=True).select("item_id", "body")


_ERR_MESSAGES = ["context deadline exceeded", "dial tcp 10.0.0.1:8080: connect: connection refused",
                 "lookup llama on 127.0.0.11:53: no such host", "remote error: tls: handshake failure",
                 "llm status: 503: busy", "unexpected EOF", ""]


def _calls(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "event_type")
    msg = F.when(F.col("event_type") == "error", V._pick(_ERR_MESSAGES, F.col("event_id"))).otherwise("")
    return e.select(F.col("event_id").cast("string").alias("item_id"), msg.alias("message"),
                    F.when(msg.startswith("llm status"), F.lit(503)).alias("status_code"),
                    F.when((F.col("event_type") == "error") & (F.col("event_id") % 7 == 6), F.lit(0)).otherwise(F.lit(1)).alias("n_choices"),
                    F.array(F.lit("stop"), F.lit(" length "), F.lit(""), F.lit("stop")).alias("finish_reasons"))


@register("error_classes", lambda: f"""WITH c AS (
  SELECT CAST(event_id AS VARCHAR) AS item_id, CASE WHEN event_type = 'error' THEN {O._pick(_ERR_MESSAGES, 'event_id')} ELSE '' END AS message,
         CASE WHEN event_type = 'error' AND event_id % 7 = 6 THEN 0 ELSE 1 END AS n_choices FROM events),
m AS (SELECT *, lower({O.trim_space('message')}) AS msg FROM c)
SELECT item_id, CASE WHEN starts_with(message, 'llm status') THEN 'http_error'
  WHEN msg <> '' AND (msg LIKE '%deadline exceeded%' OR msg LIKE '%timeout%') THEN 'timeout'
  WHEN msg <> '' AND msg LIKE '%connection refused%' THEN 'connection_refused'
  WHEN msg <> '' AND msg LIKE '%no such host%' THEN 'dns_error'
  WHEN msg <> '' AND msg LIKE '%tls%' THEN 'tls_error'
  WHEN msg <> '' THEN 'llm_request_failed'
  WHEN n_choices = 0 THEN 'response_decode_error' ELSE '' END AS error_type,
  'stop,length' AS finish_reasons FROM m""")
def q_error_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Error class of every model call ('' when it did not fail); distinct finish reasons in order."""
    return X.classify_errors(_calls(spark, sf))


@register("token_usage", lambda: """WITH c AS (
  SELECT 'model-' || CAST(event_id % 3 AS VARCHAR) AS model, CAST(floor(value * 100) AS BIGINT) AS prompt_tokens,
         CAST(event_id % 500 AS BIGINT) AS completion_tokens FROM events),
u AS (SELECT model, 'input' AS token_type, prompt_tokens AS tokens FROM c
      UNION ALL SELECT model, 'output', completion_tokens FROM c)
SELECT model, token_type, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS calls, round(avg(tokens), 6) AS mean_tokens
FROM u WHERE tokens > 0 GROUP BY model, token_type""")
def q_token_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Token totals per model and direction."""
    e = read_table(spark, sf, "events")
    c = e.select(F.concat(F.lit("model-"), (F.col("event_id") % 3).cast("string")).alias("model"),
                 F.floor(F.col("value") * 100).cast("long").alias("prompt_tokens"),
                 (F.col("event_id") % 500).cast("long").alias("completion_tokens"))
    return X.token_usage(c)


def _conform(spark, sf):
    return X.conform(V.v_responses(spark, sf), V.v_doc_raw(spark, sf), NOW)


_CONF_COLS = ["item_id", "error", "job_category", "role", "company", "seniority", "location", "remote_type",
              "tech_stack", "tags", "contract_type", "salary", "job_post_quality_score", "job_post_quality_rank",
              "job_post_missing_fields", "language", "summary_it", "confidence", "original_links",
              "original_images"]


def _sql_conform() -> str:
    j = "j"

    def ty(f):
        return f"json_type({j}, '$.{f}')"

    str_ok = " AND ".join(f"({ty(f)} IS NULL OR {ty(f)} IN ('VARCHAR', 'NULL'))" for f in X._STR_FIELDS)

    def arr_ok(f):
        return (f"({ty(f)} IS NULL OR {ty(f)} = 'NULL' OR ({ty(f)} = 'ARRAY' AND coalesce(list_bool_and("
                f"list_transform(json_extract({j}, '$.{f}[*]'), lambda x: json_type(x) IN ('VARCHAR', 'NULL'))), true)))")

    def arr_val(f):
        return (f"CASE WHEN {ty(f)} = 'ARRAY' THEN list_transform(json_extract({j}, '$.{f}[*]'), "
                f"lambda x: coalesce(json_extract_string(x, '$'), '')) ELSE [] END")

    text = "lower(" + O.trim_space(f"json_extract_string({j}, '$.confidence')") + ")"
    labels = " ".join(f"WHEN {O.q(k)} THEN {v}" for k, v in fixed.CONFIDENCE_LABELS.items())
    num_txt = f"regexp_replace(replace({text}, ',', '.'), '%$', '')"
    n = f"CASE WHEN regexp_full_match({num_txt}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({num_txt} AS DOUBLE) END"
    scaled = f"CASE WHEN ends_with({text}, '%') OR ({n}) > 1 THEN ({n}) / 100 ELSE ({n}) END"
    clamped = f"CASE WHEN ({scaled}) IS NOT NULL THEN least(greatest({scaled}, 0.0), 1.0) END"
    ct = ty("confidence")
    conf = (f"CASE WHEN {ct} IS NULL OR {ct} = 'NULL' THEN 0.0 "
            f"WHEN {ct} IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract({j}, '$.confidence') AS DOUBLE) "
            f"WHEN {ct} = 'VARCHAR' THEN CASE WHEN {text} = '' THEN NULL ELSE coalesce(CASE {text} {labels} END, {clamped}) END END")
    sv = {f: f"CASE WHEN {ty(f)} = 'VARCHAR' THEN coalesce(json_extract_string({j}, '$.{f}'), '') ELSE '' END"
          for f in X._STR_FIELDS}
    bare = "regexp_replace(c, '\"(?:[^\"\\\\]|\\\\.)*\"', '', 'g')"
    trunc = (f"(c = '' OR length({bare}) - length(regexp_replace({bare}, '[\\[{{]', '', 'g')) > "
             f"length({bare}) - length(regexp_replace({bare}, '[\\]}}]', '', 'g')) OR contains({bare}, '\"'))")
    return O.with_(O.v_responses(), O.v_doc_raw(), f"""r AS (SELECT item_id, {O.strip_fence('content')} AS c FROM v_responses),
p AS (SELECT item_id, c, CASE WHEN json_valid(c) AND json_type(c) = 'OBJECT' THEN CAST(c AS JSON) END AS j FROM r),
f AS (SELECT item_id, c, j IS NOT NULL AS obj,
  {", ".join(f"{v} AS {k}" for k, v in sv.items())},
  {arr_val('tech_stack')} AS tech_stack, {arr_val('tags')} AS tags,
  {conf} AS conf,
  ({str_ok} AND {arr_ok('tech_stack')} AND {arr_ok('tags')}) AS types_ok FROM p),
e AS (SELECT *, CASE WHEN NOT obj AND {trunc} THEN 'truncated' WHEN NOT obj THEN 'json_parse'
  WHEN NOT (types_ok AND conf IS NOT NULL) THEN 'json_type'
  WHEN NOT (role <> '' AND company <> '' AND summary_it <> '') THEN 'missing_required' ELSE '' END AS error FROM f),
k AS (SELECT e.*, d.url AS source_url, d.links AS ilinks, d.image_urls AS iimages,
  {O.sanitize_stack('e.tech_stack')} AS stack FROM e LEFT JOIN v_doc_raw d ON d.id = e.item_id),
s AS (SELECT *, (CASE WHEN {O.sanitize_unknown('seniority')} <> '' THEN 20 ELSE 0 END
  + CASE WHEN {O.sanitize_unknown('location')} <> '' THEN 20 ELSE 0 END
  + CASE WHEN {O.sanitize_unknown('contract_type')} <> '' THEN 20 ELSE 0 END
  + CASE WHEN {O.has_clear_salary('salary')} THEN 20 ELSE 0 END
  + CASE WHEN len(stack) > 0 THEN 20 ELSE 0 END) AS score,
  list_filter([CASE WHEN {O.sanitize_unknown('seniority')} = '' THEN 'seniority' END,
               CASE WHEN {O.sanitize_unknown('location')} = '' THEN 'location' END,
               CASE WHEN {O.sanitize_unknown('contract_type')} = '' THEN 'contract_type' END,
               CASE WHEN NOT {O.has_clear_salary('salary')} THEN 'salary' END,
               CASE WHEN len(stack) = 0 THEN 'tech_stack' END], lambda x: x IS NOT NULL) AS missing
  FROM k)""") + f"""
SELECT item_id, error,
  CASE WHEN error = '' THEN {O.category('job_category')} END AS job_category,
  CASE WHEN error = '' THEN role END AS role, CASE WHEN error = '' THEN company END AS company,
  CASE WHEN error = '' THEN {O.sanitize_unknown('seniority')} END AS seniority,
  CASE WHEN error = '' THEN {O.sanitize_unknown('location')} END AS location,
  CASE WHEN error = '' THEN remote_type END AS remote_type,
  CASE WHEN error = '' THEN array_to_string(stack, '|') END AS tech_stack,
  CASE WHEN error = '' THEN array_to_string({O.sanitize_tags('tags')}, '|') END AS tags,
  CASE WHEN error = '' THEN {O.sanitize_unknown('contract_type')} END AS contract_type,
  CASE WHEN error = '' THEN {O.sanitize_unknown('salary')} END AS salary,
  CASE WHEN error = '' THEN score END AS job_post_quality_score,
  CASE WHEN error = '' THEN CASE WHEN score >= 90 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END END AS job_post_quality_rank,
  CASE WHEN error = '' THEN array_to_string(missing, '|') END AS job_post_missing_fields,
  CASE WHEN error = '' THEN CASE WHEN language = '' THEN 'it' ELSE language END END AS language,
  CASE WHEN error = '' THEN summary_it END AS summary_it,
  CASE WHEN error = '' THEN round(conf, 6) END AS confidence,
  CASE WHEN error = '' THEN array_to_string({O.stable_distinct(f"list_filter(list_transform(list_concat([source_url], ilinks), lambda x: {O.trim_space('x')}), lambda x: x IS NOT NULL AND x <> '')")}, '|') END AS original_links,
  CASE WHEN error = '' THEN array_to_string({O.stable_distinct(f"list_filter(list_transform(iimages, lambda x: {O.trim_space('x')}), lambda x: x IS NOT NULL AND x <> '')")}, '|') END AS original_images
FROM s"""


@register("conform", _sql_conform)
def q_conform(spark: SparkSession, sf: str) -> DataFrame:
    """C14 (+B14-B23, B27): responses conformed to AnalyzedItem, with error kinds."""
    c = _conform(spark, sf)
    arr = ("tech_stack", "tags", "job_post_missing_fields", "original_links", "original_images")
    return c.select(*[F.array_join(F.col(k), "|").alias(k) if k in arr else
                      (F.round(F.col(k), 6).alias(k) if k == "confidence" else F.col(k)) for k in _CONF_COLS])


def _sql_fallback() -> str:
    def body(prompt_col, max_tokens, sampler):
        extra = ("'chat_template_kwargs': {'enable_thinking': false}, " if sampler else "")
        tail = (", 'reasoning_format': 'none'" if sampler else "")
        j = (f"to_json({{{extra}'max_tokens': {max_tokens}, 'messages': [{{'content': {O.q(fixed.SYSTEM_MESSAGE)}, "
             f"'role': 'system'}}, {{'content': {prompt_col}, 'role': 'user'}}], 'model': 'local-model'{tail}, "
             f"'temperature': 0.1}})")
        return f"replace(replace(replace(CAST({j} AS VARCHAR), '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e')"
    bare = "regexp_replace(c2, '\"(?:[^\"\\\\]|\\\\.)*\"', '', 'g')"
    trunc = (f"(c2 = '' OR length({bare}) - length(regexp_replace({bare}, '[\\[{{]', '', 'g')) > "
             f"length({bare}) - length(regexp_replace({bare}, '[\\]}}]', '', 'g')) OR contains({bare}, '\"'))")
    return O.with_(O.v_doc_raw(), O.v_responses(), "pf AS (" + _sql_prompts(False) + ")",
                   "pc AS (" + _sql_prompts(True) + ")") + f""", c AS (
  SELECT item_id, content, CASE WHEN CAST(item_id AS BIGINT) % 13 = 0 THEN 400 END AS status_code FROM v_responses),
t AS (SELECT item_id FROM (SELECT item_id, {O.strip_fence('content')} AS c2 FROM c WHERE status_code IS NULL) WHERE {trunc})
SELECT item_id, 'sampler_fallback' AS reason, {body('prompt', 512, True)} AS body FROM pf
WHERE item_id IN (SELECT item_id FROM c WHERE status_code = 400)
UNION ALL
SELECT item_id, 'compact_retry' AS reason, {body('prompt', 1024, False)} AS body FROM pc
WHERE item_id IN (SELECT item_id FROM t)"""


@register("fallback_requests", _sql_fallback)
def q_fallback_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Second-pass requests for sampler-init 400s and truncated JSON (rows-only check)."""
    r = V.v_responses(spark, sf)
    calls = r.select("item_id", "content", F.lit(None).cast("string").alias("finish_reason"),
                     F.when(F.col("item_id").cast("long") % 13 == 0, F.lit(400)).alias("status_code"),
                     F.when(F.col("item_id").cast("long") % 13 == 0,
                            F.lit('{"error":"Failed to initialize samplers"}')).alias("body"))
    items = V.v_doc_raw(spark, sf).withColumnRenamed("id", "item_id")
    return X.fallback_requests(calls, items, "local-model", 512)


def _echo_client(batch):
    """A stand-in model client: answers with the prompt's size."""
    import pandas as pd

    size = batch["prompt"].str.len()
    return pd.DataFrame({"item_id": batch["item_id"], "content": '{"size":' + size.astype(str) + "}", "finish_reason": "stop",
                         "prompt_tokens": size, "completion_tokens": 1, "error": ""})


@register("complete_batch", lambda: """SELECT CAST(doc_id AS VARCHAR) AS item_id, '{"size":' || length(text) || '}' AS content,
  'stop' AS finish_reason, length(text) AS prompt_tokens, CAST(1 AS BIGINT) AS completion_tokens, '' AS error FROM documents""")
def q_complete_batch(spark: SparkSession, sf: str) -> DataFrame:
    """C11 with a batch client inside the tasks, over whole texts."""
    p = read_table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("item_id"), F.col("text").alias("prompt"))
    return X.complete(p, _echo_client)
