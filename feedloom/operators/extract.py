"""Extraction requests and responses as tables.

Prompts, request bodies and timeouts are column expressions over the item
table; the model call itself is a user batch function applied with
``mapInPandas`` (default: join with an offline ``responses`` table), and the
responses are conformed into the typed AnalyzedItem schema with the
variant type (strict per-field typing) and native rules.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.session import ship_package, ts_lit

CATEGORIES_CSV = ", ".join(fixed.ALLOWED_CATEGORIES)


def _concat_template(tpl: str, cols: dict[str, Column]) -> Column:
    pieces = []
    for i, p in enumerate(re.split(r"\{(\w+)\}", tpl)):
        if i % 2 == 0:
            if p:
                pieces.append(F.lit(p))
        else:
            pieces.append(cols[p])
    return F.concat(*pieces)


def _csv(arr) -> Column:
    return F.array_join(F.coalesce(arr, F.array().cast("array<string>")), ", ")


# ---------------------------------------------------------------- C6 / C7 / C8
def parse_user_template(template: str) -> list | None:
    """Split a ``{{.Name}}`` template on the driver; None when it is invalid
    (unknown variable or any other action), which selects the default prompt."""
    out = []
    pos = 0
    for m in re.finditer(r"\{\{\s*(.*?)\s*\}\}", template, flags=re.S):
        out.append(template[pos:m.start()])
        name = m.group(1)
        if not name.startswith(".") or name[1:] not in fixed.TEMPLATE_VARIABLES:
            return None
        out.append(("var", name[1:]))
        pos = m.end()
    out.append(template[pos:])
    return out


def build_prompts(items: DataFrame, compact: bool = False, template: str | None = None,
                  source_max: int = 2500) -> DataFrame:
    """C6 full / C7 compact / C8 user-template prompts.

    Input columns: item id, title, url, description, links, image_urls and
    ``excerpt`` (nullable).  Description is cut at 1800 (compact 1200) code
    points; the excerpt defaults to ``N/D`` and is not clamped in the full
    default prompt (compact: 1600, user template: ``source_max``).
    """
    desc_max = 1200 if compact else 1800
    desc = F.substring(T.trim_space(F.coalesce(F.col("description"), F.lit(""))), 1, desc_max)
    raw_exc = F.coalesce(F.col("excerpt"), F.lit("")) if "excerpt" in items.columns else F.lit("")

    def excerpt(limit: int) -> Column:
        e = T.clamp_text(raw_exc, limit) if limit > 0 else T.trim_space(raw_exc)
        return F.when(e == "", F.lit(fixed.EXCERPT_MISSING)).otherwise(e)

    cols = {"categories": F.lit(CATEGORIES_CSV), "title": F.coalesce(F.col("title"), F.lit("")),
            "url": F.coalesce(F.col("url"), F.lit("")), "description": desc,
            "excerpt": excerpt(1600 if compact else 0),
            "links": _csv(F.col("links")), "images": _csv(F.col("image_urls"))}
    default = _concat_template(fixed.PROMPT_COMPACT if compact else fixed.PROMPT_FULL, cols)
    prompt = default
    if template is not None and template.strip():
        parts = parse_user_template(template)
        if parts is not None:
            tv = {"AllowedCategories": cols["categories"], "Title": cols["title"], "URL": cols["url"],
                  "Description": desc, "SourcePageText": excerpt(1600 if compact else source_max),
                  "LinksCSV": cols["links"], "ImagesCSV": cols["images"]}
            pieces = [F.lit(p) if isinstance(p, str) else tv[p[1]] for p in parts if p != ""]
            rendered = T.trim_space(F.concat(*pieces)) if pieces else F.lit("")
            prompt = F.when(rendered != "", rendered).otherwise(default)
    return items.withColumn("prompt", prompt)


# ---------------------------------------------------------------- C9
def _lit_json(obj) -> Column:
    """A literal JSON value as nested struct/array columns, keys sorted."""
    if isinstance(obj, dict):
        return F.struct(*[_lit_json(obj[k]).alias(k) for k in sorted(obj)])
    if isinstance(obj, list):
        return F.array(*[_lit_json(v) for v in obj])
    return F.lit(obj)


def response_schema() -> dict:
    """The strict response schema: 13 required fields with bounds."""
    s = {"type": "string"}
    return {
        "type": "object", "additionalProperties": False, "required": list(fixed.RESPONSE_KEYS),
        "properties": {
            "job_category": {"type": "string", "enum": list(fixed.ALLOWED_CATEGORIES)},
            "role": s, "company": s, "seniority": s, "location": s, "remote_type": s,
            "contract_type": s, "salary": s, "language": s,
            "summary_it": {"type": "string", "maxLength": 220},
            "tech_stack": {"type": "array", "minItems": 0, "maxItems": 8, "uniqueItems": True,
                           "items": {"type": "string", "maxLength": 32}},
            "tags": {"type": "array", "minItems": 0, "maxItems": 6, "uniqueItems": True,
                     "items": {"type": "string", "maxLength": 24}},
            "confidence": {"type": "number", "minimum": 0, "maximum": 1},
        },
    }


def go_json_escape(c: Column) -> Column:
    """Escape ``& < >`` and U+2028/2029 like Go's encoder (only legal inside strings)."""
    for ch, rep in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"),
                    (" ", "\\u2028"), (" ", "\\u2029")):
        c = F.replace(c, F.lit(ch), F.lit(rep))
    return c


def request_body(prompts: DataFrame, model: str, max_tokens: int = 512, thinking: bool = False,
                 strict: bool = False, disable_thinking: bool = False,
                 max_tokens_col: Column | None = None) -> DataFrame:
    """Chat request JSON per prompt (keys in sorted order, as a map encoder emits)."""
    fields = {}
    if disable_thinking:
        fields["chat_template_kwargs"] = F.struct(F.lit(False).alias("enable_thinking"))
    if thinking:
        fields["enable_thinking"] = F.lit(True)
    if strict:
        fields["json_schema"] = _lit_json(response_schema())
    fields["max_tokens"] = max_tokens_col if max_tokens_col is not None else F.lit(max_tokens)
    fields["messages"] = F.array(
        F.struct(F.lit(fixed.SYSTEM_MESSAGE).alias("content"), F.lit("system").alias("role")),
        F.struct(F.col("prompt").alias("content"), F.lit("user").alias("role")))
    fields["model"] = F.lit(model)
    if disable_thinking:
        fields["reasoning_format"] = F.lit("none")
    if strict:
        fields["response_format"] = F.struct(_lit_json(response_schema()).alias("schema"),
                                             F.lit("json_schema").alias("type"))
    fields["temperature"] = F.lit(0.1)
    body = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    return prompts.withColumn("body", go_json_escape(body))


# ---------------------------------------------------------------- C10
def request_timeout(prompts: DataFrame, max_tokens: int | Column = 512, base_s: int = 20,
                    max_s: int = 600, per1k_s: int = 25, per256_s: int = 20) -> DataFrame:
    """Base + ceil(bytes/1000)*per1k + ceil(tokens/256)*per256, within [base, max]."""
    base_s = base_s if base_s > 0 else 20
    max_s = max(max_s if max_s > 0 else 600, base_s)
    chars = F.octet_length(T.trim_space(F.coalesce(F.col("prompt"), F.lit(""))))
    tok = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    t = (F.lit(base_s)
         + F.when(chars > 0, F.ceil(chars / 1000.0) * per1k_s).otherwise(0)
         + F.when(tok > 0, F.ceil(tok / 256.0) * per256_s).otherwise(0))
    t = F.least(t, F.lit(max_s))
    return prompts.withColumn("timeout_s", F.greatest(t, F.lit(base_s)).cast("long"))


# ---------------------------------------------------------------- C11
def complete(prompts: DataFrame, batch_fn: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
             responses: DataFrame | None = None,
             schema: str = "item_id string, content string, finish_reason string, "
                           "prompt_tokens long, completion_tokens long, error string") -> DataFrame:
    """C11: one response row per prompt row.

    ``batch_fn`` maps a pandas batch of prompts to a pandas batch of
    responses (the user's model client, run inside tasks via Arrow).
    Without it, responses come from an offline table joined on item_id.
    """
    if batch_fn is not None:
        ship_package(prompts.sparkSession)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield batch_fn(b)
        return prompts.mapInPandas(run, schema)
    if responses is None:
        raise ValueError("complete() needs batch_fn or a responses table")
    return prompts.select("item_id").join(responses, "item_id", "left")


# ---------------------------------------------------------------- C12
def error_class(message: Column, status: Column | None = None, n_choices: Column | None = None) -> Column:
    """Class of a failed model call, '' when it did not fail."""
    msg = F.lower(T.trim_space(F.coalesce(message, F.lit(""))))
    out = None
    if status is not None:
        out = F.when(status >= 300, F.lit("http_error"))
    for cls, needles in fixed.ERROR_CLASSES:
        cond = None
        for n in needles:
            c = msg.contains(n)
            cond = c if cond is None else (cond | c)
        cond = (msg != "") & cond
        out = F.when(cond, F.lit(cls)) if out is None else out.when(cond, F.lit(cls))
    out = out.when(msg != "", F.lit(fixed.DEFAULT_ERROR_CLASS))
    if n_choices is not None:
        out = out.when(F.coalesce(n_choices, F.lit(0)) == 0, F.lit("response_decode_error"))
    return out.otherwise(F.lit(""))


def classify_errors(calls: DataFrame) -> DataFrame:
    """C12 over a call-outcome table (item_id, message, status_code, n_choices, finish_reasons)."""
    fr = F.array_distinct(F.filter(F.transform(F.coalesce(F.col("finish_reasons"), F.array().cast("array<string>")),
                                               T.trim_space), lambda x: x != ""))
    return calls.select("item_id",
                        error_class(F.col("message"), F.col("status_code"), F.col("n_choices")).alias("error_type"),
                        F.array_join(fr, ",").alias("finish_reasons"))


# ---------------------------------------------------------------- C13
RETRY_TOKENS = (512, 1024)  # fixed value: least and most tokens of a compact retry


def looks_truncated(content: Column) -> Column:
    """No JSON value, because the text ends too early: blank, or still
    inside an object, an array or a string when its literals are removed.
    The finish reason alone says nothing."""
    c = T.strip_code_fence(content)
    bare = F.regexp_replace(c, '"(?:[^"\\\\]|\\\\.)*"', "")
    opens = F.length(bare) - F.length(F.regexp_replace(bare, "[\\[{]", ""))
    closes = F.length(bare) - F.length(F.regexp_replace(bare, "[\\]}]", ""))
    early = (c == "") | (opens > closes) | bare.contains('"')
    return F.try_parse_json(c).isNull() & early


def fallback_requests(calls: DataFrame, items: DataFrame, model: str, max_tokens: int = 512,
                      thinking: bool = False, strict: bool = False) -> DataFrame:
    """Second-pass requests: sampler-init 400 -> resend without the strict
    schema (thinking disabled unless configured on); truncated JSON of a call
    that succeeded (no status, or one below 300) -> compact prompt with
    max_tokens = clamp(2 * max, RETRY_TOKENS), the schema kept if ``strict``."""
    sampler = calls.filter((F.col("status_code") == 400)
                           & F.lower(F.coalesce(F.col("body"), F.lit(""))).contains(fixed.SAMPLER_INIT_ERROR))
    trunc = calls.filter((F.coalesce(F.col("status_code"), F.lit(200)) < 300) & looks_truncated(F.col("content")))
    a = build_prompts(items.join(sampler.select("item_id"), "item_id", "left_semi"))
    a = request_body(a, model, max_tokens, thinking=thinking, strict=False, disable_thinking=not thinking)
    retry_tokens = min(max(2 * max_tokens, RETRY_TOKENS[0]), RETRY_TOKENS[1])
    b = build_prompts(items.join(trunc.select("item_id"), "item_id", "left_semi"), compact=True)
    b = request_body(b, model, retry_tokens, thinking=thinking, strict=strict)
    return (a.select("item_id", F.lit("sampler_fallback").alias("reason"), "body")
            .unionByName(b.select("item_id", F.lit("compact_retry").alias("reason"), "body")))


# ---------------------------------------------------------------- B17 / C14
_NUMERIC_TYPES = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"
_FLOAT_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _vtype(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def normalize_confidence(v: Column, path: str = "$.confidence", vtype: Column | None = None) -> Column:
    """struct(value, ok).  Number passes; label map; '%'/',' text parsed,
    /100 when '%' or > 1, clamped; other text fails; missing/null -> 0."""
    t = _vtype(v, path) if vtype is None else vtype
    text = F.lower(T.trim_space(F.try_variant_get(v, path, "string")))
    labels = F.create_map(*[x for k, n in fixed.CONFIDENCE_LABELS.items() for x in (F.lit(k), F.lit(n))])
    num_txt = F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), "%$", "")
    n = F.when(num_txt.rlike(_FLOAT_TEXT), num_txt.try_cast("double"))
    scaled = F.when(text.endswith("%") | (n > 1), n / 100).otherwise(n)
    clamped = F.when(scaled.isNotNull(), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
    from_text = F.when(text == "", F.lit(None).cast("double")).otherwise(
        F.coalesce(F.element_at(labels, text), clamped))
    value = (F.when(t.isNull() | (t == "VOID"), F.lit(0.0))
             .when(t.rlike(_NUMERIC_TYPES), F.try_variant_get(v, path, "double"))
             .when(t == "STRING", from_text))
    return F.struct(value.alias("value"), value.isNotNull().alias("ok"))


def _str_field(v: Column, name: str, t: Column):
    ok = t.isNull() | t.isin("STRING", "VOID")
    val = F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    return F.when(t == "STRING", val).otherwise(F.lit("")), ok


def _arr_field(v: Column, name: str, t: Column):
    ok = t.isNull() | t.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>")
    arr = F.transform(F.coalesce(F.try_variant_get(v, f"$.{name}", "array<string>"),
                                 F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")))
    return F.when(ok, arr).otherwise(F.array().cast("array<string>")), ok


_STR_FIELDS = ["job_category", "role", "company", "seniority", "location", "remote_type",
               "contract_type", "salary", "language", "summary_it"]


def conform(responses: DataFrame, items: DataFrame, now) -> DataFrame:
    """C14: model responses -> AnalyzedItem rows or an error kind.

    ``responses``: item_id, content.  ``items``: id, guid, url, source_label,
    title, links, image_urls.  Error kinds: truncated / json_parse /
    json_type / missing_required ('' = ok).
    """
    r = responses.select("item_id", T.strip_code_fence(F.col("content")).alias("_c"), "content")
    r = r.withColumn("_v", F.try_parse_json(F.col("_c")))
    v = F.col("_v")
    # the variant type of every field is computed once, in its own projection
    fields = _STR_FIELDS + ["tech_stack", "tags", "confidence"]
    r = r.select("item_id", "_c", "_v", F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
                 .alias("_obj"), *[_vtype(v, f"$.{f}").alias(f"_t_{f}") for f in fields])
    sel = [F.col("item_id"), F.col("_c"), F.col("_obj")]
    oks = []
    for f in _STR_FIELDS:
        val, ok = _str_field(v, f, F.col(f"_t_{f}"))
        sel += [val.alias(f)]
        oks.append(ok)
    for f in ("tech_stack", "tags"):
        val, ok = _arr_field(v, f, F.col(f"_t_{f}"))
        sel += [val.alias(f)]
        oks.append(ok)
    conf = normalize_confidence(v, vtype=F.col("_t_confidence"))
    types_ok = functools.reduce(lambda a, b: a & b, oks + [conf["ok"]])
    sel += [conf["value"].alias("_conf"), types_ok.alias("_types_ok")]
    p = r.select(*sel)
    kind = (F.when(~F.col("_obj") & looks_truncated(F.col("_c")), F.lit("truncated"))
            .when(~F.col("_obj"), F.lit("json_parse"))
            .when(~F.col("_types_ok"), F.lit("json_type"))
            .when(~T.required_fields(F.col("role"), F.col("company"), F.col("summary_it")), F.lit("missing_required"))
            .otherwise(F.lit("")))
    p = p.withColumn("error", kind)
    it = items.select(F.col("id").alias("item_id"), "guid", F.col("url").alias("source_url"), "source_label",
                      "title", "links", "image_urls")
    j = p.join(it, "item_id", "left")
    stack = T.sanitize_stack(F.col("tech_stack"))
    q = T.quality(F.col("seniority"), F.col("location"), F.col("contract_type"), F.col("salary"), stack)
    lang = F.when(F.col("language") == "", F.lit("it")).otherwise(F.col("language"))
    ok = F.col("error") == ""
    out = j.select(
        "item_id", "error",
        F.when(ok, F.lit(fixed.SCHEMA_VERSION)).alias("schema_version"),
        F.when(ok, F.col("guid")).alias("guid"), F.when(ok, F.col("source_url")).alias("source_url"),
        F.when(ok, F.col("source_label")).alias("source_label"), F.when(ok, F.col("title")).alias("title"),
        F.when(ok, T.normalize_category(F.col("job_category"))).alias("job_category"),
        F.when(ok, F.col("role")).alias("role"), F.when(ok, F.col("company")).alias("company"),
        F.when(ok, T.sanitize_unknown(F.col("seniority"))).alias("seniority"),
        F.when(ok, T.sanitize_unknown(F.col("location"))).alias("location"),
        F.when(ok, F.col("remote_type")).alias("remote_type"),
        F.when(ok, stack).alias("tech_stack"),
        F.when(ok, T.sanitize_tags(F.col("tags"))).alias("tags"),
        F.when(ok, T.sanitize_unknown(F.col("contract_type"))).alias("contract_type"),
        F.when(ok, T.sanitize_unknown(F.col("salary"))).alias("salary"),
        F.when(ok, q["score"]).alias("job_post_quality_score"),
        F.when(ok, q["rank"]).alias("job_post_quality_rank"),
        F.when(ok, q["missing"]).alias("job_post_missing_fields"),
        F.when(ok, lang).alias("language"), F.when(ok, F.col("summary_it")).alias("summary_it"),
        F.when(ok, T.unique_urls(F.array(F.col("source_url")), F.col("links"))).alias("original_links"),
        F.when(ok, T.unique_urls(F.col("image_urls"))).alias("original_images"),
        F.when(ok, F.col("_conf")).alias("confidence"),
        F.when(ok, ts_lit(now)).alias("created_at"))
    return out


# ---------------------------------------------------------------- C15
def token_usage(calls: DataFrame) -> DataFrame:
    """input/output token totals per model (only counts > 0)."""
    u = calls.select("model", F.explode(F.array(
        F.struct(F.lit("input").alias("token_type"), F.col("prompt_tokens").alias("tokens")),
        F.struct(F.lit("output").alias("token_type"), F.col("completion_tokens").alias("tokens")))).alias("x"))
    u = u.select("model", "x.token_type", "x.tokens").filter(F.col("tokens") > 0)
    return u.groupBy("model", "token_type").agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("calls"),
        F.round(F.avg("tokens"), 6).alias("mean_tokens"))
