"""Publishing: message rendering, delivery requests and outcomes, file sink,
item export, pacing.

Layouts are templates compiled to native columns (a user layout is a template
or any python function ``DataFrame -> Column``).  Delivery requests are a table that a
sender job drains; responses come back as a table (no network in core).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.operators import template
from feedloom.operators.extract import go_json_escape
from feedloom.session import checkpoint_dir, reliable_checkpoint, ts_lit

# ---------------------------------------------------------------- C16 / C17
def render_default(df: DataFrame, header: str = fixed.DEFAULT_LAYOUT_HEADER) -> Column:
    """The default layout (header line, label, first link, category,
    role @ company, summary, fields, stack, tags, links, images, source link)."""
    return F.concat(F.lit(header + "\n"), template.compile_template(fixed.DEFAULT_LAYOUT, LAYOUT_FIELDS))


def render_chat(df: DataFrame) -> Column:
    """C17: the chat layout (frame, hashtags by B18, summary, rank, apply link)."""
    return template.compile_template(fixed.CHAT_LAYOUT, LAYOUT_FIELDS)


def user_layout(source: str) -> Callable[[DataFrame], Column]:
    """A user's template text as a layout; raises ``TemplateError`` if it cannot be compiled."""
    return template.layout(source, LAYOUT_FIELDS)


LAYOUT_FIELDS = {
    "source_label": "string", "source_url": "string", "title": "string", "job_category": "string",
    "role": "string", "company": "string", "summary_it": "string", "seniority": "string", "location": "string",
    "remote_type": "string", "contract_type": "string", "salary": "string", "language": "string",
    "tech_stack": "array<string>", "tags": "array<string>", "original_links": "array<string>",
    "original_images": "array<string>", "job_post_quality_rank": "string", "job_post_quality_score": "int",
}


def render_messages(analyzed: DataFrame, layout: str | Callable[[DataFrame], Column] = "default") -> DataFrame:
    """One message per analysed item; ``layout`` = default, chat or a function
    (:func:`user_layout` makes one of a template).
    Fields the input lacks render as empty."""
    for name, typ in LAYOUT_FIELDS.items():
        if name not in analyzed.columns:
            analyzed = analyzed.withColumn(name, F.lit(None).cast(typ))
    fn = {"default": render_default, "chat": render_chat}.get(layout, layout) if isinstance(layout, str) else layout
    if isinstance(fn, str):
        raise ValueError(f"unknown layout {layout!r}")
    return analyzed.withColumn("message", fn(analyzed))


# ---------------------------------------------------------------- A8
def file_records(rendered: DataFrame, now) -> DataFrame:
    """A8 record text: RFC3339 time, newline, message, separator."""
    stamp = F.date_format(ts_lit(now), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rendered.select(F.concat(stamp, F.lit("\n"), F.col("message"), F.lit(fixed.FILE_SEPARATOR)).alias("value"),
                           F.to_date(ts_lit(now)).alias("date"))


def write_messages(rendered: DataFrame, path: str, now) -> None:
    """A8 sink: append records as text, partitioned by date (idempotent per
    batch when the caller writes each batch id to its own sub-folder)."""
    file_records(rendered, now).write.mode("append").partitionBy("date").text(path)


# ---------------------------------------------------------------- A9 / C18 / C19
def delivery_requests(rendered: DataFrame, chat_id: str, parse_mode: str = "", disable_preview: bool = True,
                      thread_id: int = 0, parse_mode_col: Column | None = None) -> DataFrame:
    """Chat request JSON (keys sorted); parse_mode only when non-blank,
    message_thread_id only when > 0; an error row when the chat id is missing."""
    pm = parse_mode_col if parse_mode_col is not None else F.lit(parse_mode)
    fields = [F.lit(chat_id).alias("chat_id"), F.lit(disable_preview).alias("disable_web_page_preview")]
    if thread_id > 0:
        fields.append(F.lit(thread_id).alias("message_thread_id"))
    with_pm = F.to_json(F.struct(*fields, pm.alias("parse_mode"), F.col("message").alias("text")))
    without_pm = F.to_json(F.struct(*fields, F.col("message").alias("text")))
    body = go_json_escape(F.when(T.trim_space(pm) != "", with_pm).otherwise(without_pm))
    missing = not (chat_id or "").strip()
    return rendered.select(
        "*", F.when(F.lit(missing), F.lit(None).cast("string")).otherwise(body).alias("request"),
        F.lit("telegram chat id missing" if missing else "").alias("request_error"),
        pm.alias("parse_mode"))


def delivery_outcomes(responses: DataFrame) -> DataFrame:
    """Status >= 300 -> error with body (<= 8192 bytes read); undecodable
    body -> decode error; ok=false -> API error text; ok -> delivered."""
    body = F.substring(F.coalesce(F.col("body"), F.lit("")), 1, 8192)
    parsed = F.from_json(body, "ok boolean, description string")
    valid = F.try_parse_json(body).isNotNull() & F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT")
    err = (F.when(F.col("status_code") >= 300, F.concat(
        F.lit("telegram send failed status="), F.col("status_code").cast("string"), F.lit(" body="), T.trim_space(body)))
        .when(~F.coalesce(valid, F.lit(False)), F.lit("telegram response decode failed"))
        .when(~F.coalesce(parsed["ok"], F.lit(False)),
              F.concat(F.lit("telegram api not ok: "), F.coalesce(parsed["description"], F.lit(""))))
        .otherwise(F.lit("")))
    return responses.select("*", err.alias("error"), (err == "").alias("delivered"))


def delivery_fallback(outcomes: DataFrame) -> DataFrame:
    """Failed deliveries that broke entity parsing are resent without parse_mode."""
    retry = outcomes.filter(F.lower(F.col("error")).contains(fixed.PARSE_ENTITIES_ERROR)
                            & (T.trim_space(F.coalesce(F.col("parse_mode"), F.lit(""))) != ""))
    return retry.select("item_id", "message", "chat_id")


# ---------------------------------------------------------------- A12
def item_export(items: DataFrame, analyzed: DataFrame) -> DataFrame:
    """Stored payload if non-blank, else an 11-field JSON from the analysed projection."""
    a = analyzed.select(F.col("id").alias("_aid"), F.to_json(F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), F.col("id"), "source_label", "source_url", "title",
        "job_category", "role", "company", "seniority", "confidence",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))).alias("_json"))
    j = items.join(a, items["id"] == a["_aid"], "left")
    stored = T.trim_space(F.coalesce(F.col("analyzed_payload_json"), F.lit("")))
    return j.select("id", F.when(stored != "", F.col("analyzed_payload_json"))
                    .otherwise(F.coalesce(F.col("_json"), F.lit(""))).alias("analyzed_payload_json"))


# ---------------------------------------------------------------- H6
def pace(queue: DataFrame, per_min: int, dest: str = "dest", ready: str = "ready_at", key: str = "item_id",
         partitions: int | None = None) -> DataFrame:
    """H6: token bucket (burst 1): send_i = max(ready_i, send_{i-1} + spacing).

    Closed form send_i = i*spacing + max_{j<=i}(ready_j - j*spacing): a rank
    and a running max per destination in (ready, key) order, computed as a
    distributed scan so one destination holding most messages is never one
    task: range-partition by (dest, ready, key) (a hot destination spans many
    partitions) and checkpoint it; per (partition, dest) take the count and
    the local max of (ready - j*spacing); a window over that small summary
    gives each partition's rank offset and the max carried in; a window per
    (partition, dest) finishes.
    """
    per_min = per_min if per_min >= 1 else 10
    dt_us = int(60_000_000 // per_min)
    spark = queue.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r_us = F.unix_micros(F.col(ready).cast("timestamp"))
    part = reliable_checkpoint(queue.repartitionByRange(n, F.col(dest), F.col(ready), F.col(key))
                               .withColumn("_pid", F.spark_partition_id()).withColumn("_r", r_us))
    w_local = Window.partitionBy("_pid", dest).orderBy(F.col(ready), F.col(key))
    local = part.withColumn("_j", (F.row_number().over(w_local) - 1).cast("long"))  # times the spacing it outgrows an int
    summary = (local.groupBy("_pid", dest)
               .agg(F.count(F.lit(1)).alias("_c"), F.max(F.col("_r") - F.col("_j") * dt_us).alias("_lm")))
    w_sum = Window.partitionBy(dest).orderBy("_pid")
    before = w_sum.rowsBetween(Window.unboundedPreceding, -1)
    summary = (summary.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
               .withColumn("_carry", F.max(F.col("_lm") - F.col("_off") * dt_us).over(before))
               .select("_pid", dest, "_off", "_carry"))
    j = local.join(summary, ["_pid", dest])
    i = F.col("_off") + F.col("_j")
    run = F.max(F.col("_r") - (F.col("_off") + F.col("_j")) * dt_us).over(
        w_local.rowsBetween(Window.unboundedPreceding, 0))
    m = F.greatest(run, F.coalesce(F.col("_carry"), run))
    send = F.timestamp_micros(i * dt_us + m).cast("timestamp_ntz")
    return j.withColumn("send_at", send).drop("_pid", "_r", "_j", "_off", "_carry")
