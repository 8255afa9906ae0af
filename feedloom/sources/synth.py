"""Deterministic job postings generated from slot indexes.

The generator is a column program over any DataFrame of slots, so it scales
with its input (e.g. one slot per row of a table) and needs no driver loop.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.session import ts_lit


def _pool(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def _fmt(tpl: str, cols: dict) -> Column:
    parts = []
    for i, p in enumerate(re.split(r"\{(\w+)\}", tpl)):
        parts.append(F.lit(p) if i % 2 == 0 else cols[p])
    return F.concat(*parts)


def postings(slots: DataFrame, base_url: str, index: str = "index", ts: str = "published_at",
             keep: tuple = ()) -> DataFrame:
    """Posting columns for slots (index, published_at); ``keep`` columns pass through."""
    i = F.col(index)
    company, role, region = _pool(fixed.SYNTH_COMPANIES, i), _pool(fixed.SYNTH_ROLES, i), _pool(fixed.SYNTH_REGIONS, i)
    stack = F.transform(F.sequence(F.lit(0), F.lit(3)),
                        lambda k: F.element_at(F.array(*[F.lit(v) for v in fixed.SYNTH_STACK]),
                                               ((i + k) % len(fixed.SYNTH_STACK)).cast("int") + 1))
    slug = T.slugify(F.concat_ws(" ", company, role, i.cast("string")))
    return slots.select(
        *keep, i.alias("index"), F.col(ts).alias("published_at"), company.alias("company"), role.alias("role"),
        region.alias("region"), F.concat(F.lit("Remote ("), region, F.lit(")")).alias("location"),
        (F.lit(95) + (i % 5) * 10).cast("int").alias("salary_min_k"),
        (F.lit(120) + (i % 5) * 10).cast("int").alias("salary_max_k"),
        slug.alias("slug"),
        F.concat(F.lit(base_url.rstrip("/") + fixed.SYNTH_JOBS_PATH), slug).alias("url"),
        F.concat(role, F.lit(" at "), company).alias("title"),
        _fmt(fixed.SYNTH_DESCRIPTION, {"company": company, "role": role, "region": region}).alias("description"),
        F.lit(fixed.SYNTH_CATEGORY).alias("category"), F.lit(fixed.SYNTH_CONTRACT).alias("contract_type"),
        stack.alias("stack"))


def synth_postings(positions: DataFrame, now, interval_seconds: int = 300, base_url: str = "http://localhost",
                   pos: str = "i", keep: tuple = ()) -> DataFrame:
    """A10: slot i -> time = truncate(now, interval) - i*interval; index = unix time / interval."""
    start = F.unix_seconds(ts_lit(now).cast("timestamp"))
    slot_s = F.floor(start / interval_seconds) * interval_seconds - F.col(pos) * interval_seconds
    slots = positions.select(*keep, (slot_s / interval_seconds).cast("long").alias("index"),
                             F.timestamp_seconds(slot_s).cast("timestamp_ntz").alias("published_at"))
    return postings(slots, base_url, keep=keep)


def posting_from_slug(slugs: DataFrame, interval_seconds: int = 300, base_url: str = "http://localhost",
                      slug: str = "slug") -> DataFrame:
    """Trailing ``-(digits)`` -> index; regenerate; keep only exact slug matches."""
    s = T.trim_space(F.col(slug))
    idx = F.regexp_extract(s, "-(\\d+)$", 1)
    slots = slugs.select(s.alias("_req"), F.when(idx != "", idx.try_cast("long")).alias("index")).filter(
        F.col("index").isNotNull())
    slots = slots.withColumn("published_at", F.timestamp_seconds(F.col("index") * interval_seconds)
                             .cast("timestamp_ntz"))
    gen = postings(slots.select("index", "published_at").distinct(), base_url)
    req = slots.select("_req", "index")
    return gen.join(req, "index").filter(F.col("slug") == F.col("_req")).drop("_req")
