"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a hashed order, form blocks.  With weight ``w`` the
``j``-th block (from 0) is released at slot ``floor(j / w)`` and due at slot
``ceil((j + 1) / w)``; in each slot the released block with the earliest
deadline is taken (ties: smaller source name).  Weights are whole shares of a
cycle of ``cycle`` slots, so the schedule repeats and one cycle of it, a
bounded table, orders any number of documents: a block's slot follows from
its number alone.  Until the first source runs dry, every source is at all
times less than one block away from its target.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import keep

#: Slots of a cycle; grows to CYCLE_PER_SOURCE slots a source when there are more sources.
CYCLE = 1000
CYCLE_PER_SOURCE = 4
#: Documents per block.
BLOCK_DOCS = 8
#: Flattening exponent of the default weights (1: as the corpus, 0: all alike).
EXPONENT = 0.5
#: Documents per bucket of the distributed numbering.
BUCKET_DOCS = 1000


def default_weights(docs: DataFrame, source_col: str = "source", exponent: float = EXPONENT) -> DataFrame:
    """``(source, weight)``: every source's document count to the power ``exponent``; a null source is ''."""
    return docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("source")).agg(
        F.pow(F.count(F.lit(1)).cast("double"), F.lit(exponent)).alias("weight"))


def shares(weights: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """``(source, q, cycle)``: whole shares that sum to the cycle, at least one
    each, by largest remainders (ties: smaller source name).

    Weights must be positive; nulls and others count as the smallest share.
    One row a source: the weights are a parameter, not data."""
    every = Window.partitionBy()
    part = weights.select(F.coalesce(F.col("source"), F.lit("")).alias("source"),
                          F.when(F.col("weight") > 0, F.col("weight").cast("double")).otherwise(0.0).alias("weight")) \
        .groupBy("source").agg(F.max("weight").alias("weight")) \
        .select("source", "weight", F.count(F.lit(1)).over(every).alias("n"), F.sum("weight").over(every).alias("total")) \
        .withColumn("cycle", F.greatest(F.lit(cycle), F.col("n") * CYCLE_PER_SOURCE).cast("long")) \
        .withColumn("free", F.col("cycle") - F.col("n")) \
        .withColumn("exact", F.round(F.when(F.col("total") > 0, F.col("free") * F.col("weight") / F.col("total"))
                                     .otherwise(F.col("free") / F.col("n")), 9)) \
        .withColumn("whole", F.floor("exact"))
    rank = F.row_number().over(Window.orderBy(F.round(F.col("exact") - F.col("whole"), 9).desc(), "source"))
    left = F.col("free") - F.sum("whole").over(every)
    return part.select("source", "cycle", "whole", rank.alias("r"), left.alias("left")) \
        .select("source", (1 + F.col("whole") + F.when(F.col("r") <= F.col("left"), 1).otherwise(0)).cast("long").alias("q"), "cycle")


def schedule(quota: DataFrame) -> DataFrame:
    """One cycle: ``(source, q, cycle, j, slot)``, block ``j`` of the cycle of each source."""
    listed = quota.agg(F.array_sort(F.collect_list(F.struct("source", "q"))).alias("s"), F.max("cycle").cast("int").alias("n"))
    start = F.struct(F.transform("s", lambda _: F.lit(0).cast("long")).alias("done"), F.expr("cast(array() as array<int>)").alias("took"))

    def step(acc: Column, t: Column) -> Column:
        due = F.transform("s", lambda x, i: F.when(
            (F.get(acc["done"], i) < x["q"]) & (F.floor(F.get(acc["done"], i) * F.col("n") / x["q"]) <= t),
            F.struct(F.ceil((F.get(acc["done"], i) + 1) * F.col("n") / x["q"]).alias("deadline"), i.alias("i"))))
        pick = F.array_min(F.filter(due, lambda x: x.isNotNull()))
        return F.struct(F.transform(acc["done"], lambda d, i: d + F.when(i == pick["i"], F.lit(1)).otherwise(F.lit(0))).alias("done"),
                        F.concat(acc["took"], F.array(F.coalesce(pick["i"], F.lit(-1)))).alias("took"))

    took = listed.filter("n is not null").select("s", "n", F.aggregate(F.sequence(F.lit(0), F.col("n") - 1), start, step)["took"].alias("took"))
    slots = took.select("s", F.posexplode("took").alias("slot", "i")).filter("i >= 0") \
        .select(F.expr("s[i].source").alias("source"), F.expr("s[i].q").alias("q"), "slot")
    numbered = slots.withColumn("j", F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1)
    return numbered.join(quota.select("source", "cycle"), "source")


def _hashed(id_col: str, text_col: str) -> Column:
    """MD5 of the id, or of the text's where there is none: rows without ids are not one key."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", cycle: int = CYCLE, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Every document once, as struct ``row`` with its ``source``, ``block``
    (number within the source), ``slot`` (place of the block in the mix) and
    ``pos`` (place in the block).  Sorting by ``(slot, pos)`` gives the mix.

    Within a source, documents go by the MD5 of their id (without one, of their
    text's), then by id and text
    (repeated rows in any order, they are alike).  After the first source has
    run dry its slots stay empty and the others keep theirs.  Sources without
    a weight share the smallest quota; weights without documents keep their
    slots empty.  A null source is ''; null ids and texts keep their rows; an
    empty table gives no rows.  The numbering is distributed: each source is
    cut into buckets of about BUCKET_DOCS documents by hash, numbered there,
    and shifted by the counts of the buckets before.
    """
    if weights is None:
        weights = default_weights(docs, source_col)
    else:
        seen = docs.select(F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct().select("source", F.lit(0.0).alias("weight"))
        weights = weights.select("source", "weight").unionByName(seen)
    plan = keep(schedule(keep(shares(weights, cycle))))
    n_buckets = max(1, -(-docs.count() // BUCKET_DOCS))

    def tagged(df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(F.coalesce(F.col(source_col), F.lit("")).alias("source"), _hashed(id_col, text_col).alias("md"), *extra) \
            .withColumn("bucket", F.floor(F.conv(F.substring("md", 1, 8), 16, 10).cast("long") * n_buckets / F.lit(2 ** 32)).cast("long"))

    before = tagged(docs).groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n")) \
        .select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("before"))
    order = Window.partitionBy("source", "bucket").orderBy("md", "id", "th")
    rows = tagged(docs, F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.struct(*[docs[c] for c in docs.columns]).alias("row")) \
        .withColumn("rn", F.row_number().over(order) - 1)
    quota = plan.groupBy("source").agg(F.first("q").alias("q"), F.first("cycle").alias("cycle"))
    numbered = rows.join(keep(before), ["source", "bucket"]).withColumn("k", F.col("before") + F.col("rn")) \
        .withColumn("block", F.floor(F.col("k") / block_docs)).withColumn("pos", (F.col("k") % block_docs).cast("int")) \
        .join(quota, "source").withColumn("j", F.col("block") % F.col("q"))
    return numbered.join(plan.select("source", "j", F.col("slot").alias("s")), ["source", "j"]) \
        .select("row", "source", "block", (F.floor(F.col("block") / F.col("q")) * F.col("cycle") + F.col("s")).alias("slot"), "pos")


#: The mix of the whole ``documents`` table with default weights, for DuckDB.
MIX_SQL = f"""WITH RECURSIVE w AS (
  SELECT coalesce(source, '') AS source, pow(CAST(count(*) AS DOUBLE), {EXPONENT}) AS weight FROM documents GROUP BY 1),
p AS (SELECT source, greatest({CYCLE}, {CYCLE_PER_SOURCE} * count(*) OVER ()) AS cyc,
        greatest({CYCLE}, {CYCLE_PER_SOURCE} * count(*) OVER ()) - count(*) OVER () AS free,
        round((greatest({CYCLE}, {CYCLE_PER_SOURCE} * count(*) OVER ()) - count(*) OVER ()) * weight / sum(weight) OVER (), 9) AS exact FROM w),
r AS (SELECT *, floor(exact) AS whole, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, source) AS rk,
        free - sum(floor(exact)) OVER () AS lft FROM p),
quota AS (SELECT source, CAST(1 + whole + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS BIGINT) AS q, cyc FROM r),
l AS (SELECT list(q ORDER BY source) AS qs, list(source ORDER BY source) AS names, any_value(cyc) AS n FROM quota),
edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform((SELECT qs FROM l), lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) WHERE (SELECT n FROM l) IS NOT NULL
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: CASE WHEN i = best THEN d + 1 ELSE d END), best FROM (
    SELECT t, done, list_min(list_transform(list_filter(generate_series(1, len(qs)),
        lambda i: done[i] < qs[i] AND done[i] * n // qs[i] <= t + 1),
        lambda i: (((done[i] + 1) * n + qs[i] - 1) // qs[i]) * 1000000 + i)) % 1000000 AS best
    FROM edf, l WHERE t + 1 < n)),
plan AS (SELECT names[pick] AS source, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM edf, l WHERE t >= 0),
k AS (SELECT doc_id, coalesce(source, '') AS source,
        row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), doc_id) - 1 AS k FROM documents)
SELECT doc_id, k.source, k // {BLOCK_DOCS} AS block, (k // {BLOCK_DOCS} // q) * cyc + slot AS slot, CAST(k % {BLOCK_DOCS} AS INTEGER) AS pos
FROM k JOIN quota USING (source) JOIN plan ON plan.source = k.source AND plan.j = (k // {BLOCK_DOCS}) % q"""
