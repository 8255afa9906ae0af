"""Corpus pipeline: from raw ``documents`` to a mixed training order.

Every stage works on all rows that its predecessor kept, and all but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, langid, mixing, simhash_vp, suffix_dedup


def _columns(docs: DataFrame, row: str, **new: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, some of them replaced."""
    return [new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(row).getField(c).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language of the labelled rows, go.
    A missing ``lang`` becomes the predicted one.

    Null and empty texts have no letters; null ids and repeated rows are
    documents like others; without any labelled row, and for an empty table,
    nothing stays; other columns pass as they are, whatever their names."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    langs, probs = langid.fit(docs, path)
    if not langs:
        return docs.limit(0)  # nothing to tell languages by: every document is undetermined
    kept = langid.written_in_learned(langid.identify(docs, langs, probs, path, carry=tuple(docs.columns)))
    return kept.select(*_columns(docs, "row", lang=F.coalesce(F.col("row").getField("lang"), F.col("lang_pred"))))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id, null ids last.

    Null and empty texts are one group; of repeated rows one stays; an empty
    table stays empty; other columns pass as they are."""
    return simhash_vp.one_of_each(docs, shingle=3, max_bits=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings go; ``text`` and ``n_chars`` follow.

    No document goes: a text that repeats whole becomes empty, a null text is
    empty from here on.  Null ids and repeated rows keep their rows; an empty
    table stays empty; other columns pass as they are."""
    cut = suffix_dedup.remove_repeats(docs, length=200, carry=tuple(c for c in docs.columns if c != "text"))
    return cut.select(*_columns(docs, "row", text=F.col("kept_text"), n_chars=F.length("kept_text")))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or slightly edited, go.

    Null and empty texts hold none; null ids and repeated rows are judged like
    others; an empty table, or an empty benchmark, leaves all as it is."""
    found = decontaminate.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("hits") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix: order by ``(slot, pos)``.

    Null sources are one source of their own; null ids, null texts and repeated
    rows keep their rows; an empty table stays empty.  Columns ``block``,
    ``slot`` and ``pos`` that the documents had give way to the mix's."""
    mixed = mixing.mix(docs)
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("block", "slot", "pos")], "block", "slot", "pos")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]

#: The stages' models and hashes cannot be written in DuckDB SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
