"""Registered queries of the training-data operators."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (decontaminate, hard_negatives, langid, mixing, sentence_spans, simhash_vp, spotsigs, suffix_dedup, token_counts, token_files,
                          toxicity, transcripts, vector_codes)
from feedloom.llm.common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups over whole documents: 3-word shingles, at most 3 differing bits."""
    found = simhash_vp.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(F.col("did").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(F.col("did").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@register
def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document, its edited text, and their likeness."""
    found = spotsigs.edited_neighbours(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("did", "doc_id")


@register
def spotsigs_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second part of op2: groups of documents whose fingerprints are alike, compared within partitions of set length."""
    return spotsigs.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("did", "doc_id")


@register
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of all conversations, parsed back into roles and rendered.

    The model learns from four fifths of the conversations; ``n_right`` counts
    the recovered turns whose role and order are the true ones."""
    raw = transcripts.transcripts_of(table(spark, sf_dir, "conversations"))
    model = transcripts.fit(raw.filter(crc_mod("conv_id", 5) != 0))
    found = transcripts.format_chats(raw.select("conv_id", "part", "text", "roles"), model, parts=("conv_id", "part"))
    got = F.transform("turns", lambda t: t["role"])
    right = F.size(F.filter(F.arrays_zip(got.alias("g"), F.col("row.roles").alias("r")), lambda x: x["g"] == x["r"]))
    return found.select("row.conv_id", "row.part", F.coalesce(crc_mod("row.conv_id", 5) == 0, F.lit(False)).alias("held_out"),
                        F.size("row.roles").alias("n_turns"), F.size("turns").alias("n_found"), right.alias("n_right"),
                        F.array_join(got, " ").alias("roles"), "rendered")


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document; learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 3) != 1))
    return toxicity.score(docs, model).select(
        F.col("did").alias("doc_id"), F.coalesce(crc_mod("did", 3) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document; learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    langs, probs = langid.fit(docs.filter(crc_mod("doc_id", 5) != 0), path)
    found = langid.identify(docs, langs, probs, path)
    return found.select(F.col("did").alias("doc_id"), F.coalesce(crc_mod("did", 5) == 0, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


@register
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without the bytes of repeated 200-byte strings."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select(F.col("did").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of sources to flattened weights."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("row.doc_id", "source", "block", "slot", "pos")


ORACLES["op8_pfair_mix"] = mixing.MIX_SQL


@register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in whole documents, exactly or within the edit limit."""
    found = decontaminate.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", F.explode("hits").alias("h")).select(
        "doc_id", "h.item_id", "h.distance", F.col("h.start").alias("start_byte"), F.col("h.end").alias("end_byte"))


@register
def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without the sentences of repeated spans."""
    return sentence_spans.remove_repeated_spans(table(spark, sf_dir, "documents")).withColumnRenamed("did", "doc_id")


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding among all of them."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


ORACLES["op11_hard_negatives"] = hard_negatives.MINE_SQL


@register
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, four parts of a byte each."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).withColumnRenamed("vid", "vec_id")


@register
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document, packed into files and read back."""
    found = token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(F.col("did").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
