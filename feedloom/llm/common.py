"""Shared pieces of the training-data operators."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import reliable_checkpoint, scratch_path, ship_package

#: Rows handled at a time inside a Python stage; bounds its memory beside the texts themselves.
SLICE_ROWS = 512


def arrow_map(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Small slices of the incoming batches."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def keep(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint in the cluster's shared folder."""
    return reliable_checkpoint(df)


def stored(df: DataFrame) -> DataFrame:
    """A written Parquet table in the cluster's shared checkpoint folder, for
    larger intermediate rows (columnar and compressed, unlike a checkpoint).
    The folder is removed when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(did, text)``: the two columns an operator reads, under its own names.

    Null texts become empty, null ids stay null.  Other columns, whatever
    their names, are left behind.
    """
    return docs.select(F.col(id_col).cast("long").alias("did"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """``corpus`` rows with a join key ``(uid, th)``.

    Equal rows get equal keys: whatever is found for one of them holds for
    all.  ``th`` is a 64-bit hash of the text, ``uid`` the id, or, where that
    is null, a negative number from another hash: rows without ids are as many
    keys as texts, not one.
    """
    other = F.xxhash64(F.lit("no id"), "text").bitwiseOR(F.lit(-(2 ** 63)).cast("long"))
    return docs.select(F.coalesce("did", other).alias("uid"), F.xxhash64("text").alias("th"), "did", "text", *more)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)
