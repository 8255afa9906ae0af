"""Parquet table access (A4 included: fetched page bodies as a table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: ``(page_id, url, html)``, whole bodies."""
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")


def write_pages(df: DataFrame, path: str, mode: str = "append") -> None:
    """A4 sink: whole page bodies as parquet, partitioned only by what the caller gives."""
    df.select("url", "html").write.mode(mode).parquet(path)
