"""Readers for the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain parquet read; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_wide(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Pruned read of a large table; its parallelism is that of its row groups."""
    return read_table(spark, sf_dir, name).select(*columns)
