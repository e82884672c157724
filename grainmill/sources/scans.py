"""Reading tables and looking at a few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a catalog table by ``database.table`` name."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a parquet dataset; only ``columns`` are fetched."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order; planned as a per-task top-n, not a sort."""
    return df.orderBy(*order).limit(n)
