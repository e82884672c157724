"""JSON documents to nested tables and back, with a stated schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def to_document(df: DataFrame, name: str = "document") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def from_document(df: DataFrame, schema: T.StructType, name: str = "document") -> DataFrame:
    """Parse one JSON text per row into columns; malformed text fails the job."""
    parsed = F.from_json(F.col(name), schema, {"mode": "FAILFAST"})
    return df.select(parsed.alias("_doc")).select("_doc.*")
