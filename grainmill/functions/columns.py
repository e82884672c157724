"""Projections over observation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from grainmill.functions.hashing import row_identity

# The column names of the default observation schema.
MEASURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]
SCALED = {
    "sepal_length": "sl_norm",
    "sepal_width": "sw_norm",
    "petal_length": "pl_norm",
    "petal_width": "pw_norm",
}
KEYS = ["Id", "date", "hour"]
LOOKUP_KEYS = ["Id", "hour"]
TARGET = "target"
CLASSES = [0, 1, 2]


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename many columns in one projection."""
    return df.withColumnsRenamed(dict(names))


def stamp(df: DataFrame, moment: Column | None = None, date: str = "date", hour: str = "hour") -> DataFrame:
    """Add batch date and hour, from the clock or from a timestamp column."""
    moment = F.current_timestamp() if moment is None else moment
    return df.withColumns({date: F.to_date(moment), hour: F.hour(moment)})


def with_identity(df: DataFrame, columns: Sequence[str] | None = None, name: str = "Id") -> DataFrame:
    """Add a row id: random, or a hash of ``columns`` when a rerun must repeat it."""
    return df.withColumn(name, row_identity(columns) if columns else F.expr("uuid()"))


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*columns)


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Columns left after taking away target, prediction and the like."""
    return [c for c in df.columns if c not in set(exclude)]
