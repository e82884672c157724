"""Standardised features, with moments that can be stored and used again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _known(name: str) -> Column:
    """The value as a double, with NaN counted as missing."""
    value = F.col(name).cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def fit_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: count, mean and population standard deviation of every column.

    One pass over the needed columns; each task sends a single partial row.
    """
    aggregates = []
    for c in columns:
        value = _known(c)
        aggregates += [
            F.count(value).alias(f"{c}_n"),
            F.avg(value).alias(f"{c}_mean"),
            F.stddev_pop(value).alias(f"{c}_sd"),
        ]
    return df.agg(*aggregates)


def tidy_moments(moments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same moments as one row per feature."""
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}_n").alias("n"),
            F.col(f"{c}_mean").alias("mean"),
            F.col(f"{c}_sd").alias("sd"),
        )
        for c in columns
    ]
    return moments.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def moment_states(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, mean, m2) of every column: m2 is the sum of squared differences from the mean.

    States of batches are kept and merged, so that a growing table is not read again.
    """
    n = F.col("n")
    tidy = tidy_moments(fit_moments(df, columns), columns)
    return tidy.select("feature", "n", "mean", (F.col("sd") * F.col("sd") * n).alias("m2"))


def merge_states(states: DataFrame) -> DataFrame:
    """One (feature, n, mean, m2) of several per feature, as if their rows had been read together.

    m2 adds up from the states' own and from how far their means lie from the common one (Chan,
    Golub and LeVeque 1979), so nothing large is subtracted. States without rows say nothing.
    """
    some = states.where("n > 0")
    whole = some.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("whole"))
    off = F.col("mean") - F.col("whole")
    merged = some.join(whole, "feature").groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.first("whole").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
    )
    none = states.select("feature").distinct()
    return none.join(merged, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mean", "m2")


def moments_of_states(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Merged states as the one row that ``apply_moments`` takes."""
    merged, aggregates = merge_states(states), []
    for c in columns:
        own = F.col("feature") == c
        aggregates += [
            F.coalesce(F.max(F.when(own, F.col("n"))), F.lit(0)).cast("bigint").alias(f"{c}_n"),
            F.max(F.when(own, F.col("mean"))).alias(f"{c}_mean"),
            F.max(F.when(own, F.sqrt(F.col("m2") / F.col("n")))).alias(f"{c}_sd"),
        ]
    return merged.agg(*aggregates)


def apply_moments(
    df: DataFrame, moments: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """z-scores of the columns in ``names`` under their new names, plus ``keep``.

    The one-row moments enter as a scalar subquery, so nothing is joined. A constant
    column scales to 0; a missing value stays missing.
    """
    fitted = moments.select(F.struct(*moments.columns).alias("m")).scalar()
    scaled = []
    for source, target in names.items():
        centred = _known(source) - fitted[f"{source}_mean"]
        spread = fitted[f"{source}_sd"]
        scaled.append(F.when(spread == 0, centred * 0.0).otherwise(centred / spread).alias(target))
    return df.select(*scaled, *keep)


def standardise(df: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """z-scores against the whole table's own moments."""
    return apply_moments(df, fit_moments(df, list(names)), names, keep)
