"""Counts and quality measures as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def accuracy(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right; a missing prediction counts as wrong."""
    right = F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))
    return df.agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def confusion_counts(
    df: DataFrame, classes: Sequence, label: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """True by predicted class over a stated class list, absent cells as 0."""
    spark = df.sparkSession
    counted = pair_counts(df, label, prediction)
    listed = F.array(*[F.lit(c) for c in classes])
    cells = (
        spark.range(1)
        .select(F.explode(listed).alias("actual"))
        .select("actual", F.explode(listed).alias("predicted"))
    )
    return cells.join(counted, ["actual", "predicted"], "left").fillna(0, ["n_rows"])


def confusion_shares(
    df: DataFrame, classes: Sequence, label: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """Confusion counts over the grand total of the matrix.

    The window spans the cells, one per pair of listed classes, not the rows.
    """
    cells = confusion_counts(df, classes, label, prediction)
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return cells.select("actual", "predicted", (F.col("n_rows") / F.nullif(total, F.lit(0))).alias("share"))


def pair_counts(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class that occurs."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def class_performance(pairs: DataFrame, classes: Sequence, by: str) -> DataFrame:
    """Accuracy and per-class precision, recall and F1 from pair counts, per ``by``.

    Each pair feeds its true and its predicted class, so one grouping of a few rows
    serves all measures. Listed classes that do not occur are reported with zeros.
    """
    none = F.lit(0).cast("bigint")
    hit = F.coalesce(F.col("actual") == F.col("predicted"), F.lit(False))
    hits = F.when(hit, F.col("n_rows")).otherwise(none)
    per_side = Window.partitionBy(by)
    totals = pairs.withColumns(
        {"_hits": hits, "_all": F.sum("n_rows").over(per_side), "_right": F.sum(hits).over(per_side)}
    )

    def part(cls, hits, actual, predicted):
        return F.struct(
            cls.alias("class"), hits.alias("hits"), actual.alias("actual"), predicted.alias("predicted")
        )

    n = F.col("n_rows")
    parts = F.array(
        part(F.col("actual"), F.col("_hits"), n, none),
        part(F.col("predicted"), none, none, n),
        *[part(F.lit(c), none, none, none) for c in classes],
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    summed = (
        totals.select(by, "_all", "_right", F.explode(parts).alias("p"))
        .filter(F.col("p.class").isin(*classes))
        .groupBy(by, F.col("p.class").alias("class"))
        .agg(
            F.sum("p.hits").alias("hits"),
            F.sum("p.actual").alias("support"),
            F.sum("p.predicted").alias("called"),
            F.first("_all").alias("_all"),
            F.first("_right").alias("_right"),
        )
    )
    return summed.select(
        by,
        "class",
        "support",
        ratio(F.col("hits"), F.col("called")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(F.col("hits") * 2, F.col("support") + F.col("called")).alias("f1"),
        ratio(F.col("_right"), F.col("_all")).alias("accuracy"),
    )


def r_squared(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """1 - residual / total sum of squares, in one pass over rows that have both."""
    both = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    residual = F.sum((F.col(label) - F.col(prediction)) * (F.col(label) - F.col(prediction)))
    total = F.var_pop(label) * F.count(F.lit(1))
    return both.agg((1 - F.try_divide(residual, total)).alias("r2"))
