"""The newest period of a table, and tables without it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from grainmill.operators.joins import join_labels

DAYS_TRIED = 3


def newest_date(df: DataFrame, date: str = "date") -> DataFrame:
    """One row with the largest date; null for an empty table."""
    return df.agg(F.max(date).alias("newest_date"))


def flag_newest(df: DataFrame, date: str = "date", name: str = "is_newest") -> DataFrame:
    """Mark rows of the newest date; a null date is not marked."""
    same = F.col(date) == newest_date(df, date).scalar()
    return df.withColumn(name, F.coalesce(same, F.lit(False)))


def drop_newest(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows older than the newest date. The maximum is a scalar subquery over one column."""
    return df.filter(F.col(date) < newest_date(df, date).scalar())


def newest_shared_date(left: DataFrame, right: DataFrame, keys: Sequence[str], date: str = "date"):
    """The newest date on which both sides share a key, or None.

    That is the newest date of the inner join, found without running it: the two
    maxima bound it, and normally a semi-join of that one day's keys confirms it. After
    a few days without a match one semi-join of all older keys decides.
    """
    bound = None
    for _ in range(DAYS_TRIED):
        sides = []
        for side in (left, right):
            older = side if bound is None else side.filter(F.col(date) < F.lit(bound))
            sides.append(newest_date(older, date))
        newest = sides[0].unionByName(sides[1]).agg(
            F.min("newest_date").alias("newest"), F.count("newest_date").alias("sides")
        ).first()
        if newest["sides"] < 2:
            return None
        day = newest["newest"]
        on_day = [s.filter(F.col(date) == F.lit(day)).select(*keys) for s in (left, right)]
        if not on_day[0].join(on_day[1], list(keys), "left_semi").isEmpty():
            return day
        bound = day
    older = [s.filter(F.col(date) < F.lit(bound)).select(*keys) for s in (left, right)]
    return newest_date(older[0].join(older[1], list(keys), "left_semi"), date).first()[0]


def labelled_history(
    observations: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    **options,
) -> DataFrame:
    """Observations joined with labels, without the newest joined day.

    The date is one of the join keys, so the cut is made on both sides before the
    join: the newest day is neither shuffled nor, where possible, read.
    """
    newest = newest_shared_date(observations, labels, keys, date)
    cut = F.lit(False) if newest is None else F.col(date) < F.lit(newest)
    return join_labels(observations.filter(cut), labels.filter(cut), keys, **options)
