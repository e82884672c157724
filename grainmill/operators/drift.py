"""Drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.operators.joins import union_frames
from grainmill.operators.metrics import class_performance, pair_counts
from grainmill.session import materialise

# Thresholds of the drift report.
P_VALUE = 0.05
DRIFT_SHARE = 0.5
SERIES_TERMS = 100

LEAF_ROWS = 4_000_000  # rows of one value range that a single window task may hold, about
MOST_RANGES = 20_000  # of one feature; beyond 40 billion rows ranges grow, and their windows spill

SKETCH_K = 2_000  # size of a quantile sketch: some 20 KB for each feature
SKETCH_POINTS = 500  # quantiles of each side at which two sketches are compared
BINS = 10  # of a distribution in the drift document

SIDES = ("reference", "current")


def _known(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def _measures(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """Feature columns as doubles plus the side, nothing else."""
    return df.select(*[_known(f).alias(f) for f in features], F.lit(side).alias("side"))


# -- side-by-side summary ------------------------------------------------------


def drift_summary(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """n, nulls, mean, sd, min and max per feature and side.

    Each side is one pass with partial aggregates and ends in a single row, which is
    then turned into one row per feature.
    """
    out = []
    for side, df in zip(SIDES, (reference, current)):
        aggregates = [
            F.struct(
                F.lit(f).alias("feature"),
                F.lit(side).alias("side"),
                F.count(_known(f)).alias("n"),
                (F.count(F.lit(1)) - F.count(_known(f))).alias("n_missing"),
                F.avg(_known(f)).alias("mean"),
                F.stddev_pop(_known(f)).alias("sd"),
                F.min(_known(f)).alias("min"),
                F.max(_known(f)).alias("max"),
            )
            for f in features
        ]
        row = df.agg(F.array(*aggregates).alias("s"))
        out.append(row.select(F.explode("s").alias("s")).select("s.*"))
    return union_frames(out)


# -- two-sample Kolmogorov-Smirnov --------------------------------------------


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """2 * sum (-1)^(k-1) exp(-2 k^2 l^2), l = D sqrt(nm/(n+m)) (Kolmogorov 1933, Smirnov 1948).

    The series does not converge for small l, where the value is 1 to many places.
    """
    n, m = n.cast("double"), m.cast("double")
    lam = statistic * F.sqrt(n * m / (n + m))

    def term(k: Column) -> Column:
        k = k.cast("double")
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return sign * F.exp(F.lit(-2.0) * k * k * lam * lam)

    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), lambda total, k: total + term(k)
    )
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), series * 2))
    return F.when(lam < 0.2, 1.0).when(lam.isNotNull(), bounded)


def _long(df: DataFrame, features: Sequence[str], splits: dict[str, list[float]]) -> DataFrame:
    """One row per (feature, range of the value, value, side)."""
    ranged = Bucketizer(
        inputCols=list(features),
        outputCols=[f"_range_{f}" for f in features],
        splitsArray=[splits[f] for f in features],
        handleInvalid="keep",
    ).transform(df)
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f).alias("value"),
                F.col(f"_range_{f}").cast("int").alias("range"),
            )
            for f in features
        ]
    )
    return (
        ranged.select("side", F.explode(cells).alias("c"))
        .select("c.feature", "c.range", "c.value", "side")
        .filter(F.col("value").isNotNull())
    )


def _side_counts() -> list[Column]:
    return [F.count(F.when(F.col("side") == s, 1)).alias(f"n_{s}") for s in SIDES]


def _splits(both: DataFrame, features: Sequence[str], leaf_rows: int) -> dict[str, list[float]]:
    """Quantiles of every feature that cut it into ranges of at most about half ``leaf_rows`` rows.

    One pass makes mergeable sketches of all features; the driver sees the split points only.
    """
    pieces = min(MOST_RANGES, 2 * both.count() // leaf_rows + 1)
    shares = [i / pieces for i in range(1, pieces)] or [0.5]
    row = both.agg(*[F.percentile_approx(f, shares, 10 * pieces).alias(f) for f in features]).first()
    return {
        f: [-np.inf, *sorted({float(x) for x in row[f] or [] if np.isfinite(x)} or {0.0}), np.inf] for f in features
    }


def _range_table(counted: DataFrame) -> DataFrame:
    """Per value range: the rows before it and in all, the largest gap at any range end of the
    feature (``known``), and whether a larger one may lie inside the range (``open``).

    Both shares only grow inside a range, which bounds the gap there.
    """
    ahead = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    first, last = SIDES
    columns = {f"before_{s}": F.coalesce(F.sum(f"n_{s}").over(ahead), F.lit(0)) for s in SIDES}
    columns |= {f"all_{s}": F.sum(f"n_{s}").over(whole) for s in SIDES}
    table = counted.withColumns(columns)
    table = table.withColumns(
        {f"end_{s}": F.try_divide(F.col(f"before_{s}") + F.col(f"n_{s}"), F.col(f"all_{s}")) for s in SIDES}
        | {f"start_{s}": F.try_divide(f"before_{s}", f"all_{s}") for s in SIDES}
    )
    table = table.withColumn("known", F.max(F.abs(F.col(f"end_{first}") - F.col(f"end_{last}"))).over(whole))
    bound = F.greatest(F.col(f"end_{first}") - F.col(f"start_{last}"), F.col(f"end_{last}") - F.col(f"start_{first}"))
    open_ = (F.col("high") > F.col("low")) & (bound > F.col("known"))
    return table.select("feature", "range", *columns, "known", F.coalesce(open_, F.lit(False)).alias("open"))


def ks_statistics(
    reference: DataFrame, current: DataFrame, features: Sequence[str], leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Exact largest gap between the two empirical distributions of every feature.

    Columns: feature, n_reference, n_current, statistic (null when a side is empty).

    Quantiles cut every feature into ranges, whatever its values' spread. Counts per range, put in
    order on the executors, give the gap at every range end and a bound on the gap inside.
    Ranges whose bound cannot beat the best known gap are settled without moving a row; the
    others' values are counted and ranked within their range. That is four passes over the
    tables at most, and no range holds many more than ``leaf_rows`` different values.
    """
    features = list(features)
    both = _measures(reference, features, SIDES[0]).unionByName(_measures(current, features, SIDES[1]))
    splits = _splits(both, features, leaf_rows)
    counted = (
        _long(both, features, splits)
        .groupBy("feature", "range")
        .agg(*_side_counts(), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # Stored, so that the planner knows the size of this table and can broadcast it under its own limit.
    ranges = materialise(_range_table(counted), "ranges")
    totals = ranges.groupBy("feature").agg(
        *[F.max(f"all_{s}").alias(f"n_{s}") for s in SIDES], F.max("known").alias("known")
    )
    opened = ranges.where("open").select("feature", "range", *[f"{k}_{s}" for k in ("before", "all") for s in SIDES])
    values = (
        _long(both, features, splits)
        .join(opened, ["feature", "range"])
        .groupBy(*opened.columns, "value")
        .agg(*_side_counts())
    )
    upto = Window.partitionBy("feature", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    shares = [(F.sum(f"n_{s}").over(upto) + F.col(f"before_{s}")) / F.col(f"all_{s}") for s in SIDES]
    gaps = (
        values.select("feature", F.abs(shares[0] - shares[1]).alias("gap"))
        .groupBy("feature")
        .agg(F.max("gap").alias("gap"))
    )
    named = both.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    answer = named.join(totals, "feature", "left").join(gaps, "feature", "left")
    both_sides = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    return answer.select(
        "feature",
        *[F.coalesce(f"n_{s}", F.lit(0)).cast("bigint").alias(f"n_{s}") for s in SIDES],
        F.when(both_sides, F.greatest("known", "gap")).alias("statistic"),
    )


def feature_drift(
    reference: DataFrame, current: DataFrame, features: Sequence[str], p_value: float = P_VALUE, **options
) -> DataFrame:
    """KS statistic, p-value and drift flag per feature."""
    found = ks_statistics(reference, current, features, **options)
    p = ks_p_value(F.col("statistic"), F.col("n_reference"), F.col("n_current"))
    return found.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < F.lit(p_value))


# -- monitoring from a stored sketch ---------------------------------------------


def feature_sketches(df: DataFrame, features: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(feature, n, sketch): a mergeable quantile sketch (Karnin, Lang and Liberty 2016) of each feature.

    One pass. Stored with a training version, it spares monitoring the reading of the training rows;
    sketches of batches merge by ``kll_merge_agg_double``.
    """
    cells = [
        F.struct(F.lit(f).alias("feature"), F.count(_known(f)).alias("n"), F.kll_sketch_agg_double(_known(f), F.lit(k)).alias("sketch"))
        for f in features
    ]
    return df.agg(F.array(*cells).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def sketch_error(k: int = SKETCH_K, points: int = SKETCH_POINTS) -> float:
    """How far ``sketched_ks`` may lie from the exact statistic: two ranks, each off by 2.3 / k**0.97
    at most in 99 of 100 sketches (the authors' published fit), and what lies between two quantiles."""
    return 2 * (2.296 / k**0.9723 + 1 / points)


def sketched_ks(
    reference: DataFrame, current: DataFrame, k: int = SKETCH_K, points: int = SKETCH_POINTS
) -> DataFrame:
    """feature, n_reference, n_current, statistic, error: drift from two tables of ``feature_sketches``.

    Both sides give their quantiles; the gap is taken at each of them, between the shares of either
    side's quantiles that are no larger. ``statistic`` is null where a side is empty. One small row per feature.
    """
    shares = F.array(*[F.lit(i / points) for i in range(points + 1)])
    sides = reference.select("feature", F.col("n").alias("n_reference"), F.col("sketch").alias("r")).join(
        current.select("feature", F.col("n").alias("n_current"), F.col("sketch").alias("c")), "feature"
    )
    known = sides.where("n_reference > 0 AND n_current > 0").select(
        "feature",
        F.kll_sketch_get_quantile_double("r", shares).alias("r"),
        F.kll_sketch_get_quantile_double("c", shares).alias("c"),
    )
    # One running count along the quantiles of both sides; the gap counts after the last of equal values.
    marks = F.array_sort(
        F.concat(
            F.transform("r", lambda x: F.struct(x.alias("x"), F.lit(1).alias("d"))),
            F.transform("c", lambda x: F.struct(x.alias("x"), F.lit(-1).alias("d"))),
        )
    )
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(0).alias("gap"), F.lit(0).alias("most"))

    def step(at: Column, mark: Column) -> Column:
        ended = F.when(at["x"] < mark["x"], F.greatest(at["most"], F.abs(at["gap"]))).otherwise(at["most"])
        return F.struct(mark["x"].alias("x"), (at["gap"] + mark["d"]).alias("gap"), ended.alias("most"))

    most = F.aggregate(F.col("marks"), start, step, lambda at: F.greatest(at["most"], F.abs(at["gap"])))
    found = known.withColumn("marks", marks).select("feature", (most / F.lit(float(points))).alias("statistic"))
    return (
        sides.select("feature", "n_reference", "n_current")
        .join(found, "feature", "left")
        .withColumn("error", F.lit(sketch_error(k, points)))
    )


# -- distributions ---------------------------------------------------------------


def histograms(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """feature, low, high and the arrays in_reference, in_current: rows in equal bins from low to high.

    Both sides share the bins, which reach from the least to the greatest value of either. One pass
    for the ends and one for the counts, each ending in a single row. Missing values are in no bin; all
    equal values are in the first one; a feature without values has null ends and zeros.
    """
    both = _measures(reference, features, SIDES[0]).unionByName(_measures(current, features, SIDES[1]))
    ends = both.agg(*[x for f in features for x in (F.min(f).alias(f"low_{f}"), F.max(f).alias(f"high_{f}"))])
    ends = materialise(ends, "ends")
    row = ends.select(F.struct("*").alias("e")).scalar()
    places = {}
    for f in features:
        low, high = row[f"low_{f}"], row[f"high_{f}"]
        part = F.floor((F.col(f) - low) / (high - low) * bins)
        place = F.when(high > low, F.least(part, F.lit(bins - 1))).otherwise(0)
        places[f] = F.when(F.col(f).isNotNull(), place)  # least() would pass over a null
    placed = both.select("side", *[p.cast("int").alias(f) for f, p in places.items()])
    cells = []
    for f in features:
        sums = [
            F.array(*[F.count(F.when((F.col(f) == i) & (F.col("side") == side), 1)) for i in range(bins)]).alias(f"in_{side}")
            for side in SIDES
        ]
        cells.append(F.struct(F.lit(f).alias("feature"), *sums))
    counts = placed.agg(F.array(*cells).alias("h")).select(F.explode("h").alias("h")).select("h.*")
    named = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"low_{f}").alias("low"), F.col(f"high_{f}").alias("high")) for f in features]
    )
    ends = ends.select(F.explode(named).alias("e")).select("e.*")
    return ends.join(counts, "feature")


def _roll_up(share: float, *extra: Column) -> list[Column]:
    n = F.count(F.lit(1))
    drifted = F.count(F.when(F.col("drifted"), 1))
    part = drifted / F.nullif(n, F.lit(0))
    return [
        n.alias("n_features"),
        drifted.alias("n_drifted"),
        part.alias("drift_share"),
        (part >= F.lit(share)).alias("dataset_drift"),
        *extra,
    ]


def dataset_drift(per_feature: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """Share of drifted features and the overall flag."""
    return per_feature.agg(*_roll_up(share))


def drift_document(per_feature: DataFrame, share: float = DRIFT_SHARE, distributions: DataFrame | None = None) -> DataFrame:
    """One row: the roll-up plus an array of per-feature structs in feature order.

    The array has one element per feature, so it is as short as the feature list. With
    ``distributions`` (of ``histograms``) each element also has the bins of both sides.
    """
    if distributions is not None:
        per_feature = per_feature.join(distributions, "feature", "left")
    listed = F.array_sort(F.collect_list(F.struct(*per_feature.columns))).alias("features")
    return per_feature.agg(*_roll_up(share, listed))


# -- classification performance ------------------------------------------------


def performance_drift(
    reference: DataFrame,
    current: DataFrame,
    classes: Sequence,
    label: str = "target",
    prediction: str = "prediction",
) -> DataFrame:
    """Accuracy and per-class precision, recall and F1 for both sides; each is read once.

    A side without rows is reported with zeros.
    """
    pairs = []
    for side, df in zip(SIDES, (reference, current)):
        found = pair_counts(df, label, prediction)
        none = df.sparkSession.range(1).select(
            *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("actual", "predicted")],
            F.lit(0).cast("bigint").alias("n_rows"),
        )
        pairs.append(found.unionByName(none).withColumn("side", F.lit(side)))
    return class_performance(union_frames(pairs), classes, "side")
