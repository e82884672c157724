"""A nearest-centroid scorer: deterministic, and expressible in plain SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

MAX_CLASSES = 1000  # a class list, not a key column


@dataclass(frozen=True)
class NearestCentroid:
    """Class means of each feature, small enough to live in the plan as literals."""

    features: tuple[str, ...]
    centroids: tuple[tuple, ...]  # (class, mean of each feature)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the class with the smallest squared distance, then the smallest class."""
        distances = []
        for label, *means in self.centroids:
            squared = [
                (F.col(f) - F.lit(m)) * (F.col(f) - F.lit(m)) for f, m in zip(self.features, means)
            ]
            distances.append(F.struct(sum(squared[1:], squared[0]).alias("d"), F.lit(label).alias("c")))
        known = F.lit(True)
        for f in self.features:
            known = known & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
        nearest = F.least(*distances) if len(distances) > 1 else distances[0]
        return df.withColumn(name, F.when(known, nearest["c"]))


def fit_centroids(df: DataFrame, features: Sequence[str], label: str) -> NearestCentroid:
    """Class means in one grouped aggregate; one row per class reaches the driver."""
    rows = (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(*[F.avg(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))).alias(f) for f in features])
        .orderBy(label)
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return NearestCentroid(tuple(features), tuple(tuple(r) for r in rows))
