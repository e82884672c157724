"""A bagged forest whose left-out rows are known, and its out-of-bag score.

How often a tree sees a row is a Poisson draw by a hash of the tree's number and the row's key
(the bootstrap's limit for many rows), so nothing is stored to know which trees left a row out, and a
task that runs again draws the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from math import ceil, exp, factorial

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from grainmill.functions.hashing import seeded_digest
from grainmill.operators.modeling import assembler
from grainmill.session import materialise, spread

MOST_COPIES = 8  # one row in a million would come more often; it comes so many times


def copies(keys: Sequence[str], tree: int, seed: int) -> Column:
    """How often a tree sees a row: 0, 1, 2, ... with the chances of a Poisson variable of mean 1."""
    # Digits stand in the order of their numbers, so the digest is compared with the bounds as text.
    digest, below, out = seeded_digest(keys, seed + tree), 0.0, F
    for n in range(MOST_COPIES):
        below += exp(-1) / factorial(n)
        out = out.when(digest < F.lit(f"{ceil(below * 2**32):08x}"), n)
    return out.otherwise(MOST_COPIES)


@dataclass(frozen=True)
class BaggedForest:
    """Trees in order of their numbers; ``seed`` and ``keys`` tell which rows each has not seen."""

    trees: tuple[RandomForestClassificationModel, ...]
    features: tuple[str, ...]
    keys: tuple[str, ...]
    seed: int

    def _shares(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_shares``: for each tree the shares of the classes where the row falls."""
        out = assembler(self.features).setHandleInvalid("keep").transform(rows)
        for number, tree in enumerate(self.trees):
            tree = tree.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"_share_{number}")
            out = tree.transform(out)
        shares = F.array(*[vector_to_array(f"_share_{n}") for n in range(len(self.trees))])
        return out.select(*rows.columns, shares.alias("_shares"))

    def out_of_bag(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``n_out``, the trees that have not seen the row, and ``prediction``, the class
        of the largest mean share among those (the smallest of equals); null where every tree has seen it.

        For the rows that the forest was fitted on. No shuffle: a row's trees follow from its key.
        """
        trees = range(len(self.trees))
        unseen = [(copies(self.keys, n, self.seed) == 0).cast("int").alias(f"_unseen_{n}") for n in trees]
        voted = self._shares(rows).select("*", *unseen)
        n_out = sum((F.col(f"_unseen_{n}") for n in trees), F.lit(0))
        # Plain sums by class, which Spark compiles.
        sums = [
            sum((F.when(F.col(f"_unseen_{n}") == 1, F.col("_shares")[n][c]).otherwise(0.0) for n in trees), F.lit(0.0))
            for c in range(self.trees[0].numClasses)
        ]
        voted = voted.select(*rows.columns, n_out.alias("n_out"), F.array(*sums).alias("_sums"))
        winner = (F.array_position("_sums", F.array_max("_sums")) - 1).cast("int")
        return voted.select(*rows.columns, "n_out", F.when(F.col("n_out") > 0, winner).alias("prediction"))


def fit_bagged(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    trees: int = 30,
    depth: int = 10,
    impurity: str = "gini",
    subset: str = "auto",
    seed: int = 21,
    max_bins: int = 64,
    parallelism: int = 4,
) -> BaggedForest:
    """Fit ``trees`` trees, each on its own bootstrap of the rows, by a weight for each row and tree.

    Vectors and all trees' weights are stored once; every tree reads its own. ``keys`` identify a row.
    Rows without a label or a feature are left out.
    """
    known = assembler(features).transform(spread(train.where(F.col(label).isNotNull())))
    drawn = [copies(keys, n, seed).cast("tinyint").alias(f"copies_{n}") for n in range(trees)]
    stored = materialise(known.select("features", F.col(label).cast("double").alias("label"), *drawn), "bagging")
    subset = {"auto": "sqrt"}.get(subset, subset)  # of a forest; one tree alone would take all

    def fit(number: int) -> RandomForestClassificationModel:
        seen = stored.withColumn("weight", F.col(f"copies_{number}").cast("double")).where("weight > 0")
        tree = RandomForestClassifier(
            labelCol="label", weightCol="weight", numTrees=1, bootstrap=False, maxDepth=depth, impurity=impurity,
            featureSubsetStrategy=subset, seed=seed + number, maxBins=max_bins,
        )
        return tree.fit(seen.select("features", "label", "weight"))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        fitted = tuple(pool.map(fit, range(trees)))
    most = max(t.numClasses for t in fitted)
    if any(t.numClasses != most for t in fitted):
        raise ValueError("a tree's bootstrap lacks the last class; there are too few rows of it")
    return BaggedForest(fitted, tuple(features), tuple(keys), seed)


def oob_score(votes: DataFrame, label: str) -> DataFrame:
    """Accuracy over the rows of ``out_of_bag`` that have a prediction, and how many have one."""
    right = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    voted = [F.col("prediction").isNotNull(), F.col(label).isNotNull()]
    return votes.where(reduce(Column.__and__, voted)).agg(right.alias("oob_score"), F.count("*").alias("n_rows"))
