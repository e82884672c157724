"""Tree models: grid search, regression and batch scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, functions as F, types as T

from grainmill.operators import forest as forests
from grainmill.session import spread

# A forest keeps a count of each row for each tree, some ten times the row's stored bytes.
FOREST_BYTES = 16 << 20  # estimated, of a partition

# The default grid, in Spark ML parameter names.
DEFAULT_GRID = {
    "maxDepth": [3, 10],
    "numTrees": [30, 50],
    "featureSubsetStrategy": ["auto"],
    "impurity": ["gini", "entropy"],
}
# Configuration names and their Spark ML counterparts.
PARAMETER_NAMES = {
    "max_depth": "maxDepth",
    "n_estimators": "numTrees",
    "max_features": "featureSubsetStrategy",
    "criterion": "impurity",
}


def grid_from_conf(grid: Mapping[str, Sequence]) -> dict[str, list]:
    """Translate configured parameter names; Spark ML names pass through."""
    return {PARAMETER_NAMES.get(name, name): list(values) for name, values in grid.items()}


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Feature vector; rows with a missing feature are skipped in training only."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    folds: int = 5,
    seed: int = 21,
    parallelism: int = 4,
    fold_by: Sequence[str] = (),
    max_bins: int = 64,
) -> CrossValidatorModel:
    """Cross-validated random forest, best accuracy wins.

    With key columns ``fold_by`` a row's fold follows from a hash of its key, however the rows
    lie. Without them ``train`` should come from a written table: the draw then follows row
    order within a partition, which a file scan repeats exactly and a recomputed shuffle may
    not. ``max_bins`` bounds the cuts looked at for each feature.

    A grid over the parameters in ``PARAMETER_NAMES`` is searched by ``forest``: every point's forest is grown and
    tried on every fold, all of them in the same passes over rows that are binned once. With other parameters, or
    vectors among the features, each is a fit of its own, ``parallelism`` at a time.
    """
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed, maxBins=max_bins)
    points = [
        {forest.getParam(name): value for name, value in zip(grid, values)}
        for values in product(*grid.values())
    ]
    search = CrossValidator(
        estimator=forest,
        estimatorParamMaps=points,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    fold = F.pmod(F.xxhash64(F.lit(seed), *fold_by), F.lit(folds)) if fold_by else F.floor(F.rand(seed) * folds)
    kinds = [f.dataType for f in train.select(*features).schema]
    if set(grid) <= set(PARAMETER_NAMES.values()) and all(isinstance(k, (T.NumericType, T.BooleanType)) for k in kinds):
        blocks = forests.blocks_of(train, features, label, fold.cast("int"), folds, max_bins, seed)
        if fold_by and not all(blocks.rows.values()):
            raise ValueError(f"a fold has no rows: {blocks.rows}")
        tried = [forest.copy(point) for point in points]
        accuracies = forests.search(blocks, tried)
        means = np.mean(accuracies, axis=0)
        best = forests.fit(blocks, tried[int(np.argmax(means))])
        model = CrossValidatorModel(best, means.tolist(), stdMetrics=np.std(accuracies, axis=0).tolist())
        return search._copyValues(model)
    # Rows are assembled once; the folds then share the vectors.
    rows = assembler(features).transform(spread(train.filter(F.col(label).isNotNull()), FOREST_BYTES))
    columns = ["features", F.col(label).cast("double").alias(label)]
    if fold_by:
        search.setFoldCol("fold")
        columns.append(fold.cast("int").alias("fold"))
    return search.fit(rows.select(*columns))


def fit_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 30,
    depth: int = 10,
    impurity: str = "gini",
    subset: str = "auto",
    seed: int = 21,
    max_bins: int = 64,
) -> PipelineModel:
    """One random forest without a search, ready for scoring; rows that lack a feature or label are left out."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, impurity=impurity,
        featureSubsetStrategy=subset, seed=seed, maxBins=max_bins,
    )
    rows = assembler(features).transform(spread(train.filter(F.col(label).isNotNull()), FOREST_BYTES))
    return scoring_model(features, forest.fit(rows.select("features", F.col(label).cast("double").alias(label))))


def grid_report(search: CrossValidatorModel) -> list[dict]:
    """One record per grid point: its parameters and mean accuracy."""
    return [
        {**{p.name: v for p, v in point.items()}, "accuracy": metric}
        for point, metric in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]


def scoring_model(features: Sequence[str], fitted) -> PipelineModel:
    """Assembler and fitted model as one stored object; scoring keeps every row."""
    keep = assembler(features).setHandleInvalid("keep")
    return PipelineModel(stages=[keep, fitted])


def fit_regression(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 20,
    depth: int = 5,
    seed: int = 21,
    max_bins: int = 64,
    subset: str = "auto",
) -> PipelineModel:
    """Random forest regression; scale the features first with stored moments."""
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, maxBins=max_bins,
        featureSubsetStrategy=subset,
    )
    rows = spread(train.filter(F.col(label).isNotNull()), FOREST_BYTES)
    return Pipeline(stages=[assembler(features), forest]).fit(rows)


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], as_type: str = "int") -> DataFrame:
    """Add ``prediction`` (and class probabilities); null where a feature is missing, NaN included."""
    known = F.lit(True)
    for f in features:
        known = known & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    scored = model.transform(df)
    out = scored.withColumn("prediction", F.when(known, F.col("prediction").cast(as_type)))
    if "probability" in scored.columns:
        out = out.withColumn("probability", F.when(known, vector_to_array("probability")))
    return out.drop("features", "rawPrediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
