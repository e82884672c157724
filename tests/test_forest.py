import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.operators import forest, modeling
from grainmill.session import materialise

GRID = {"maxDepth": [2, 4], "numTrees": [5, 8], "featureSubsetStrategy": ["all"], "impurity": ["gini", "entropy"]}


@pytest.fixture(scope="module")
def noisy(spark):
    """Two features, one of many values, and a class that follows from them but for some noise."""
    rows = spark.range(900).select(
        "id", (F.col("id") % 9).cast("int").alias("a"), F.round(F.rand(1) * 1000, 2).alias("b"), F.rand(2).alias("noise")
    )
    label = F.when(F.col("noise") < 0.1, 0).when((F.col("a") < 4) & (F.col("b") < 600), 1).otherwise(2)
    return materialise(rows.select("id", "a", "b", label.alias("target")), "noisy")


def jobs_of(spark, grid, rows):
    spark.sparkContext.setJobGroup(group := f"grid-{len(grid['numTrees'])}-{id(grid)}", "")
    try:
        modeling.grid_search(rows, ["a", "b"], "target", grid, folds=3, fold_by=["id"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_points_of_a_grid_share_the_passes_over_the_rows(spark, noisy):
    alone = {k: v[-1:] for k, v in GRID.items()}
    assert jobs_of(spark, GRID, noisy) <= jobs_of(spark, alone, noisy) + 4  # a final fit may be deeper


def test_a_point_scores_in_a_grid_what_it_scores_alone(noisy):
    whole = modeling.grid_search(noisy, ["a", "b"], "target", GRID, folds=3, fold_by=["id"])
    report = modeling.grid_report(whole)
    assert len(report) == 8 and len(whole.stdMetrics) == 8
    for point in (report[0], report[5]):
        alone = {name: [point[name]] for name in GRID}
        search = modeling.grid_search(noisy, ["a", "b"], "target", alone, folds=3, fold_by=["id"])
        assert search.avgMetrics == [point["accuracy"]]
    assert whole.bestModel.getNumTrees == max(report, key=lambda p: p["accuracy"])["numTrees"]


def test_scores_are_those_of_separate_fits(noisy):
    """A parameter the shared search does not know leads to a fit of Spark ML for every point and fold."""
    shared = modeling.grid_search(noisy, ["a", "b"], "target", GRID, folds=3, fold_by=["id"])
    fits = modeling.grid_search(noisy, ["a", "b"], "target", GRID | {"minInfoGain": [0.0]}, folds=3, fold_by=["id"])
    assert np.abs(np.array(shared.avgMetrics) - fits.avgMetrics).max() < 0.03
    assert shared.bestModel.numFeatures == 2 and shared.bestModel.numClasses == 3
    assert np.abs(shared.bestModel.featureImportances.toArray() - fits.bestModel.featureImportances.toArray()).max() < 0.1


def test_rows_of_equal_bins_are_stored_once(spark, noisy):
    rows = noisy.select("a", F.lit(1.5).alias("b"), F.lit(1).alias("target")).crossJoin(spark.range(3))
    odd = spark.createDataFrame([(None, 1.0, 1), (1, float("nan"), 1), (1, 1.0, None)], "a int, b double, target int")
    rows = rows.drop("id").unionByName(odd)
    blocks = forest.blocks_of(rows, ["a", "b"], "target", F.lit(0), 2, 64, 21)
    assert blocks.rows == {0: 2700, 1: 0} and blocks.classes == 2
    assert [c.tolist() for c in blocks.cuts] == [[0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5], []]
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in blocks.table.collect()])
    assert sorted(counts.tolist()) == [300] * 9


def test_a_fitted_forest_says_what_its_trees_say(spark, noisy):
    point = modeling.RandomForestClassifier(labelCol="target", numTrees=3, maxDepth=3, seed=5)
    blocks = forest.blocks_of(noisy, ["a", "b"], "target", F.lit(0), 1, 16, 5)
    model = forest.fit(blocks, point)
    (trees,) = forest.grow(blocks, [forest._plan(point, forest.NO_FOLD, 2)])
    for row in noisy.limit(60).collect():
        votes = 0.0
        for tree in trees:
            node = 0
            while tree.feature[node] >= 0:
                f = tree.feature[node]
                node = tree.left[node] + (row[1 + f] > blocks.cuts[f][tree.cut[node]])
            votes = votes + tree.stats[node] / tree.stats[node].sum()
        vector = modeling.assembler(["a", "b"]).transform(noisy.where(F.col("id") == row["id"])).first()["features"]
        assert np.allclose(model.predictProbability(vector).toArray(), votes / 3)


@pytest.mark.parametrize(("cells", "few"), [(5 * 2 * 16 * 3, 8), (1 << 23, 0), (1 << 23, 1 << 40)])
def test_passes_and_ways_to_add_lead_to_the_same_trees(noisy, monkeypatch, cells, few):
    blocks = forest.blocks_of(noisy, ["a", "b"], "target", F.col("id").cast("int") % 2, 2, 16, 5)
    plans = [forest.Plan(0, "gini", 1, 3, 4), forest.Plan(1, "entropy", 2, 2, 4), forest.Plan(0, "gini", 1, 2, 2)]
    usual = forest.grow(blocks, plans)
    monkeypatch.setattr(forest, "CELLS", cells)
    monkeypatch.setattr(forest, "FEW", few)
    for a, b in zip(usual, forest.grow(blocks, plans), strict=True):
        for x, y in zip(a, b, strict=True):
            assert (x.feature, x.cut, x.place) == (y.feature, y.cut, y.place) and np.array_equal(x.stats, y.stats)
    assert len(usual[0]) == 3 and max(x.bit_length() for t in usual[0] for x in t.place) == 5


def test_each_node_draws_its_features():
    drawn = forest._drawn(-3, [0] * 400 + [1] * 400, [*range(1, 401)] * 2, [2] * 800, 5)
    assert (drawn.sum(1) == 2).all() and (np.abs(drawn.mean(0) - 0.4) < 0.08).all()
    assert (drawn[:400] != drawn[400:]).any() and np.array_equal(drawn, forest._drawn(-3, [0] * 400 + [1] * 400, [*range(1, 401)] * 2, [2] * 800, 5))


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_best_split_against_all_splits(kind):
    sums = np.random.default_rng(3).poisson(1.0, (6, 3, 5, 2)).astype(float)
    sums[:, 1:] = sums[:, :1, ::-1]  # every feature has the node's rows
    allowed = np.array([[True, True, False]] * 6)

    def impurity(x):
        p = x / x.sum() if x.sum() else x
        return 1 - (p * p).sum() if kind == "gini" else -sum(q * np.log2(q) for q in p if q)

    feature, cut, gain, left, whole = forest.best_splits(sums, kind, allowed)
    for k in range(6):
        best = max(
            impurity(whole[k]) - (x.sum() * impurity(x) + y.sum() * impurity(y)) / whole[k].sum()
            for j in range(2)
            for b in range(4)
            if (x := sums[k, j, : b + 1].sum(0)).sum() and (y := sums[k, j, b + 1 :].sum(0)).sum()
        )
        assert feature[k] < 2 and np.isclose(gain[k], best)
        assert np.array_equal(left[k], sums[k, feature[k], : cut[k] + 1].sum(0))


def test_leaves_of_one_class_are_put_together():
    tree = forest.Tree()
    tree.stats[0] = np.array([7.0, 3.0])
    _, right = tree.split(0, 0, 1, 0.1, np.array([4.0, 0.0]))
    tree.split(right, 0, 2, 0.1, np.array([2.0, 1.0]))
    assert tree.pruned().feature == [0, -1, 0, -1, -1]
    tree.stats[4] = np.array([2.0, 1.0])
    tree.stats[2] = np.array([4.0, 2.0])
    assert tree.pruned().feature[2] == -1 and tree.pruned().feature[0] == -1


def test_features_per_node():
    found = [forest.features_per_node(s, 9, 10) for s in ("auto", "all", "sqrt", "log2", "onethird", "3", "0.25", "40")]
    assert found == [4, 10, 4, 4, 4, 3, 3, 10] and forest.features_per_node("auto", 1, 10) == 10


def test_unusable_rows_are_refused(noisy):
    with pytest.raises(ValueError, match="no row"):
        modeling.grid_search(noisy.where("id < 0"), ["a"], "target", GRID, folds=2)
    with pytest.raises(ValueError, match="whole numbers"):
        modeling.grid_search(noisy.withColumn("target", F.col("target") + 0.5), ["a"], "target", GRID, folds=2)
    with pytest.raises(ValueError, match="no rows"):
        modeling.grid_search(noisy.where("id = 1"), ["a"], "target", GRID, folds=2, fold_by=["id"])
