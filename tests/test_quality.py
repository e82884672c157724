import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.operators import centroid, drift, metrics
from tests.conftest import rows


def scored(spark, data):
    return spark.createDataFrame(data, "target int, prediction int")


PAIRS = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, None)]


def test_accuracy_counts_missing_as_wrong(spark):
    assert metrics.accuracy(scored(spark, PAIRS)).first().accuracy == pytest.approx(3 / 6)
    assert metrics.accuracy(scored(spark, [])).first().accuracy is None


def test_confusion_has_every_listed_cell(spark):
    cells = {(r.actual, r.predicted): r.n_rows for r in metrics.confusion_counts(scored(spark, PAIRS[:5]), [0, 1, 2, 3]).collect()}
    assert len(cells) == 16 and sum(cells.values()) == 5
    assert cells[(1, 1)] == 2 and cells[(2, 0)] == 1 and cells[(3, 3)] == 0
    shares = {(r.actual, r.predicted): r.share for r in metrics.confusion_shares(scored(spark, PAIRS[:5]), [0, 1, 2]).collect()}
    assert shares[(1, 1)] == pytest.approx(0.4) and sum(shares.values()) == pytest.approx(1)


def test_confusion_of_nothing(spark):
    empty = scored(spark, [])
    assert {r.n_rows for r in metrics.confusion_counts(empty, [0, 1]).collect()} == {0}
    assert {r.share for r in metrics.confusion_shares(empty, [0, 1]).collect()} == {None}


def test_counts(spark):
    df = scored(spark, PAIRS)
    assert rows(metrics.class_counts(df, "target")) == [(0, 2), (1, 2), (2, 2)]
    assert rows(metrics.row_count(df)) == [(6,)]


def test_r_squared_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (9.0, None)], "target double, prediction double")
    mean = 7 / 3
    wanted = 1 - (0.25 + 0 + 1) / sum((y - mean) ** 2 for y in (1, 2, 4))
    assert metrics.r_squared(df).first().r2 == pytest.approx(wanted)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "target double, prediction double")
    assert metrics.r_squared(flat).first().r2 is None


def test_performance_by_hand(spark):
    out = drift.performance_drift(scored(spark, PAIRS), scored(spark, PAIRS[:4]), [0, 1, 2])
    got = {(r.side, r["class"]): r for r in out.collect()}
    assert len(got) == 6
    zero = got[("reference", 0)]
    assert (zero.support, zero.precision, zero.recall, zero.f1) == (2, 0.5, 0.5, 0.5)
    assert zero.accuracy == pytest.approx(0.5) and got[("current", 0)].accuracy == pytest.approx(0.75)
    absent = got[("current", 2)]
    assert (absent.support, absent.precision, absent.recall, absent.f1) == (0, 0.0, 0.0, 0.0)


def test_a_side_without_rows_is_reported(spark):
    out = drift.performance_drift(scored(spark, PAIRS), scored(spark, PAIRS).where("false"), [0, 1])
    empty = [r for r in out.collect() if r.side == "current"]
    assert {r["class"] for r in empty} == {0, 1}
    assert all((r.support, r.precision, r.recall, r.f1, r.accuracy) == (0, 0.0, 0.0, 0.0, 0.0) for r in empty)


def test_nearest_centroid(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0), (2.0, 0.0, 0), (10.0, 0.0, 1), (1.0, 5.0, None)], "x double, y double, c int")
    model = centroid.fit_centroids(df, ["x", "y"], "c")
    assert model.centroids == ((0, 1.0, 0.0), (1, 10.0, 0.0))
    points = spark.createDataFrame([(0.0, 0.0), (9.0, 1.0), (5.5, 0.0), (None, 1.0)], "x double, y double")
    assert [r.prediction for r in model.predict(points).collect()] == [0, 1, 0, None]


# -- drift ---------------------------------------------------------------------


def brute_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    points = np.concatenate([a, b])
    return np.abs(np.searchsorted(a, points, "right") / len(a) - np.searchsorted(b, points, "right") / len(b)).max()


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


RNG = np.random.default_rng(4)
SAMPLES = {
    "shifted": (RNG.normal(0, 1, 900), RNG.normal(0.4, 1, 700)),
    "same law": (RNG.normal(0, 1, 900), RNG.normal(0, 1, 700)),
    "heavy tail": (np.exp(RNG.normal(0, 8, 900)), np.exp(RNG.normal(1, 8, 700))),
    "hot value": (np.where(RNG.random(900) < 0.4, 3.0, RNG.random(900) * 9), np.where(RNG.random(700) < 0.3, 3.0, RNG.random(700) * 9)),
    "integers": (RNG.integers(0, 5, 900), RNG.integers(0, 6, 700)),
    "wide": (np.concatenate([RNG.normal(0, 1, 899), [1e308]]), np.concatenate([RNG.normal(0, 1, 699), [-1e308]])),
    "infinite": (np.concatenate([RNG.normal(0, 1, 899), [np.inf]]), np.concatenate([RNG.normal(0, 1, 699), [-np.inf]])),
    "constant": (np.full(50, 2.0), np.full(40, 2.0)),
    "600 decades": (10.0 ** RNG.uniform(-300, 300, 2000), 10.0 ** RNG.uniform(-300, 299, 2000)),
    "disjoint": (RNG.random(300), RNG.random(200) + 5),
}


@pytest.mark.parametrize("name", list(SAMPLES))
def test_ks_statistic_is_exact_at_every_leaf_size(spark, name):
    a, b = SAMPLES[name]
    for leaf in (20, 100_000):
        row = drift.ks_statistics(column(spark, a), column(spark, b), ["x"], leaf_rows=leaf).first()
        assert (row.n_reference, row.n_current) == (len(a), len(b))
        assert row.statistic == pytest.approx(brute_ks(a, b), abs=1e-12)


def test_no_value_range_holds_many_more_rows_than_a_leaf(spark):
    a, b = SAMPLES["600 decades"]
    both = drift._measures(column(spark, a), ["x"], "reference").unionByName(drift._measures(column(spark, b), ["x"], "current"))
    splits = drift._splits(both, ["x"], 100)
    sizes = drift._long(both, ["x"], splits).groupBy("range").count().collect()
    assert max(r["count"] for r in sizes) <= 100


def test_ks_of_a_table_with_itself_is_zero(spark):
    df = column(spark, SAMPLES["shifted"][0])
    row = drift.feature_drift(df, df, ["x"], leaf_rows=50).first()
    assert row.statistic == 0.0 and row.p_value == 1.0 and row.drifted is False


def test_ks_with_nulls_and_empty_sides(spark):
    a = column(spark, [1, 2, None, float("nan")])
    row = drift.feature_drift(a, column(spark, [None]), ["x"]).first()
    assert (row.n_reference, row.n_current, row.statistic, row.p_value) == (2, 0, None, None)
    both = drift.feature_drift(column(spark, []), column(spark, []), ["x"]).first()
    assert (both.n_reference, both.statistic) == (0, None)


def test_several_features_at_once(spark):
    a, b = SAMPLES["shifted"]
    left = spark.createDataFrame([(float(v), 1.0, float(i)) for i, v in enumerate(a)], "x double, c double, i double")
    right = spark.createDataFrame([(float(v), 1.0, float(i)) for i, v in enumerate(b)], "x double, c double, i double")
    got = {r.feature: r.statistic for r in drift.ks_statistics(left, right, ["x", "c", "i"], leaf_rows=60).collect()}
    assert got["x"] == pytest.approx(brute_ks(a, b)) and got["c"] == 0.0
    assert got["i"] == pytest.approx(brute_ks(np.arange(len(a)), np.arange(len(b))))


def test_p_value_series(spark):
    df = spark.createDataFrame([(0.1, 200, 300), (0.0, 10, 10), (1.0, 50, 50)], "d double, n long, m long")
    got = [r[0] for r in df.select(drift.ks_p_value(F.col("d"), F.col("n"), F.col("m"))).collect()]
    lam = 0.1 * math.sqrt(200 * 300 / 500)
    wanted = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert got[0] == pytest.approx(wanted) and got[1] == 1.0 and 0 <= got[2] < 1e-10


def test_summary_roll_up_and_document(spark):
    a, b = SAMPLES["disjoint"]
    left, right = column(spark, [*a, None]), column(spark, b)
    side = {r.side: r for r in drift.drift_summary(left, right, ["x"]).collect()}
    assert side["reference"].n == 300 and side["reference"].n_missing == 1
    assert side["current"].mean == pytest.approx(b.mean()) and side["current"].sd == pytest.approx(b.std())
    per_feature = drift.feature_drift(left, right, ["x"])
    rolled = drift.dataset_drift(per_feature).first()
    assert (rolled.n_features, rolled.n_drifted, rolled.drift_share, rolled.dataset_drift) == (1, 1, 1.0, True)
    document = drift.drift_document(per_feature).collect()
    assert len(document) == 1 and document[0].features[0].feature == "x" and document[0].features[0].statistic == 1.0


def test_sketched_drift_is_within_its_error(spark):
    left = spark.range(6_000).select((F.col("id") % 100).cast("double").alias("a"), F.randn(1).alias("b"), F.lit(None).cast("double").alias("c"))
    right = spark.range(4_000).select((F.col("id") % 130).cast("double").alias("a"), (F.randn(2) * 2).alias("b"), F.lit(1.0).alias("c"))
    names = ["a", "b", "c"]
    batches = [drift.feature_sketches(left.where(F.pmod(F.xxhash64("b"), F.lit(3)) == i), names) for i in range(3)]
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2]).groupBy("feature")
    merged = whole.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    exact = {r.feature: r for r in drift.ks_statistics(left, right, names).collect()}
    got = {r.feature: r for r in drift.sketched_ks(merged, drift.feature_sketches(right, names)).collect()}
    assert set(got) == set(names) and got["c"].statistic is None is exact["c"].statistic
    for name in ("a", "b"):
        assert abs(got[name].statistic - exact[name].statistic) <= got[name].error < 0.01
        assert (got[name].n_reference, got[name].n_current) == (6_000, 4_000)


def test_histograms_by_hand(spark):
    left = spark.createDataFrame([(0.0, 5.0, None), (1.0, 5.0, None), (None, 5.0, None)], "a double, b double, c double")
    right = spark.createDataFrame([(10.0, 5.0, None), (float("nan"), None, None), (9.99, 5.0, None)], "a double, b double, c double")
    got = {r.feature: r for r in drift.histograms(left, right, ["a", "b", "c"], bins=4).collect()}
    assert (got["a"].low, got["a"].high) == (0.0, 10.0)
    assert got["a"].in_reference == [2, 0, 0, 0] and got["a"].in_current == [0, 0, 0, 2]
    assert got["b"].in_reference == [3, 0, 0, 0] and got["b"].in_current == [2, 0, 0, 0]
    assert got["c"].low is None and got["c"].in_reference == [0, 0, 0, 0] == got["c"].in_current
