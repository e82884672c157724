import glob
import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill import session
from grainmill.operators import mixture, modeling, registry, scaling
from grainmill.plans import inputs, jobs, queries
from grainmill.session import materialise, shared_dir
from tests.conftest import rows

VERSIONS = [
    ("m", "9", "Staging", "r9"),
    ("m", "10", "None", "r10"),
    ("m", "8", "Production", "r8"),
    ("n", "1", "None", "q1"),
    ("n", "2", "None", "q2"),
]


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(VERSIONS, "name string, version string, stage string, run_id string")


def test_newest_compares_versions_as_numbers(versions):
    assert rows(registry.newest_models(versions)) == [("m", "10", "None", "r10"), ("n", "2", "None", "q2")]
    assert rows(registry.newest_models(versions, "Staging")) == [("m", "9", "Staging", "r9")]
    assert rows(registry.newest_models(versions, "Archived")) == []


def test_gate_includes_its_threshold(spark):
    df = spark.createDataFrame([(0.8,), (0.79,), (None,)], "accuracy double")
    assert [r.validation for r in registry.gate(df).collect()] == ["passed", "failed", "failed"]


def test_promotion(spark, versions):
    measured = spark.createDataFrame(
        [("m", "10", 0.9), ("n", "1", 0.9), ("n", "2", 0.5)], "name string, version string, accuracy double"
    )
    assert rows(registry.promote_to_staging(versions, measured, "dev")) == sorted(VERSIONS)
    staged = {(r.name, r.version): r.stage for r in registry.promote_to_staging(versions, measured, "staging").collect()}
    assert len(staged) == 5 and staged[("m", "10")] == "Staging" and staged[("n", "2")] == "None" and staged[("n", "1")] == "None"
    live = {(r.name, r.version): r.stage for r in registry.promote_to_production(versions).collect()}
    assert len(live) == 5 and live[("m", "9")] == "Production" and live[("m", "10")] == "None"


def test_tags(spark, versions):
    tags = spark.createDataFrame(
        [("r10", "test", "1", 1), ("r10", "test", "2", 2), ("r10", "train", "7", 1), ("q1", "test", "5", 9)],
        "run_id string, key string, value string, logged_at int",
    )
    assert rows(registry.latest_tags(tags)) == [("q1", "test", "5"), ("r10", "test", "2"), ("r10", "train", "7")]
    resolved = registry.resolve_tags(versions, tags, ["train", "test"])
    assert {(r.name, r.train, r.test) for r in resolved.collect()} == {("m", "7", "2"), ("n", None, None)}


def separable(spark, n=600):
    return spark.range(n).select(
        (F.col("id") % 3 * 10.0 + F.rand(3)).alias("a"), F.rand(4).alias("b"), (F.col("id") % 3).cast("int").alias("target")
    )


def test_grid_search_finds_the_depth_that_works(spark, tmp_path):
    train = materialise(separable(spark), "train")
    search = modeling.grid_search(
        train, ["a", "b"], "target", {"maxDepth": [1, 3], "numTrees": [1], "featureSubsetStrategy": ["all"]}, folds=2
    )
    report = modeling.grid_report(search)
    assert [p["maxDepth"] for p in report] == [1, 3] and report[1]["accuracy"] > report[0]["accuracy"]
    path = str(tmp_path / "model")
    modeling.save_model(modeling.scoring_model(["a", "b"], search.bestModel), path)
    some = train.unionByName(spark.createDataFrame([(None, 1.0, 0)], train.schema))
    scored = modeling.score(modeling.load_model(path), some, ["a", "b"])
    assert scored.count() == 601
    assert scored.filter("prediction IS NULL").count() == 1
    assert scored.filter("prediction = target").count() > 570
    assert len(scored.filter("prediction = 0").first().probability) == 3


def test_configured_parameter_names():
    assert modeling.grid_from_conf({"max_depth": [3], "criterion": ["gini"], "numTrees": [5]}) == {
        "maxDepth": [3],
        "impurity": ["gini"],
        "numTrees": [5],
    }


def test_mixture_sample_follows_its_class(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 2 == 0, F.randn(1) * 0.5 + 100).otherwise(F.randn(2) * 2 - 50).alias("x"),
        F.randn(3).alias("y"),
        (F.col("id") % 2).cast("int").alias("target"),
    )
    fitted = mixture.fit_mixtures(df, ["x", "y"], "target", [0, 1, 2], components=2, iterations=5, restarts=2)
    assert {c.label for c in fitted} == {0, 1}
    wanted = mixture.request_classes(spark, [0, 1], 500)
    sample = mixture.sample_mixtures(wanted, fitted, "target", ["x", "y"], ["sequence"], 1)
    m = {r.target: r for r in sample.groupBy("target").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev("x").alias("sd")).collect()}
    assert m[0].n == m[1].n == 500
    assert abs(m[0].mean - 100) < 0.3 and abs(m[0].sd - 0.5) < 0.15
    assert abs(m[1].mean + 50) < 0.6 and abs(m[1].sd - 2) < 0.4
    again = mixture.sample_mixtures(wanted.repartition(3), fitted, "target", ["x", "y"], ["sequence"], 1)
    assert rows(again) == rows(sample)


def test_mixture_sample_fits_with_the_defaults(spark, monkeypatch):
    fit, signature, calls = mixture.fit_mixtures, inspect.signature(mixture.fit_mixtures), []
    small = {"components": 2, "iterations": 1, "restarts": 1}

    def spy(*args, **options):
        bound = signature.bind(*args, **options)
        bound.apply_defaults()
        calls.append({k: bound.arguments[k] for k in small})
        return fit(*args, **options | small)

    monkeypatch.setattr(mixture, "fit_mixtures", spy)
    folder = "/root/testdata/sf0.001"
    drawn = queries.mixture_sample(spark, folder)
    assert calls == [{"components": 10, "iterations": 20, "restarts": 10}]
    assert drawn.count() == inputs.lines(spark, folder).count()


def clusters(spark, n=1200):
    """Three far clusters of class 0, one of class 1, and rows that cannot be used."""
    made = spark.range(n).select(
        (F.randn(1) * 0.3 + F.col("id") % 3 * 100).alias("x"),
        (F.randn(2) + F.col("id") % 3 * -50).alias("y"),
        F.when(F.col("id") < n - 100, 0).otherwise(1).alias("target"),
    )
    odd = [(None, 1.0, 0), (float("nan"), 1.0, 0), (1.0, 1.0, None), (1.0, 1.0, 9)]
    return materialise(made.unionByName(spark.createDataFrame(odd, "x double, y double, target int")), "clusters")


@pytest.mark.parametrize("prior", [None, "dirichlet", "process"])
def test_bounds_never_fall_and_spare_components_are_emptied(spark, prior):
    trace = []
    fitted = mixture.fit_mixtures(
        clusters(spark), ["x", "y"], "target", [0, 1, 2], components=6, iterations=15, restarts=4, prior=prior, trace=trace
    )
    assert {c.label for c in fitted} == {0, 1} and len(fitted) == 12
    for label in (0, 1):
        bounds = np.array([step[label] for step in trace])
        assert bounds.shape == (15, 4)
        assert (np.diff(bounds, axis=0) > -1e-6 * np.abs(bounds[1:])).all()
    own = [c for c in fitted if c.label == 0]
    assert sum(c.weight for c in own) == pytest.approx(1)
    by_cluster = [sum(c.weight for c in own if round(c.mean[0] / 100) == i and c.weight > 1e-3) for i in range(3)]
    assert by_cluster == pytest.approx([1 / 3] * 3, abs=0.01)
    if prior == "dirichlet":
        assert sum(c.weight > 1e-3 for c in own) == 3


def test_one_step_against_a_plain_one(spark):
    """Sums and likelihood of one pass, computed row by row with the density's formula."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2)) @ np.array([[2.0, 0.3], [0.0, 1.0]])
    fit = mixture.Likelihood(np.array([[0.0, 0.0], [1.0, -1.0], [3.0, 2.0]]))
    fit.weights, fit.covariances = np.array([0.5, 0.3, 0.2]), np.array([[[1.0, 0.2], [0.2, 2.0]], np.eye(2), np.eye(2) * 3])
    old = (fit.weights, fit.means, fit.covariances)
    df = spark.createDataFrame([(0, r.tolist()) for r in x], "class int, x array<double>").repartition(3)
    bound = mixture.advance(df, 2, {0: [fit]})[0][0]
    dens = np.array(
        [
            [w * np.exp(-0.5 * (r - m) @ np.linalg.inv(v) @ (r - m)) / (2 * np.pi * np.sqrt(np.linalg.det(v))) for w, m, v in zip(*old)]
            for r in x
        ]
    )
    shares = dens / dens.sum(axis=1, keepdims=True)
    assert bound == pytest.approx(np.log(dens.sum(axis=1)).sum())
    n = shares.sum(axis=0)
    assert fit.weights == pytest.approx(n / 60)
    assert fit.means == pytest.approx(shares.T @ x / n[:, None])
    for k in range(3):
        off = x - fit.means[k]
        assert fit.covariances[k] == pytest.approx((shares[:, k, None] * off).T @ off / n[k])


def test_mixtures_of_few_and_equal_rows(spark):
    df = spark.createDataFrame([(0, 5.0, 1.0)] * 40 + [(1, 1.0, 2.0), (1, 3.0, 2.0)], "target int, x double, y double")
    for prior in (None, "dirichlet"):
        fitted = mixture.fit_mixtures(df, ["x", "y"], "target", [0, 1], components=3, iterations=4, restarts=2, prior=prior)
        m = {(r.target, r.feature): r.value for r in mixture.moments(spark, fitted, ["x", "y"]).where("other IS NULL").collect()}
        assert m[(0, "x")] == pytest.approx(5) and m[(1, "y")] == pytest.approx(2)
    assert mixture.fit_mixtures(df.limit(0), ["x", "y"], "target", [0, 1]) == []
    with pytest.raises(ValueError):
        mixture.fit_mixtures(df, ["x"], "target", [0], prior="other")


def test_digamma():
    assert mixture.digamma(np.array([1.0, 0.5, 10.0, 1e-3])) == pytest.approx([-0.5772156649, -1.9635100260, 2.2517525890, -1000.5755719])


def test_rows_are_drawn_from_the_stated_components(spark):
    """Shares, means and covariances of what hashed uniforms draw, beside those stated."""
    stated = [
        mixture.Component(0, 0.2, (-1000.0, 5.0), ((2.0, 0.0), (1.0, 3.0))),
        mixture.Component(0, 0.5, (0.0, -5.0), ((1.0, 0.0), (-2.0, 0.5))),
        mixture.Component(0, 0.3, (1000.0, 0.0), ((4.0, 0.0), (0.0, 1.0))),
        mixture.Component(1, 1.0, (7.0, 7.0), ((1.0, 0.0), (0.5, 1.0))),
    ]
    wanted = mixture.request_classes(spark, [0, 1], 20_000)
    sample = mixture.sample_mixtures(wanted, stated, "target", ["x", "y"], ["sequence"], 3).toPandas()
    assert sample.groupby("target").size().tolist() == [20_000, 20_000]
    for c in stated:
        own = sample[sample.target == c.label]
        part = own[abs(own.x - c.mean[0]) < 500][["x", "y"]].to_numpy()
        factor = np.array(c.factor)
        sd = np.sqrt((factor**2).sum(axis=1))
        assert len(part) / 20_000 == pytest.approx(c.weight, abs=0.015)
        assert (abs(part.mean(axis=0) - c.mean) < 5 * sd / len(part) ** 0.5).all()
        assert (abs(np.cov(part.T) - factor @ factor.T) < 0.1 * np.outer(sd, sd)).all()


def test_drawn_classes(spark):
    drawn = mixture.request_classes(spark, [0, 1, 2], 3000, balanced=False)
    assert drawn.count() == 3000 and all(abs(r["count"] - 1000) < 120 for r in drawn.groupBy("target").count().collect())


def test_all_jobs_end_to_end(spark, tmp_path):
    """Generate, scale, train, validate, promote, score and monitor through stored tables."""
    seed = str(tmp_path / "seed")
    spark.range(450).select(
        *[
            (F.randn(i) * 0.3 + (F.col("id") % 3) * (2.0 + i)).alias(name)
            for i, name in enumerate(jobs.MEASURES)
        ],
        (F.col("id") % 3).cast("int").alias("target"),
    ).write.parquet(seed)
    root = str(tmp_path / "lake")
    base = {"root": root, "environment": "staging"}
    model = {
        "model_name": "forest",
        "hyperparameters_grid": {"max_depth": [3], "n_estimators": [5], "criterion": ["gini", "entropy"]},
        "minimal_threshold": 0.8,
    }
    tables = {"raw_data_table": "raw", "label_table": "labels"}
    generate = {**base, "source": seed, "output": tables, "components": 2, "iterations": 3, "restarts": 1, "rows_per_class": 60}
    jobs.generate_batch(spark, generate)
    store = jobs._store(spark, base)
    # the first batch is made a day old, so that training keeps it
    for name in ("default.raw", "default.labels"):
        table = store.table(name)
        table.overwrite(table.read().withColumn("date", F.date_sub("date", 1)))
    jobs.generate_batch(spark, generate)
    raw, labels = store.table("default.raw").read(), store.table("default.labels").read()
    assert raw.count() == labels.count() == 360 and raw.select("Id").distinct().count() == 360
    assert raw.join(labels, ["Id", "date", "hour"]).count() == 360

    features = {**base, "input": {"raw_data_table": "raw"}, "output": {"fs_schema": "fs", "fs_table": "scaled"}}
    assert jobs.generate_features(spark, features) == 1
    # a batch more: its moments are added to those kept, and are those of the whole table
    jobs.generate_batch(spark, generate)
    assert jobs.generate_features(spark, features) == 2
    states = store.table("fs.scaled_states").read()
    assert sorted(r.n for r in states.select("raw_version", "n").distinct().collect()) == [180, 360]
    kept, whole = store.table("fs.scaled_moments").read().first(), scaling.fit_moments(store.table("default.raw").read(), jobs.MEASURES).first()
    assert list(kept.asDict().values()) == pytest.approx(list(whole.asDict().values()))
    store.table("default.raw").overwrite(raw)
    store.table("default.labels").overwrite(labels)
    assert jobs.generate_features(spark, features) == 3
    store.table("fs.scaled").overwrite(store.table("fs.scaled").read().join(raw.select("Id"), "Id", "left_semi"), ["date"], ["Id", "hour"])
    assert store.table("fs.scaled").read().count() == 360

    train = {
        **base,
        "folds": 2,
        "model": model,
        "data": {
            "input": {**tables, "fs_schema": "fs", "fs_table": "scaled"},
            "output": {"train_dataset": "train", "test_dataset": "test"},
        },
    }
    trained = jobs.train(spark, train)
    assert trained["version"] == "1" and len(trained["grid"]) == 2 and trained["oob_score"] > 0.8
    assert (store.table("default.train").read().count(), store.table("default.test").read().count()) == (int(180 * 0.7), 180 - int(180 * 0.7))

    with pytest.raises(LookupError):
        jobs.transition_to_production(spark, {**base, "model": model})
    checked = jobs.validate(
        spark, {**base, "model": model, "data": {"input": {"test_dataset": "test"}, "output": {"test_dataset": "test"}}}
    )
    assert checked["validation"] == "passed" and sum(checked["confusion"].values()) == pytest.approx(1)
    stored = store.table(jobs.CONFUSION).read().where(F.col("run_id") == trained["run_id"]).collect()
    assert {(r.actual, r.predicted): r.share for r in stored} == checked["confusion"]
    tags = jobs.read_tags(store, trained["run_id"])
    assert tags["test_dataset_version"] == "2" and tags["train_dataset_version"] == "1"
    assert "prediction" in store.table("default.test").read().columns
    assert "prediction" not in store.table("default.test").read(1).columns
    assert jobs.transition_to_production(spark, {**base, "model": model}) == "1"
    assert rows(store.table(jobs.MODEL_VERSIONS).read(), "version", "stage") == [("1", "Production")]

    score = {**base, "model": model, "data": {"input": {"inference_dataset": "raw"}, "output": {"scored_inference_dataset": "scored"}}}
    jobs.infer(spark, score)
    assert store.table("default.scored").read().filter("prediction IS NOT NULL").count() == 360
    watch = {
        **base,
        "model": model,
        "data": {
            "input": {
                "train_dataset": "train",
                "test_dataset": "test",
                "scored_inference_dataset": "scored",
                "label_table": "labels",
            },
            "output": {"data_monitoring": "drift", "performance_monitoring": "performance"},
        },
    }
    written = jobs.monitor(spark, watch)
    assert written == {"data_monitoring": 1, "performance_monitoring": 1}
    report = store.table("default.drift").read().collect()
    assert len(report) == 1 and [f.feature for f in report[0].features] == sorted(jobs.FEATURES)
    assert store.table("default.performance").read().count() == 6
    assert all(sum(f.in_current) == 360 and len(f.in_reference) == 10 for f in report[0].features)
    assert not glob.glob(f"{shared_dir(spark).removeprefix('file://')}/grainmill-{spark.sparkContext.applicationId}/job-*")


def test_regression_job(spark, tmp_path):
    source = str(tmp_path / "houses")
    spark.range(800).selectExpr(
        "id % 40 / 4.0 AS rooms", "id % 7 * 1.0 AS age", "id % 40 / 2.0 + id % 7 AS MedHouseVal"
    ).write.parquet(source)
    conf = {"root": str(tmp_path / "lake"), "source": source, "output": {"table": "houses"}, "input": {"table": "houses"}, "trees": 10}
    jobs.load_table(spark, conf)
    result = jobs.train_regression(spark, conf)
    assert result["r2"] > 0.8
    assert float(jobs.read_tags(jobs._store(spark, conf), result["run_id"])["r2"]) == result["r2"]


def test_a_pass_sends_plain_columns_and_sums_all_rows(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(3_000, 2))
    rows = spark.createDataFrame([(0, p.tolist()) for p in points], "class int, x array<double>").repartition(3)
    theta = rng.normal(size=(40, 5, 6)) * 0.1
    step = mixture._step(rows, 2, {0: theta})
    assert "x1" in step._jdf.queryExecution().analyzed().toString()
    q = np.column_stack([np.ones(3_000), points, points[:, [0, 0, 1]] * points[:, [0, 1, 1]]])
    logs = np.einsum("nt,fkt->nfk", q, theta)
    whole = np.logaddexp.reduce(logs, axis=2)
    sums = np.einsum("nfk,nt->fkt", np.exp(logs - whole[..., None]), q)
    got = {(r["fit"], r["component"]): r for r in step.collect()}
    assert len(got) == 200
    for (fit, part), r in got.items():
        assert [r[f"s{t}"] for t in range(6)] == pytest.approx(sums[fit, part], rel=1e-9, abs=1e-9)
    assert sum(got[0, k]["likelihood"] for k in range(5)) == pytest.approx(whole[:, 0].sum())


def test_partitions_of_forest_rows_are_bounded_by_bytes(spark):
    rows = materialise(spark.range(100_000), "spread-test")
    size = session.estimated_bytes(rows)
    assert session.spread(rows, size // 40).rdd.getNumPartitions() >= 40
    assert session.spread(rows, 10 * size).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
