"""The batch jobs from data generation to monitoring.

Each takes a session and a configuration dictionary and hands over to the next through
versioned tables, found by ``database.table`` name under ``conf["root"]`` (by default
the warehouse folder).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from grainmill.functions.columns import (
    CLASSES,
    KEYS,
    LOOKUP_KEYS,
    MEASURES,
    SCALED,
    TARGET,
    feature_columns,
    stamp,
    with_identity,
)
from grainmill.operators import bagging, drift, joins, metrics, mixture, modeling, recency, registry, sampling, scaling
from grainmill.session import job_scratch, materialise
from grainmill.sources.scans import scan_parquet
from grainmill.sources.versioned import TableStore, VersionedTable

FEATURES = list(SCALED.values())
MODEL_VERSIONS = "registry.model_versions"
RUN_TAGS = "registry.run_tags"
CONFUSION = "registry.confusion"
VERSION_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "version", "stage", "run_id")]
)
TAG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run_id", "key", "value")]
    + [T.StructField("logged_at", T.TimestampType())]
)
CONFUSION_SCHEMA = "run_id string, test_dataset string, test_dataset_version bigint, actual int, predicted int, share double"

# Names of the tags that a training and a validation run leave.
TRAIN_TAGS = (
    "train_dataset_version",
    "test_dataset_version",
    "fs_table_version",
    "train_dataset",
    "test_dataset",
    "raw_data",
    "raw_labels",
    "environment run",
)
VALIDATION_TAGS = ("accuracy_TEST", "validation", "test_dataset_version", "test_dataset")


# The operator's names of a grid point's parameters.
OOB_NAMES = {"maxDepth": "depth", "numTrees": "trees", "impurity": "impurity", "featureSubsetStrategy": "subset"}


def _job(run: Callable) -> Callable:
    """A job whose scratch tables go when it ends: it leaves stored tables only."""

    @wraps(run)
    def in_scratch(spark: SparkSession, conf: Mapping):
        with job_scratch(spark):
            return run(spark, conf)

    return in_scratch


def _store(spark: SparkSession, conf: Mapping) -> TableStore:
    return TableStore(spark, conf.get("root"))


def _name(part: Mapping, key: str, database: str = "database") -> str:
    return f"{part.get(database, 'default')}.{part[key]}"


# -- registry tables -----------------------------------------------------------


def log_tags(store: TableStore, run_id: str, tags: Mapping[str, object]) -> None:
    """Append tags of a run; the last value of a key counts."""
    now = datetime.now(timezone.utc)
    rows = [(run_id, k, None if v is None else str(v), now) for k, v in tags.items()]
    store.table(RUN_TAGS).append(store.spark.createDataFrame(rows, TAG_SCHEMA))


def read_tags(store: TableStore, run_id: str) -> dict[str, str]:
    """The current tags of one run."""
    tags = store.table(RUN_TAGS).read().filter(F.col("run_id") == run_id)
    return {row["key"]: row["value"] for row in registry.latest_tags(tags).collect()}


def register(store: TableStore, model: str, run_id: str) -> str:
    """Add the next, unstaged version of a model."""
    table = store.table(MODEL_VERSIONS)
    newest = _newest(store, model) if table.exists() else None
    version = str(int(newest["version"]) + 1 if newest else 1)
    row = [(model, version, registry.UNSTAGED, run_id)]
    table.append(store.spark.createDataFrame(row, VERSION_SCHEMA))
    return version


def _newest(store: TableStore, model: str, stage: str | None = None):
    versions = store.table(MODEL_VERSIONS).read().filter(F.col("name") == model)
    return registry.newest_models(versions, stage).first()


def _require(row, what: str):
    if row is None:
        raise LookupError(f"no {what}")
    return row


# -- data ----------------------------------------------------------------------


@_job
def generate_batch(spark: SparkSession, conf: Mapping) -> dict[str, int]:
    """Append one generated batch of observations and its labels.

    ``conf["source"]`` is the parquet data set the class mixtures are fitted on. Ids
    are hashes of batch number and position, so a batch that is run again is the same.
    """
    store, out = _store(spark, conf), conf["output"]
    raw_table = store.table(_name(out, "raw_data_table"))
    batch = int(conf.get("batch", (raw_table.latest() or 0) + 1))
    seed_rows = scan_parquet(spark, conf["source"], [*MEASURES, TARGET])
    fitted = mixture.fit_mixtures(
        seed_rows,
        MEASURES,
        TARGET,
        conf.get("classes", CLASSES),
        components=conf.get("components", 10),
        iterations=conf.get("iterations", 20),
        restarts=conf.get("restarts", 10),
    )
    wanted = mixture.request_classes(
        spark, conf.get("classes", CLASSES), conf.get("rows_per_class", 50), conf.get("balanced", True), batch
    ).withColumn("batch", F.lit(batch))
    rows = mixture.sample_mixtures(wanted, fitted, TARGET, MEASURES, ["batch", "sequence"], batch)
    keyed = with_identity(stamp(rows), ["batch", "sequence"])
    # Written once, so both tables get the same rows, date and hour.
    rows = materialise(keyed, "batch")
    raw_table.append(rows.select(*MEASURES, "date", "hour", "Id"))
    labels = store.table(_name(out, "label_table"))
    labels.append(rows.select("Id", "date", "hour", TARGET))
    return {"raw_version": raw_table.latest(), "label_version": labels.latest()}


@_job
def load_table(spark: SparkSession, conf: Mapping) -> int:
    """Store a parquet data set as a table, replacing what was there."""
    store = _store(spark, conf)
    return store.table(_name(conf["output"], "table")).overwrite(scan_parquet(spark, conf["source"]))


@_job
def generate_features(spark: SparkSession, conf: Mapping) -> int:
    """Standardise all observations and create or merge the keyed feature table.

    The moments are stored next to it. ``conf["fit_before"]`` limits the rows they are
    fitted on; by default all rows count, and only batches that are new since the last run are read for them.
    """
    store, out = _store(spark, conf), conf["output"]
    table = store.table(_name(conf["input"], "raw_data_table"))
    raw, name = table.read(), _name(out, "fs_table", "fs_schema")
    if conf.get("fit_before"):
        fitted = scaling.fit_moments(raw.filter(F.col("date") < F.lit(conf["fit_before"]).cast("date")), MEASURES)
    else:
        fitted = scaling.moments_of_states(_moment_states(table, store.table(f"{name}_states")), MEASURES)
    moments = store.table(f"{name}_moments")
    moments.overwrite(fitted)
    features = scaling.apply_moments(raw, moments.read(), SCALED, KEYS)
    table = store.table(name)
    return table.create(features, LOOKUP_KEYS, ["date"]) or table.upsert(features)


def _moment_states(raw: VersionedTable, states: VersionedTable) -> DataFrame:
    """Moments of each batch of ``raw``; those not yet in ``states`` are added to it."""
    version, batch = raw.latest(), None
    if states.exists():
        batch = raw.added_since(states.read().agg(F.max("raw_version")).first()[0])
    rows = raw.read() if batch is None else batch
    found = scaling.moment_states(rows, MEASURES).withColumn("raw_version", F.lit(version).cast("bigint"))
    if batch is None:
        states.overwrite(found)
    else:
        states.append(found)
    return states.read()


# -- training and validation ---------------------------------------------------


def build_training_set(raw: DataFrame, labels: DataFrame, features: DataFrame, keep_keys: bool = False) -> DataFrame:
    """Labelled history with looked-up features; raw columns and keys are left out."""
    history = recency.labelled_history(raw, labels, KEYS)
    exclude = MEASURES if keep_keys else [*MEASURES, *KEYS]
    return joins.lookup_features(history, features, FEATURES, LOOKUP_KEYS, exclude, hot_from=raw)


@_job
def train(spark: SparkSession, conf: Mapping) -> dict:
    """Build and store train and test sets, search the grid, register the winner."""
    store = _store(spark, conf)
    source, out, model_conf = conf["data"]["input"], conf["data"]["output"], conf["model"]
    raw_name, label_name = _name(source, "raw_data_table"), _name(source, "label_table")
    feature_name = _name(source, "fs_table", "fs_schema")
    features = store.table(feature_name)
    whole = build_training_set(
        store.table(raw_name).read(), store.table(label_name).read(), features.read(), keep_keys=True
    )
    share, seed = conf.get("train_share", 0.7), conf.get("split_seed", 123)
    # The joins run once; both sets are then cut from the stored rows.
    stored = materialise(whole, "training")
    divide = sampling.exact_split if conf.get("exact_split", True) else sampling.train_test_split
    parts = divide(stored, ["Id"], share, seed)
    written = {}
    for part in ("train", "test"):
        rows = parts.filter(F.col("split") == part).select(*FEATURES, TARGET)
        name = _name(out, f"{part}_dataset")
        written[part] = (name, store.table(name).overwrite(rows))
    train_rows = store.table(written["train"][0]).read(written["train"][1])
    search = modeling.grid_search(
        train_rows,
        FEATURES,
        TARGET,
        modeling.grid_from_conf(model_conf["hyperparameters_grid"]),
        folds=conf.get("folds", 5),
    )
    run_id = uuid.uuid4().hex
    modeling.save_model(
        modeling.scoring_model(FEATURES, search.bestModel), store.path("models", run_id)
    )
    report = modeling.grid_report(search)
    best = max(report, key=lambda point: point["accuracy"])
    # The winner's parameters once more, with trees whose left-out rows are known.
    keyed = parts.filter(F.col("split") == "train").select(*KEYS, *FEATURES, TARGET)
    point = {OOB_NAMES[k]: v for k, v in best.items() if k in OOB_NAMES}
    bagged = bagging.fit_bagged(keyed, FEATURES, TARGET, KEYS, **point)
    oob = bagging.oob_score(bagged.out_of_bag(keyed), TARGET).first()["oob_score"]
    values = (
        written["train"][1],
        written["test"][1],
        features.latest(),
        written["train"][0],
        written["test"][0],
        raw_name,
        label_name,
        conf["environment"],
    )
    tags = {
        **dict(zip(TRAIN_TAGS, values, strict=True)),
        "fs_table": feature_name,
        "accuracy_CV": best["accuracy"],
        "accuracy_OOB": oob,
        **{f"best_{k}": v for k, v in best.items() if k != "accuracy"},
    }
    log_tags(store, run_id, tags)
    version = register(store, model_conf["model_name"], run_id)
    return {"run_id": run_id, "version": version, "grid": report, "oob_score": oob}


@_job
def validate(spark: SparkSession, conf: Mapping) -> dict:
    """Score the test set with the newest unstaged model, store it and pass or fail the gate."""
    store, model_conf = _store(spark, conf), conf["model"]
    name = model_conf["model_name"]
    chosen = _require(_newest(store, name, registry.UNSTAGED), f"unstaged version of {name}")
    model = modeling.load_model(store.path("models", chosen["run_id"]))
    test = store.table(_name(conf["data"]["input"], "test_dataset")).read()
    scored = modeling.score(model, test.drop("prediction"), FEATURES).drop("probability")
    out = _name(conf["data"]["output"], "test_dataset")
    version = store.table(out).overwrite(scored)
    scored = store.table(out).read(version)
    measured = metrics.accuracy(scored)
    threshold = model_conf.get("minimal_threshold", registry.MINIMAL_THRESHOLD)
    verdict = registry.gate(measured, threshold).first()
    shares = metrics.confusion_shares(scored, conf.get("classes", CLASSES)).collect()
    log_tags(
        store,
        chosen["run_id"],
        dict(zip(VALIDATION_TAGS, (verdict["accuracy"], verdict["validation"], version, out), strict=True)),
    )
    matrix = [(chosen["run_id"], out, version, int(r["actual"]), int(r["predicted"]), r["share"]) for r in shares]
    store.table(CONFUSION).append(spark.createDataFrame(matrix, CONFUSION_SCHEMA))
    if verdict["validation"] == registry.PASSED and conf["environment"] == "staging":
        _move(store, chosen, registry.STAGING)
    return {
        "accuracy": verdict["accuracy"],
        "validation": verdict["validation"],
        "version": chosen["version"],
        "confusion": {(row["actual"], row["predicted"]): row["share"] for row in shares},
    }


def _move(store: TableStore, chosen, stage: str) -> None:
    table = store.table(MODEL_VERSIONS)
    versions = table.read()
    this = versions.filter((F.col("name") == chosen["name"]) & (F.col("version") == chosen["version"]))
    table.overwrite(registry.promote(versions, this, stage))


@_job
def transition_to_production(spark: SparkSession, conf: Mapping) -> str:
    """Move the newest Staging version of the model to Production."""
    store, name = _store(spark, conf), conf["model"]["model_name"]
    chosen = _require(_newest(store, name, registry.STAGING), f"staged version of {name}")
    _move(store, chosen, registry.PRODUCTION)
    return chosen["version"]


# -- scoring and monitoring ----------------------------------------------------


@_job
def infer(spark: SparkSession, conf: Mapping) -> int:
    """Score all observations with the newest model version, whatever its stage.

    ``conf["since"]`` limits scoring to observations from that date on.
    """
    store = _store(spark, conf)
    source, name = conf["data"]["input"], conf["model"]["model_name"]
    raw = store.table(_name(source, "inference_dataset")).read()
    if conf.get("since"):
        raw = raw.filter(F.col("date") >= F.lit(conf["since"]).cast("date"))
    chosen = _require(_newest(store, name), f"version of {name}")
    # The lookup of the training run is repeated: same table, same keys.
    features = store.table(read_tags(store, chosen["run_id"])["fs_table"]).read()
    rows = joins.lookup_features(raw, features, FEATURES, LOOKUP_KEYS)
    model = modeling.load_model(store.path("models", chosen["run_id"]))
    scored = modeling.score(model, rows, FEATURES).drop("probability")
    return store.table(_name(conf["data"]["output"], "scored_inference_dataset")).overwrite(scored)


@_job
def monitor(spark: SparkSession, conf: Mapping) -> dict[str, int]:
    """Store drift of scored features against the training set the newest model was fitted on.

    Performance drift is stored as well when the run's test set has predictions.
    """
    store = _store(spark, conf)
    source, out = conf["data"]["input"], conf["data"]["output"]
    name = conf["model"]["model_name"]
    chosen = _require(_newest(store, name), f"version of {name}")
    tags = read_tags(store, chosen["run_id"])
    train_rows = store.table(_name(source, "train_dataset")).read(int(tags["train_dataset_version"]))
    test_rows = store.table(_name(source, "test_dataset")).read(int(tags["test_dataset_version"]))
    scored = store.table(_name(source, "scored_inference_dataset")).read()
    features = feature_columns(train_rows, [TARGET, "prediction"])
    report = drift.drift_document(
        drift.feature_drift(train_rows, scored, features), distributions=drift.histograms(train_rows, scored, features)
    )
    written = {"data_monitoring": store.table(_name(out, "data_monitoring")).overwrite(report)}
    if "performance_monitoring" in out and "prediction" in test_rows.columns:
        labels = store.table(_name(source, "label_table")).read()
        labelled = joins.join_late_labels(scored, labels)
        measured = drift.performance_drift(test_rows, labelled, conf.get("classes", CLASSES))
        written["performance_monitoring"] = store.table(_name(out, "performance_monitoring")).overwrite(measured)
    return written


# -- regression ----------------------------------------------------------------


@_job
def train_regression(spark: SparkSession, conf: Mapping) -> dict:
    """Scale on train rows, fit a regression forest, report R-squared on test rows."""
    store = _store(spark, conf)
    rows = store.table(_name(conf["input"], "table")).read()
    label = conf.get("target", "MedHouseVal")
    names = {c: f"{c}_scaled" for c in feature_columns(rows, [label])}
    split = sampling.train_test_split(
        rows, rows.columns, conf.get("train_share", 0.75), conf.get("split_seed", 0)
    )
    train_rows = split.filter("split = 'train'")
    test_rows = split.filter("split = 'test'")
    moments = materialise(scaling.fit_moments(train_rows, list(names)), "moments")
    model = modeling.fit_regression(
        scaling.apply_moments(train_rows, moments, names, [label]),
        list(names.values()),
        label,
        trees=conf.get("trees", 100),
        depth=conf.get("depth", 10),
    )
    scored = modeling.score(
        model, scaling.apply_moments(test_rows, moments, names, [label]), list(names.values()), "double"
    )
    r2 = metrics.r_squared(scored, label, "prediction").first()["r2"]
    run_id = uuid.uuid4().hex
    modeling.save_model(model, store.path("models", run_id))
    log_tags(store, run_id, {"experiment": conf.get("experiment"), "r2": r2})
    return {"run_id": run_id, "r2": r2}
