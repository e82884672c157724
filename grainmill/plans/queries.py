"""The registered queries: each takes (spark, folder of parquet tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from grainmill.functions.columns import feature_columns, rename, stamp, with_identity, without
from grainmill.operators import (
    bagging,
    centroid,
    drift,
    joins,
    metrics,
    mixture,
    modeling,
    recency,
    registry,
    sampling,
    scaling,
)
from grainmill.functions.hashing import seeded_uniform
from grainmill.plans import inputs
from grainmill.plans.inputs import (
    DOC_FEATURES,
    LINE_CLASSES,
    LINE_FEATURES,
    LINE_KEYS,
    OBS_KEYS,
    OBS_LOOKUP,
    OBS_NAMES,
)
from grainmill.session import materialise, scratch_path, spread
from grainmill.sources import documents, scans, versioned

MID = "2024-01-16"
Z = list(OBS_NAMES.values())
DRIFT_FEATURES = ["m_value", "m_k", "m_user", "m_minute", "m_sequence"]
OOB_TREES = 10
ALIAS_WEIGHTS = [float(i * i % 97) for i in range(10_000)]
STATED = [
    mixture.Component(0, 0.25, (-10.0, 5.0), ((2.0, 0.0), (1.0, 3.0))),
    mixture.Component(0, 0.75, (0.0, -5.0), ((1.0, 0.0), (-2.0, 0.5))),
    mixture.Component(1, 0.5, (7.0, 7.0), ((1.0, 0.0), (0.5, 1.0))),
    mixture.Component(1, 0.125, (30.0, 0.0), ((4.0, 0.0), (0.0, 1.0))),
    mixture.Component(1, 0.375, (-3.0, 1.0), ((0.5, 0.0), (0.25, 0.125))),
    mixture.Component(2, 1.0, (100.0, 200.0), ((8.0, 0.0), (2.0, 1.0))),
]
DRIFT_LEAF = 2_000  # small, so that the refinement runs at test scale too


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, and -0.0 made 0.0, so that engines can be compared."""
    return df.select(
        *[
            (F.round(c.name, places) + F.lit(0.0)).alias(c.name)
            if isinstance(c.dataType, T.DoubleType)
            else F.col(c.name)
            for c in df.schema
        ]
    )


def _scratch_table(spark: SparkSession, label: str) -> versioned.VersionedTable:
    return versioned.VersionedTable(spark, scratch_path(spark, label))


# -- scans and projections -----------------------------------------------------


def scan_observations(spark, sf):
    raw = inputs.table(spark, sf, "events")
    named = rename(raw, {"event_id": "Id", "value": "m_value", "user_id": "m_user"})
    stamped = stamp(named, F.col("ts"))
    return without(stamped, ["ts", "props", "event_type"]).select("m_value", "m_user", *OBS_KEYS)


def row_identity(spark, sf):
    keyed = with_identity(inputs.lines(spark, sf), LINE_KEYS)
    return keyed.select("Id", *LINE_FEATURES)


def preview_top_n(spark, sf):
    return scans.preview(inputs.lines(spark, sf), LINE_KEYS, 20)


def flag_newest(spark, sf):
    return recency.flag_newest(inputs.observations(spark, sf).select("Id", "date"))


# -- joins and the training set ------------------------------------------------


def join_labels(spark, sf):
    joined = joins.join_labels(inputs.observations(spark, sf), inputs.event_labels(spark, sf), OBS_KEYS)
    return rounded(joined)


def join_labels_salted(spark, sf):
    """A join on keys that each hold many rows, through the salted path."""
    facts = inputs.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), "l_quantity", "l_tax", "l_returnflag"
    )
    suppliers = inputs.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return joins.join_labels(facts, suppliers, ["s_suppkey"], salted=True)


def join_labels_typed(spark, sf):
    """The salted path with keys of different integer types."""
    facts = inputs.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("s_suppkey"), "l_quantity", "l_tax", "l_returnflag"
    )
    suppliers = inputs.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return joins.join_labels(facts, suppliers, ["s_suppkey"], salted=True)


def join_hot_both(spark, sf):
    """A key that holds a third of the rows of both sides, joined as a grid and summed.

    The sum reads three digits of an order's key and a nation of a customer; rows equal in these are joined once.
    """
    hot = lambda c: F.when(F.pmod(c, F.lit(3)) == 0, 0).otherwise(F.pmod(c, F.lit(200))).cast("int").alias("bucket")
    scored = inputs.table(spark, sf, "orders").select(
        hot(F.col("o_custkey")), F.pmod("o_orderkey", F.lit(1000)).alias("digits")
    )
    labels = inputs.table(spark, sf, "customer").select(hot(F.col("c_custkey")), F.col("c_nationkey").alias("target"))
    joined = joins.join_late_labels(scored, labels, ["bucket"], counted="n", salted=True)
    total = F.sum(F.col("n") * F.col("digits") * F.col("target"))
    return joined.groupBy("bucket").agg(F.sum("n").alias("n_rows"), total.cast("bigint").alias("total"))


def newest_date(spark, sf):
    return recency.newest_date(inputs.observations(spark, sf))


def drop_newest_day(spark, sf):
    return rounded(
        recency.labelled_history(inputs.observations(spark, sf), inputs.event_labels(spark, sf), OBS_KEYS)
    )


def drop_newest(spark, sf):
    return rounded(recency.drop_newest(inputs.observations(spark, sf)))


def feature_table(spark, sf) -> DataFrame:
    return scaling.standardise(inputs.observations(spark, sf), OBS_NAMES, OBS_KEYS)


def standardise(spark, sf):
    return rounded(feature_table(spark, sf))


def feature_moments(spark, sf):
    names = list(OBS_NAMES)
    moments = scaling.fit_moments(inputs.observations(spark, sf), names)
    return rounded(scaling.tidy_moments(moments, names))


def feature_moments_merged(spark, sf):
    """The same moments from states kept for three batches, each read once when it was appended."""
    names = list(OBS_NAMES)
    raw, states = _scratch_table(spark, "raw"), _scratch_table(spark, "states")
    for part in range(3):
        raw.append(inputs.observations(spark, sf).where(F.pmod("Id", F.lit(3)) == part))
        batch = raw.read() if part == 0 else raw.added_since(raw.latest() - 1)
        states.append(scaling.moment_states(batch, names))
    return rounded(scaling.tidy_moments(scaling.moments_of_states(states.read(), names), names))


def feature_lookup(spark, sf):
    return rounded(
        joins.lookup_features(
            inputs.observations(spark, sf), feature_table(spark, sf), Z, OBS_LOOKUP, exclude=list(OBS_NAMES)
        )
    )


def lookup_coverage(spark, sf):
    """Documents looked up in a table that covers only part of them."""
    found = joins.lookup_features(
        inputs.scored_documents(spark, sf),
        inputs.table(spark, sf, "labels"),
        ["quality", "toxic"],
        ["doc_id"],
        salted=True,
    )
    return joins.count_missing(found, ["quality", "toxic"])


def train_test_split(spark, sf):
    return sampling.train_test_split(inputs.observations(spark, sf).select("Id", "hour"), ["Id"], 0.7, 123)


def training_rows(spark, sf) -> DataFrame:
    """Labelled history with looked-up features and a split, raw columns and keys kept out."""
    raw = inputs.observations(spark, sf).select(*OBS_KEYS)
    history = recency.labelled_history(raw, inputs.event_labels(spark, sf), OBS_KEYS)
    # Hot keys are looked for in the raw table, not in the joined one.
    found = joins.lookup_features(history, feature_table(spark, sf), Z, OBS_LOOKUP, hot_from=raw)
    return sampling.train_test_split(found, ["Id"], 0.7, 123)


def training_set(spark, sf):
    return rounded(training_rows(spark, sf).drop("date", "hour"))


def training_counts(spark, sf):
    """The flagship: rows, classes and mean feature per split of the training set."""
    known = F.count(F.col("z_value"))
    return rounded(
        training_rows(spark, sf)
        .groupBy("split", "target")
        .agg(F.count(F.lit(1)).alias("n_rows"), known.alias("n_found"), F.avg("z_value").alias("mean_z"))
    )


def union_classes(spark, sf):
    df = inputs.table(spark, sf, "lineitem").select("l_returnflag", *LINE_FEATURES)
    named = joins.union_classes(df, "l_returnflag", {"A": 0, "N": 1, "R": 2})
    return named.drop("l_returnflag")


def union_frames(spark, sf):
    orders = inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")
    )
    items = inputs.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("amount"), F.col("l_orderkey").alias("key")
    )
    return joins.union_frames([orders, items])


# -- versioned tables ----------------------------------------------------------


def upsert_features(spark, sf):
    """Features of the first twenty days, then a recomputed overlapping batch merged in."""
    raw = inputs.observations(spark, sf)
    first = scaling.standardise(raw.filter(F.col("date") < F.lit("2024-01-21").cast("date")), OBS_NAMES, OBS_KEYS)
    table = _scratch_table(spark, "features")
    table.create(first, OBS_LOOKUP, ["date"])
    batch = feature_table(spark, sf).filter(F.col("date") >= F.lit("2024-01-11").cast("date"))
    table.upsert(batch)
    return rounded(table.read())


def create_feature_table(spark, sf):
    table = _scratch_table(spark, "features")
    table.create(feature_table(spark, sf), OBS_LOOKUP, ["date"])
    return rounded(table.read())


def append_batch(spark, sf):
    """Two batches appended; the first alone stays readable."""
    raw = inputs.observations(spark, sf).select("Id", "date", "hour", "m_value")
    early = F.col("date") < F.lit(MID).cast("date")
    table = _scratch_table(spark, "raw")
    table.append(raw.filter(early))
    table.append(raw.filter(~early))
    return table.read()


def append_keyed(spark, sf):
    """Three batches of new keys appended to a keyed table, each checked against filters of the keys before."""
    raw = inputs.observations(spark, sf).select("Id", "date", "hour", "m_value")
    table = _scratch_table(spark, "keyed")
    table.create(raw.where(F.pmod("Id", F.lit(3)) == 0), OBS_LOOKUP, ["date"])
    for part in (1, 2):
        table.append(raw.where(F.pmod("Id", F.lit(3)) == part))
    return table.read()


def _three_versions(spark, sf):
    raw = inputs.observations(spark, sf).select("Id", "date", "hour", "m_value")
    early = F.col("date") < F.lit(MID).cast("date")
    table = _scratch_table(spark, "raw")
    table.append(raw.filter(early))
    table.append(raw.filter(~early))
    table.overwrite(table.read().groupBy("date").agg(F.count(F.lit(1)).alias("n_rows")))
    return table


def read_as_of(spark, sf):
    return _three_versions(spark, sf).read(1)


def overwrite_version(spark, sf):
    """The same table, read and replaced under a new schema."""
    return _three_versions(spark, sf).read()


def latest_version(spark, sf):
    log = inputs.table(spark, sf, "orders")
    return versioned.latest_version(log, "o_orderkey", ["o_custkey"])


# -- evaluation ----------------------------------------------------------------


def _scored_lines(spark, sf) -> DataFrame:
    """Test rows of the line items with the prediction of a model fitted on train rows."""
    rows = inputs.lines(spark, sf)
    is_train = sampling.in_share(LINE_KEYS, 0.7, 123)
    model = centroid.fit_centroids(rows.filter(is_train), LINE_FEATURES, "target")
    return model.predict(rows.filter(~is_train))


def predictions(spark, sf):
    return _scored_lines(spark, sf).select(*LINE_KEYS, "target", "prediction")


def accuracy(spark, sf):
    return rounded(metrics.accuracy(_scored_lines(spark, sf)))


def confusion_counts(spark, sf):
    # Class 3 does not occur; its cells are still reported.
    return metrics.confusion_counts(_scored_lines(spark, sf), [*LINE_CLASSES, 3])


def confusion_normalised(spark, sf):
    return rounded(metrics.confusion_shares(_scored_lines(spark, sf), LINE_CLASSES), 6)


def class_counts(spark, sf):
    return metrics.class_counts(inputs.table(spark, sf, "events"), "event_type")


def row_counts(spark, sf):
    names = ["orders", "lineitem", "events", "documents"]
    return joins.union_frames(
        [
            metrics.row_count(inputs.table(spark, sf, n)).select(F.lit(n).alias("name"), "n_rows")
            for n in names
        ]
    )


def r_squared(spark, sf):
    """A line fitted on train rows, measured on test rows."""
    rows = inputs.lines(spark, sf)
    is_train = sampling.in_share(LINE_KEYS, 0.75, 7)
    line = rows.filter(is_train).agg(
        F.struct(
            F.regr_slope("l_extendedprice", "l_quantity").alias("slope"),
            F.regr_intercept("l_extendedprice", "l_quantity").alias("intercept"),
        ).alias("line")
    ).scalar()
    test = rows.filter(~is_train).select(
        F.col("l_extendedprice").alias("target"),
        (line["slope"] * F.col("l_quantity") + line["intercept"]).alias("prediction"),
    )
    return rounded(metrics.r_squared(test), 6)


def score_lookup(spark, sf):
    """Every observation scored from its looked-up features."""
    features = feature_table(spark, sf)
    labelled = joins.join_labels(features, inputs.event_labels(spark, sf), OBS_KEYS)
    model = centroid.fit_centroids(labelled, Z, "target")
    rows = joins.lookup_features(inputs.observations(spark, sf).select(*OBS_KEYS), features, Z, OBS_LOOKUP)
    return model.predict(rows).select(*OBS_KEYS, "prediction")


# -- monitoring ----------------------------------------------------------------


def _drift_sides(spark, sf):
    rows = inputs.observations(spark, sf).withColumn("m_sequence", F.col("Id").cast("double"))
    early = F.col("date") < F.lit(MID).cast("date")
    return rows.filter(early), rows.filter(~early)


def _per_feature(spark, sf):
    reference, current = _drift_sides(spark, sf)
    return drift.feature_drift(reference, current, DRIFT_FEATURES, leaf_rows=DRIFT_LEAF)


def drift_ks(spark, sf):
    return rounded(_per_feature(spark, sf), 6)


def drift_summary(spark, sf):
    reference, current = _drift_sides(spark, sf)
    return rounded(drift.drift_summary(reference, current, DRIFT_FEATURES))


def drift_dataset(spark, sf):
    return rounded(drift.dataset_drift(_per_feature(spark, sf)))


def drift_document(spark, sf):
    """The report written as JSON, parsed back and listed per feature."""
    report = drift.drift_document(_per_feature(spark, sf))
    parsed = documents.from_document(documents.to_document(report), report.schema)
    listed = parsed.select("dataset_drift", F.explode("features").alias("f"))
    return rounded(listed.select("dataset_drift", "f.*"), 6)


def drift_sketch(spark, sf):
    """Drift from a stored sketch of the training side, beside the exact statistic."""
    reference, current = _drift_sides(spark, sf)
    stored = materialise(drift.feature_sketches(reference, DRIFT_FEATURES), "sketches")
    found = drift.sketched_ks(stored, drift.feature_sketches(current, DRIFT_FEATURES))
    exact = drift.ks_statistics(reference, current, DRIFT_FEATURES).select("feature", F.col("statistic").alias("exact"))
    joined = found.join(exact, "feature")
    within = (F.abs(F.col("statistic") - F.col("exact")) <= F.col("error")).alias("within")
    return rounded(joined.select("feature", "n_reference", "n_current", F.col("exact").alias("statistic"), within), 6)


def drift_distributions(spark, sf):
    """The bins of both sides, written into the drift document and listed from it."""
    reference, current = _drift_sides(spark, sf)
    report = drift.drift_document(
        _per_feature(spark, sf), distributions=drift.histograms(reference, current, DRIFT_FEATURES)
    )
    parsed = documents.from_document(documents.to_document(report), report.schema)
    listed = parsed.select(F.explode("features").alias("f")).select("f.*")
    bins = F.posexplode(F.arrays_zip("in_reference", "in_current")).alias("bin", "n")
    return rounded(listed.select("feature", "low", "high", bins).select("feature", "low", "high", "bin", "n.*"))


def join_late_labels(spark, sf):
    scored = inputs.observations(spark, sf).select("Id", "date", "hour", "m_value")
    return joins.join_late_labels(scored, inputs.event_labels(spark, sf), OBS_LOOKUP)


def label_join_performance(spark, sf):
    """Test half against all scored documents whose label has arrived."""
    scored = inputs.scored_documents(spark, sf)
    labelled = joins.join_late_labels(scored, inputs.document_labels(spark, sf), ["doc_id"])
    labelled = materialise(labelled, "labelled")  # so that the texts are read once
    is_train = sampling.in_share(["doc_id"], 0.7, 123)
    model = centroid.fit_centroids(labelled.filter(is_train), DOC_FEATURES, "target")
    current = model.predict(labelled)
    return rounded(drift.performance_drift(current.filter(~is_train), current, [0, 1]), 6)


# -- registry ------------------------------------------------------------------


def newest_model(spark, sf):
    return registry.newest_models(inputs.model_versions(spark, sf))


def newest_in_stage(spark, sf):
    return registry.newest_models(inputs.model_versions(spark, sf), registry.STAGING)


def gate(spark, sf):
    return registry.gate(inputs.measured_models(spark, sf))


def promote_staging(spark, sf):
    return registry.promote_to_staging(
        inputs.model_versions(spark, sf), inputs.measured_models(spark, sf), "staging"
    )


def promote_production(spark, sf):
    return registry.promote_to_production(inputs.model_versions(spark, sf))


def run_tags_latest(spark, sf):
    return registry.latest_tags(inputs.run_tags(spark, sf))


def resolve_versions(spark, sf):
    keys = ["train_dataset_version", "test_dataset_version"]
    return registry.resolve_tags(inputs.model_versions(spark, sf), inputs.run_tags(spark, sf), keys)


# -- sampling and models -------------------------------------------------------


def balanced_sample(spark, sf):
    sample = sampling.balanced_sample(inputs.lines(spark, sf), "target", 500, LINE_KEYS, 11, leaf_rows=5_000)
    return sample.select(*LINE_KEYS, "target")


def exact_split(spark, sf):
    rows = inputs.observations(spark, sf).select("Id", "hour")
    return sampling.exact_split(rows, ["Id"], 0.7, 123, leaf_rows=2_000)


def weighted_draw(spark, sf):
    rows = inputs.observations(spark, sf).select("Id")
    return sampling.draw_class(rows, [0, 1, 2, 3], [1.0, 0.0, 2.5, 0.5], ["Id"], 5)


def alias_draw(spark, sf):
    """One of 10,000 weighted classes for each row, by an alias table."""
    rows = inputs.observations(spark, sf).select("Id")
    return sampling.draw_of_many(rows, ALIAS_WEIGHTS, ["Id"], 7)


def apply_stored_scaler(spark, sf):
    """Moments of the train rows, stored as a table and applied to the test rows."""
    raw = inputs.observations(spark, sf)
    is_train = sampling.in_share(["Id"], 0.75, 0)
    stored = materialise(scaling.fit_moments(raw.filter(is_train), list(OBS_NAMES)), "moments")
    return rounded(scaling.apply_moments(raw.filter(~is_train), stored, OBS_NAMES, ["Id"]))


def _split_lines(spark, sf):
    rows = sampling.train_test_split(inputs.signal_lines(spark, sf), LINE_KEYS, 0.7, 123)
    stored = materialise(spread(rows), "lines")
    return stored.filter("split = 'train'"), stored.filter("split = 'test'")


def rf_grid_search(spark, sf):
    """Eight grid points, five folds, then the winner on the test rows.

    All features at every split and a bin for each quantity let every forest learn the class.
    """
    train, test = _split_lines(spark, sf)
    grid = modeling.DEFAULT_GRID | {"featureSubsetStrategy": ["all"]}
    search = modeling.grid_search(train, LINE_FEATURES, "target", grid, fold_by=LINE_KEYS)
    model = modeling.scoring_model(LINE_FEATURES, search.bestModel)
    return metrics.confusion_counts(modeling.score(model, test, LINE_FEATURES), LINE_CLASSES)


def rf_regression(spark, sf):
    """The class as a number from standardised features, by 100 trees."""
    train, test = _split_lines(spark, sf)
    names = {f: f.replace("l_", "z_") for f in LINE_FEATURES}
    moments = materialise(scaling.fit_moments(train, list(names)), "moments")
    fit_rows = scaling.apply_moments(train, moments, names, ["target"])
    model = modeling.fit_regression(fit_rows, list(names.values()), "target", trees=100, depth=3, subset="all")
    test_rows = scaling.apply_moments(test, moments, names, ["target"])
    scored = modeling.score(model, test_rows, list(names.values()), "double")
    return rounded(metrics.r_squared(scored, "target", "prediction"), 6)


def batch_score(spark, sf):
    """A fitted model stored, loaded again and applied to every row."""
    train, _ = _split_lines(spark, sf)
    model = modeling.fit_forest(train, LINE_FEATURES, "target", trees=30, depth=3, subset="all")
    path = scratch_path(spark, "model")
    modeling.save_model(model, path)
    scored = modeling.score(modeling.load_model(path), inputs.signal_lines(spark, sf), LINE_FEATURES)
    return scored.select(*LINE_KEYS, "target", "prediction")


def oob_votes(spark, sf):
    """For every row the trees of a bagged forest that have not seen it, and what these say."""
    rows = materialise(inputs.signal_lines(spark, sf), "lines")
    forest = bagging.fit_bagged(rows, LINE_FEATURES, "target", LINE_KEYS, trees=OOB_TREES, depth=3, subset="all")
    return forest.out_of_bag(rows).select(*LINE_KEYS, "target", "n_out", "prediction")


def mixture_moments(spark, sf):
    """Mean and covariance of the mixture fitted to each class, over standardised features."""
    rows = inputs.lines(spark, sf)
    names = {f: f.replace("l_", "z_") for f in LINE_FEATURES}
    moments = materialise(scaling.fit_moments(rows, list(names)), "moments")
    scaled = scaling.apply_moments(rows, moments, names, ["target"])
    fitted = mixture.fit_mixtures(scaled, list(names.values()), "target", LINE_CLASSES)
    return rounded(mixture.moments(spark, fitted, list(names.values())), 3)


def mixture_sample(spark, sf):
    """As many generated rows per class as were observed, from fitted mixtures."""
    rows = inputs.lines(spark, sf)
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    fitted = mixture.fit_mixtures(rows, features, "target", LINE_CLASSES)
    return mixture.sample_mixtures(rows.select(*LINE_KEYS, "target"), fitted, "target", features, LINE_KEYS, 3)


def mixture_draw(spark, sf):
    """Observations drawn from stated components by the same digests that SQL has."""
    rows = inputs.lines(spark, sf).select(*LINE_KEYS, "target")
    drawn = mixture.sample_mixtures(rows, STATED, "target", ["x", "y"], LINE_KEYS, 3, seeded_uniform)
    return rounded(drawn)


def mixture_clusters(spark, sf):
    """Rows per cluster as a Bayesian mixture with components to spare counts them."""
    rows = inputs.signal_lines(spark, sf).select(
        (F.col("target") * 1000 + F.col("l_discount") * 100).alias("x"), (F.col("l_tax") * 100).alias("y"), F.lit(0).alias("all")
    )
    n, spare = rows.count(), 8
    fitted = mixture.fit_mixtures(rows, ["x", "y"], "all", [0], components=spare, restarts=5, prior="dirichlet")
    # A component's weight is its rows and the prior's 1 / spare, out of all rows and one.
    found = [(round(c.mean[0] / 1000), c.weight * (n + 1) - 1 / spare) for c in fitted]
    counted = spark.createDataFrame(found, "target int, n_rows double").groupBy("target")
    whole = counted.agg(F.round(F.sum("n_rows")).cast("bigint").alias("n_rows"))
    return whole.where("n_rows > 0")


REGISTERED = [
    scan_observations,
    row_identity,
    preview_top_n,
    flag_newest,
    join_labels,
    join_labels_salted,
    join_labels_typed,
    join_hot_both,
    newest_date,
    drop_newest_day,
    drop_newest,
    standardise,
    feature_moments,
    feature_moments_merged,
    feature_lookup,
    lookup_coverage,
    train_test_split,
    training_set,
    training_counts,
    union_classes,
    union_frames,
    upsert_features,
    create_feature_table,
    append_batch,
    append_keyed,
    read_as_of,
    overwrite_version,
    latest_version,
    predictions,
    accuracy,
    confusion_counts,
    confusion_normalised,
    class_counts,
    row_counts,
    r_squared,
    score_lookup,
    drift_ks,
    drift_sketch,
    drift_summary,
    drift_dataset,
    drift_document,
    drift_distributions,
    join_late_labels,
    label_join_performance,
    newest_model,
    newest_in_stage,
    gate,
    promote_staging,
    promote_production,
    run_tags_latest,
    resolve_versions,
    balanced_sample,
    exact_split,
    weighted_draw,
    alias_draw,
    apply_stored_scaler,
    rf_grid_search,
    rf_regression,
    batch_score,
    oob_votes,
    mixture_moments,
    mixture_sample,
    mixture_clusters,
    mixture_draw,
]


def queries() -> dict:
    return {q.__name__: q for q in REGISTERED}
