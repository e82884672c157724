import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grainmill.functions import columns
from grainmill.functions.hashing import hashed_normal, hashed_uniform, row_identity, seeded_uniform
from grainmill.operators import joins, recency, scaling
from tests.conftest import rows

D = [dt.date(2024, 1, d) for d in range(1, 6)]


def test_rename_stamp_identity(spark):
    df = columns.rename(spark.range(2), {"id": "a"})
    stamped = columns.stamp(df)
    assert stamped.columns == ["a", "date", "hour"]
    assert columns.with_identity(df).select("Id").distinct().count() == 2
    once = rows(columns.with_identity(df, ["a"]))
    assert once == rows(columns.with_identity(df, ["a"]))
    assert columns.without(stamped, ["hour", "absent"]).columns == ["a", "date"]
    assert columns.feature_columns(stamped, ["date"]) == ["a", "hour"]


def test_identity_tells_nulls_apart(spark):
    data = [("a", None), (None, "a"), ("~", "a"), ("a-b", "c"), ("a", "b-c"), ("1:a", "b"), ("1", "a1:b"), ("", None), (None, "")]
    df = spark.createDataFrame(data, "x string, y string")
    assert df.select(row_identity(["x", "y"])).distinct().count() == len(data)


def test_draws_have_the_right_moments(spark):
    for uniform in (seeded_uniform, hashed_uniform):
        df = spark.range(20000).select(uniform(["id"], 1).alias("u"), hashed_normal(["id"], 2).alias("n"))
        m = df.agg(F.avg("u"), F.min("u"), F.max("u"), F.avg("n"), F.stddev_pop("n")).first()
        assert abs(m[0] - 0.5) < 0.01 and m[1] >= 0 and m[2] < 1
    assert abs(m[3]) < 0.03 and abs(m[4] - 1) < 0.03


def obs(spark, data):
    return spark.createDataFrame(data, "Id string, date date, hour int, x double")


def lab(spark, data):
    return spark.createDataFrame(data, "Id string, date date, hour int, target int")


def test_join_labels_needs_all_keys(spark):
    left = obs(spark, [("a", D[0], 1, 1.0), ("b", D[0], 1, 2.0), (None, D[0], 1, 3.0)])
    right = lab(spark, [("a", D[0], 1, 0), ("b", D[1], 1, 1), (None, D[0], 1, 2)])
    joined = joins.join_labels(left, right)
    assert joined.columns == ["Id", "date", "hour", "x", "target"]
    assert rows(joined) == [("a", D[0], 1, 1.0, 0)]


def test_late_labels_ignore_the_date(spark):
    left = obs(spark, [("a", D[0], 1, 1.0), ("b", D[0], 1, 2.0), ("c", D[0], 1, 2.0)])
    right = lab(spark, [("a", D[0], 1, 0), ("b", D[1], 1, 1)])
    assert rows(joins.join_late_labels(left, right), "Id", "date", "target") == [("a", D[0], 0), ("b", D[0], 1)]


@pytest.mark.parametrize("salted", [False, True])
def test_lookup_keeps_every_row(spark, salted):
    left = obs(spark, [("a", D[0], 1, 1.0), ("b", D[0], 1, 2.0), (None, D[0], 1, 3.0)])
    feats = spark.createDataFrame([("a", 1, 0.5), ("z", 1, 0.7)], "Id string, hour int, f double")
    found = joins.lookup_features(left, feats, ["f"], exclude=["x"], salted=salted)
    assert found.columns == ["Id", "hour", "date", "f"]
    assert {(r.Id, r.f) for r in found.collect()} == {("a", 0.5), ("b", None), (None, None)}
    assert rows(joins.count_missing(found, ["f"])) == [(3, 2)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_a_key_that_holds_a_third(spark, no_broadcast, how):
    facts = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS k", "id % 7 AS v"
    )
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("none", 4)], "k string, w int")
    salted = joins.salted_join(facts, lookup, ["k"], how)
    plain = facts.join(lookup, ["k"], how)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, salted.collect())) == sorted(map(key, plain.collect()))
    hot = joins.hot_keys(facts, F.xxhash64("k"), 512)
    named = spark.createDataFrame([("hot",), (None,)], "k string").select(F.xxhash64("k")).collect()
    assert set(hot) == {r[0] for r in named}
    assert all(abs(share - 1 / 3) < 0.01 for share in hot.values())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kinds", ["int bigint", "bigint smallint", "string int", "decimal(10,2) decimal(12,4)", "date timestamp"])
@pytest.mark.parametrize("salted", [True, None])
def test_keys_of_different_types_lose_no_rows(spark, no_broadcast, how, kinds, salted):
    left, right = kinds.split()
    value = "date_add(date'2024-01-01', {0})" if left == "date" else "{0}"
    fact = value.format("int(CASE WHEN id % 2 = 0 THEN 7 ELSE id % 90 END)")
    facts = spark.range(6000).selectExpr(f"CAST({fact} AS {left}) AS k", "id AS v")
    lookup = spark.range(60).selectExpr(f"CAST({value.format('int(id)')} AS {right}) AS k", "id AS w")
    got = joins.key_join(facts, lookup, ["k"], how, salted=salted)
    plain = facts.join(lookup, ["k"], how)
    assert got.schema == plain.schema
    assert sorted((r.v, str(r.k), str(r.w)) for r in got.collect()) == sorted((r.v, str(r.k), str(r.w)) for r in plain.collect())
    if kinds == "int bigint":
        assert "_salt" in got._jdf.queryExecution().toString()


def test_salting_spreads_copies_of_one_row(spark, no_broadcast):
    facts = spark.range(0, 3000, 1, 8).selectExpr("'hot' AS k", "1 AS v")
    lookup = spark.createDataFrame([("hot", 1)], "k string, w int")
    joined = joins.salted_join(facts, lookup, ["k"])
    assert joined.count() == 3000
    assert "_salt" in joined._jdf.queryExecution().toString()


def test_no_hot_key_means_a_plain_join(spark):
    facts = spark.range(5000).withColumnRenamed("id", "k")
    assert joins.hot_keys(facts, F.xxhash64("k"), 512) == {}
    assert "_salt" not in joins.salted_join(facts, facts, ["k"])._jdf.queryExecution().toString()


def test_union_frames_and_classes(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    assert rows(joins.union_frames([a, b])) == [(1, "x"), (2, "y")]
    named = joins.union_classes(joins.union_frames([a, b]), "t", {"x": 0})
    assert rows(named) == [(1, "x", 0)]


def test_newest_date_and_flag(spark):
    df = obs(spark, [("a", D[0], 1, 1.0), ("b", D[2], 1, 1.0), ("c", None, 1, 1.0)])
    assert rows(recency.newest_date(df)) == [(D[2],)]
    assert {(r.Id, r.is_newest) for r in recency.flag_newest(df).collect()} == {("a", False), ("b", True), ("c", False)}
    assert rows(recency.drop_newest(df), "Id") == [("a",)]


def test_empty_and_single_date(spark):
    assert recency.drop_newest(obs(spark, [])).count() == 0
    one = [("a", D[0], 1, 1.0), ("b", D[0], 1, 2.0)]
    labels = [("a", D[0], 1, 0), ("b", D[0], 1, 0)]
    assert recency.drop_newest(obs(spark, one)).count() == 0
    assert recency.labelled_history(obs(spark, one), lab(spark, labels), columns.KEYS).count() == 0
    assert recency.labelled_history(obs(spark, []), lab(spark, []), columns.KEYS).count() == 0


def test_newest_shared_date_is_the_joins_newest(spark):
    left = obs(spark, [("a", D[0], 1, 1.0), ("b", D[1], 1, 1.0), ("c", D[2], 1, 1.0), ("d", D[4], 1, 1.0)])
    right = lab(spark, [("a", D[0], 1, 0), ("b", D[1], 1, 0), ("x", D[2], 1, 0), ("y", D[3], 1, 0)])
    assert recency.newest_shared_date(left, right, columns.KEYS) == D[1]
    joined = joins.join_labels(left, right)
    assert rows(recency.drop_newest(joined)) == rows(recency.labelled_history(left, right, columns.KEYS))
    assert recency.newest_shared_date(left, lab(spark, [("q", D[0], 1, 0)]), columns.KEYS) is None
    # no match on the newest four days of both sides
    left = obs(spark, [(f"l{i}", D[i], 1, 1.0) for i in range(1, 5)] + [("a", D[0], 1, 1.0)])
    right = lab(spark, [(f"r{i}", D[i], 1, 1) for i in range(1, 5)] + [("a", D[0], 1, 1)])
    assert recency.newest_shared_date(left, right, columns.KEYS) == D[0]
    assert recency.newest_shared_date(left.filter("Id <> 'a'"), right, columns.KEYS) is None


def test_standardise_by_hand(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0)], "x double, c double")
    out = scaling.standardise(df, {"x": "zx", "c": "zc"}).collect()
    assert [r.zx for r in out] == [-1.0, 1.0, None, None]
    assert [r.zc for r in out] == [0.0] * 4


def test_standardise_empty(spark):
    assert scaling.standardise(spark.createDataFrame([], "x double"), {"x": "z"}).count() == 0


def test_moments_are_of_the_population_and_reusable(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "x double")
    moments = scaling.fit_moments(df, ["x"])
    (feature, n, mean, sd), = rows(scaling.tidy_moments(moments, ["x"]))
    assert (feature, n, mean) == ("x", 5, 3.0) and math.isclose(sd, math.sqrt(2))
    z = scaling.apply_moments(spark.createDataFrame([(3.0 + math.sqrt(2),)], "x double"), moments, {"x": "z"})
    assert math.isclose(z.first().z, 1.0)


@pytest.mark.parametrize("salts", [None, 3])
def test_a_key_hot_on_both_sides_is_joined_as_a_grid(spark, no_broadcast, salts):
    left = spark.range(0, 3_000, 1, 6).selectExpr("if(id % 3 = 0, 0, id % 500) AS k", "id AS a", "map('m', id) AS m")
    right = spark.range(0, 600, 1, 4).selectExpr("if(id % 3 = 0, 0, id % 400) AS k", "id AS b", "map('n', id) AS n")
    joined = joins.salted_join(left, right, ["k"], salts=salts)
    assert "_cell" in joined._jdf.queryExecution().analyzed().toString()
    assert joined.columns == ["k", "a", "m", "b", "n"]
    wanted = left.join(right, "k").select("a", "b")
    assert rows(joined.select("a", "b")) == rows(wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.6 * sum(sizes)  # of four partitions; without the grid one would hold nearly all


def test_states_merge_to_the_moments_of_all_rows(spark):
    df = spark.range(1_000).selectExpr("id", "1e9 + id * id AS a", "if(id < 400, null, rand(3)) AS b", "cast(null AS double) AS c")
    names = ["a", "b", "c"]
    parts = [scaling.moment_states(df.where(f"id % 4 = {i}"), names) for i in range(4)]
    parts.append(scaling.moment_states(df.limit(0), names))
    merged = scaling.moments_of_states(joins.union_frames(parts), names).first().asDict()
    whole = scaling.fit_moments(df, names).first().asDict()
    assert set(merged) == set(whole)
    for name, value in whole.items():
        assert merged[name] is None if value is None else merged[name] == pytest.approx(value, rel=1e-9)


def test_counted_join_merges_equal_rows_of_a_key_hot_on_both_sides(spark, no_broadcast):
    left = spark.range(60_000).select((F.col("id") % 3 % 2).alias("k"), (F.col("id") % 10).alias("a"))
    right = spark.range(30_000).select((F.col("id") % 3 % 2).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"))
    odd = spark.createDataFrame([(None, 1), (None, 1)], "k long, a long")
    joined = joins.join_late_labels(left.unionByName(odd), right, ["k"], counted="n", salted=True)
    found = {(r.k, r.a, r.b): r.n for r in joined.collect()}
    assert joined.columns == ["k", "a", "b", "n"] and len(found) == joined.count() == 2 * 10 * 5
    n = Counter((i % 3 % 2, i % 10) for i in range(60_000))
    m = Counter((i % 3 % 2, i % 5 or None) for i in range(30_000))
    assert found == {(k, a, b): x * y for (k, a), x in n.items() for (kk, b), y in m.items() if k == kk}
