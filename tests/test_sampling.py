import hashlib

import pytest
from pyspark.sql import functions as F

from grainmill.operators import sampling
from tests.conftest import rows


def order_of(seed, value):
    return hashlib.md5(f"{seed}-{value}".encode()).hexdigest()


def test_share_split_is_disjoint_complete_and_seeded(spark):
    df = spark.range(5000)
    split = sampling.train_test_split(df, ["id"], 0.7, 123)
    counts = dict(rows(split.groupBy("split").count()))
    assert sum(counts.values()) == 5000 and abs(counts["train"] - 3500) < 150
    again = sampling.train_test_split(df.repartition(7), ["id"], 0.7, 123)
    assert rows(split) == rows(again)
    assert rows(split) != rows(sampling.train_test_split(df, ["id"], 0.7, 124))


@pytest.mark.parametrize("leaf", [10, 100, 100_000])
@pytest.mark.parametrize("share", [0.0, 0.3, 0.7, 1.0])
def test_exact_split_against_a_sort(spark, leaf, share):
    n = 997
    split = sampling.exact_split(spark.range(n), ["id"], share, 5, leaf_rows=leaf)
    train = {r.id for r in split.filter("split = 'train'").collect()}
    wanted = sorted(range(n), key=lambda i: order_of(5, i))[: int(n * share)]
    assert train == set(wanted) and split.count() == n


def test_exact_split_of_nothing(spark):
    assert sampling.exact_split(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("leaf", [5, 100_000])
def test_copies_of_one_row_are_split_by_number(spark, leaf):
    # one row stands for most of the table, and its key is not unique
    df = spark.range(0, 300, 1, 4).selectExpr("CASE WHEN id < 200 THEN 'hot' ELSE concat('k', id) END AS k")
    split = sampling.exact_split(df, ["k"], 0.5, 1, leaf_rows=leaf)
    assert dict(rows(split.groupBy("split").count())) == {"train": 150, "test": 150}
    assert rows(split.groupBy("k").count()) == rows(df.groupBy("k").count())


def test_repeated_key_with_different_rows(spark):
    df = spark.range(300).selectExpr("'k' AS k", "id")
    split = sampling.exact_split(df, ["k"], 0.5, 1, leaf_rows=10)
    assert dict(rows(split.groupBy("split").count())) == {"train": 150, "test": 150}
    assert rows(split.select("id")) == rows(df.select("id"))
    again = sampling.exact_split(df.repartition(3), ["k"], 0.5, 1, leaf_rows=1000)
    assert rows(split) == rows(again)


@pytest.mark.parametrize("leaf", [10, 100_000])
def test_balanced_sample_against_a_sort(spark, leaf):
    df = spark.range(900).selectExpr("id", "CASE WHEN id < 700 THEN 'big' WHEN id < 710 THEN 'small' ELSE 'mid' END AS c")
    sample = sampling.balanced_sample(df, "c", 50, ["id"], 3, leaf_rows=leaf)
    groups = {"big": range(700), "small": range(700, 710), "mid": range(710, 900)}
    wanted = {(i, c) for c, ids in groups.items() for i in sorted(ids, key=lambda i: order_of(3, i))[:50]}
    assert {tuple(r) for r in sample.collect()} == wanted


def test_balanced_sample_skips_rows_without_a_class(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, c string")
    assert rows(sampling.balanced_sample(df, "c", 5, ["id"], 3)) == [(2, "a")]


def test_many_groups_without_broadcast(spark, no_broadcast):
    df = spark.range(3000).selectExpr("id", "id % 500 AS c")
    sample = sampling.balanced_sample(df, "c", 2, ["id"], 3)
    assert sample.count() == 1000 and sample.groupBy("c").count().filter("count <> 2").count() == 0


def test_weighted_draw(spark):
    df = spark.range(20000)
    drawn = sampling.draw_class(df, ["a", "b", "c"], [1.0, 0.0, 3.0], ["id"], 9)
    counts = dict(rows(drawn.groupBy("drawn").count()))
    assert set(counts) == {"a", "c"} and abs(counts["a"] / 20000 - 0.25) < 0.02
    assert rows(drawn.groupBy("drawn").count()) == rows(
        sampling.draw_class(df.repartition(5), ["a", "b", "c"], [1.0, 0.0, 3.0], ["id"], 9).groupBy("drawn").count()
    )
    only = sampling.draw_class(df, [0, 1, 2], [0.0, 1.0, 0.0], ["id"], 9)
    assert [r.drawn for r in only.select("drawn").distinct().collect()] == [1]
    assert sampling.draw_class(df, [7], [1.0], ["id"], 9).filter(F.col("drawn") == 7).count() == 20000


def test_alias_table_gives_each_class_its_share():
    for weights in ([1.0], [0.0, 3.0], [1.0, 2.0, 3.0, 0.0, 94.0], [float(i * i % 97) for i in range(10_000)], [1e-9, 1.0, 1e9]):
        share, other = sampling.alias_table(weights)
        got = [0.0] * len(weights)
        for i, (kept, rest) in enumerate(zip(share, other)):
            got[i] += kept / len(weights)
            got[rest] += (1 - kept) / len(weights)
        total = sum(weights)
        assert got == pytest.approx([w / total for w in weights], abs=1e-12)
        assert all(weights[i] or not kept for i, kept in enumerate(share)) and all(weights[j] for j, kept in zip(other, share) if kept < 1)
    for bad in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            sampling.alias_table(bad)


def test_draw_of_many_classes(spark):
    weights = [float(i % 5) for i in range(5_000)]
    drawn = sampling.draw_of_many(spark.range(30_000), weights, ["id"], 3)
    by_weight = dict(rows(drawn.groupBy((F.col("drawn") % 5).alias("w")).count()))
    assert set(by_weight) == {1, 2, 3, 4} and all(abs(by_weight[w] / 30_000 - w / 10) < 0.012 for w in by_weight)
