import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grainmill.functions.hashing import seeded_uniform
from grainmill.operators import bagging
from grainmill.session import materialise


def three_classes(spark, n=900):
    return materialise(
        spark.range(n).select(
            "id", (F.col("id") % 3 * 10 + F.rand(1) * 4).alias("a"), F.rand(2).alias("b"), (F.col("id") % 3).cast("int").alias("target")
        ),
        "bagging-test",
    )


def test_copies_are_poisson_and_repeat(spark):
    df = spark.range(20_000).withColumn("n", bagging.copies(["id"], 3, 5))
    counts = Counter(r.n for r in df.collect())
    for n in range(5):
        assert counts[n] / 20_000 == pytest.approx(math.exp(-1) / math.factorial(n), abs=0.012)
    assert sorted(df.collect()) == sorted(spark.range(20_000).repartition(7).withColumn("n", bagging.copies(["id"], 3, 5)).collect())


def test_out_of_bag_votes_come_from_trees_that_left_the_row_out(spark):
    rows = three_classes(spark)
    forest = bagging.fit_bagged(rows, ["a", "b"], "target", ["id"], trees=6, depth=2)
    votes = {r.id: r for r in forest.out_of_bag(rows).collect()}
    assert len(votes) == 900 and set(forest.out_of_bag(rows).columns) == {*rows.columns, "n_out", "prediction"}
    unseen = rows.select("id", *[(bagging.copies(["id"], t, 21) == 0).alias(f"t{t}") for t in range(6)])
    by_tree = []
    for number, tree in enumerate(forest.trees):
        scored = tree.transform(bagging.assembler(["a", "b"]).transform(rows)).select("id", "probability").collect()
        by_tree.append({r.id: r.probability.toArray() for r in scored})
    for r in unseen.collect():
        out = [t for t in range(6) if r[f"t{t}"]]
        vote = votes[r.id]
        assert vote.n_out == len(out)
        if out:
            total = sum(by_tree[t][r.id] for t in out)
            assert vote.prediction == int(total.argmax())
        else:
            assert vote.prediction is None


def test_score_is_like_that_on_new_rows(spark):
    noisy = materialise(
        spark.range(1500).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn(
            "target", F.when(F.rand(5) < 0.2, F.rand(6) < 0.5).otherwise(F.col("a") < 0.5).cast("int")
        ),
        "bagging-test",
    )
    train, test = noisy.where("id < 1000"), noisy.where("id >= 1000")
    forest = bagging.fit_bagged(train, ["a", "b"], "target", ["id"], trees=12, depth=4)
    oob = bagging.oob_score(forest.out_of_bag(train), "target").first()
    assert oob.n_rows > 980 and oob.oob_score == pytest.approx(0.9, abs=0.05)
    shares = forest._shares(test).select("target", F.element_at(F.element_at("_shares", 1), 2).alias("p"))
    fresh = shares.agg(F.avg(((F.col("p") > 0.5).cast("int") == F.col("target")).cast("double"))).first()[0]
    assert abs(fresh - oob.oob_score) < 0.06


def test_rows_without_a_label_or_a_feature(spark):
    rows = three_classes(spark, 300).unionByName(
        spark.createDataFrame([(1001, None, 0.5, 1), (1002, 3.0, 0.5, None)], "id long, a double, b double, target int")
    )
    forest = bagging.fit_bagged(rows, ["a", "b"], "target", ["id"], trees=3, depth=2)
    assert forest.out_of_bag(rows).count() == 302
    assert bagging.oob_score(forest.out_of_bag(rows).where("id < 0"), "target").first().n_rows == 0


def test_draws_are_stored_once_and_follow_the_digest(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(bagging, "materialise", lambda df, label: kept.append(materialise(df, label)) or kept[-1])
    rows = three_classes(spark, 300)
    bagging.fit_bagged(rows, ["a", "b"], "target", ["id"], trees=3, depth=2)
    drawn = [f.name for f in kept[0].schema if f.dataType.typeName() == "byte"]
    assert len(drawn) == 3
    u = seeded_uniform(["id"], 22)
    below = [sum(math.exp(-1) / math.factorial(n) for n in range(m + 1)) for m in range(bagging.MOST_COPIES)]
    stated = sum(((u >= b).cast("int") for b in below), F.lit(0))
    pairs = spark.range(20_000).select(bagging.copies(["id"], 1, 21).alias("got"), stated.alias("want"))
    assert pairs.where("got <> want or got is null").count() == 0
