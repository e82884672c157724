import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F

from grainmill.llm import toxicity
from grainmill.llm.text import flat

BAD = ["idiotic", "scumbag", "lowlife"]
SCHEMA = "doc_id long, text string, lang string, label int"


def labelled(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text, toxic = words(seed * 10_000 + i, rng.randint(20, 90)).split(), i % 5 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", ".", "x", "##"]))
        out.append((i, " ".join(text), "en" if i % 3 else "de", int(toxic)))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.createDataFrame(labelled(900, 1), SCHEMA)
    return toxicity.train(rows, "text", "label", "doc_id", "lang")


def test_held_out_accuracy(spark, trained):
    net, thresholds = trained
    data = labelled(300, 2)
    got = spark.createDataFrame(data, SCHEMA).select(
        "label", "lang", toxicity.score(F.col("text"), net).alias("score")
    )
    got = got.withColumn("flag", toxicity.flagged(F.col("lang"), F.col("score"), thresholds)).collect()
    right = np.mean([(r.score >= toxicity.AT) == bool(r.label) for r in got])
    assert right > 0.97 and np.mean([r.flag == bool(r.label) for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and set(thresholds) <= {"en", "de"} and thresholds


def test_score_depends_on_the_text_alone(spark, trained):
    texts = ["", "a b", words(3, 500), "you idiotic thing", None]
    whole = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    at_once = [r[0] for r in whole.select(toxicity.score(F.col("text"), trained[0])).collect()]
    alone = [
        spark.createDataFrame([(t,)], "text string").select(toxicity.score(F.col("text"), trained[0])).first()[0]
        for t in texts
    ]
    assert at_once == pytest.approx(alone, rel=1e-5) and at_once[0] == at_once[4]


def test_features_of_words_and_stems():
    data, at = flat(pa.array(["Idiot idiots", "", "abc idiot"]))
    found, rows_at = toxicity.features(data, at)
    assert rows_at.tolist() == [0, 3, 4, 7]
    assert found[0, 0] == found[5, 0] and found[0, 2] == found[1, 2] and found[4, 1] == 0
    assert not found[2].any() and not found[3].any()


def test_gradient_of_the_fit_lowers_the_loss():
    data = labelled(200, 5)
    texts = []
    for _, t, _, _ in data:
        texts.append(toxicity.features(*flat(pa.array([t])))[0])
    labels = np.array([r[3] for r in data], float)
    net = toxicity.fit(texts, labels)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    p = 1 / (1 + np.exp(-net.logits(np.concatenate(texts), at)))
    loss = -np.mean(labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))
    assert loss < 0.1
    again = toxicity.Net.unpacked(net.packed())
    assert np.allclose(again.scores(np.concatenate(texts), at), net.scores(np.concatenate(texts), at))


def test_edge_rows_one_label_and_no_rows(spark):
    docs = frame(spark).withColumn("label", F.lit(1))
    for data in (docs, docs.where("false"), docs.withColumn("label", F.lit(None).cast("int"))):
        net, thresholds = toxicity.train(data, "text", "label", "doc_id", "lang")
        scored = frame(spark).select(toxicity.score(F.col("text"), net).alias("s")).collect()
        assert len(scored) == len(rows()) and all(0 <= r.s <= 1 for r in scored) and not thresholds
    assert frame(spark, []).select(toxicity.score(F.col("text"), net)).collect() == []


def test_every_labelled_row_is_learnt_from(spark):
    """Words of few rows, and pieces of which none has them all: a net of a sample of 100 lacks most."""
    data, rare = labelled(900, 7), [f"zork{chr(97 + i)}{chr(97 + i)}qu" for i in range(12)]
    data = [(i, f"{t} {rare[i // 5 % 12]}" if i % 5 == 0 and i < 300 else t, lang, y) for i, t, lang, y in data]
    docs = spark.createDataFrame(data, SCHEMA)
    packed, thresholds = toxicity.train(docs, "text", "label", "doc_id", "lang", 100)
    hold = docs.select("doc_id", (F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) % toxicity.HOLD == 0).alias("h"))
    held = {r.doc_id for r in hold.collect() if r.h}
    texts = {i: toxicity.features(*flat(pa.array([t])))[0] for i, t, _, _ in data}
    found = np.concatenate([np.unique(t[t > 0]) for i, t in texts.items() if i not in held])
    bucket, times = np.unique(found, return_counts=True)
    net = toxicity.Net.unpacked(packed)
    assert np.flatnonzero(net.rows).tolist() == bucket[times >= toxicity.MIN_DOCS].tolist()
    again, same = toxicity.train(docs, "text", "label", "doc_id", "lang", 100)
    assert toxicity.Net.unpacked(again).scale == pytest.approx(net.scale) and same == pytest.approx(thresholds)
    fresh = spark.createDataFrame(labelled(300, 8), SCHEMA).select("label", toxicity.score(F.col("text"), packed).alias("s"))
    assert np.mean([(r.s >= toxicity.AT) == bool(r.label) for r in fresh.collect()]) > 0.97


def test_a_single_piece_is_fitted_as_by_fit(spark):
    data = labelled(300, 9)
    docs = spark.createDataFrame(data, SCHEMA).withColumn("pick", F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)))
    made = [(r.pick, toxicity.features(*flat(pa.array([r.text])))[0], r.label) for r in docs.collect()]
    made = sorted((m for m in made if m[0] % toxicity.HOLD), key=lambda m: (m[0], m[1].tobytes()))
    net = toxicity.fit([t for _, t, _ in made], np.array([y for _, _, y in made], float))
    got = toxicity.Net.unpacked(toxicity.train(docs, "text", "label", "doc_id", "lang")[0])
    assert np.array_equal(got.embed, net.embed) and np.array_equal(got.last, net.last.astype(np.float32))
    assert all(map(np.array_equal, got.filters, net.filters)) and got.bias == net.bias


def test_equal_keys_and_texts_come_in_parts():
    texts = [f"{'a' * (i + 1)} b" for i in range(12)]
    pdf = pd.DataFrame({"piece": [0] * 5 + [2] * 7, "pick": 9, "text": texts, "label": [0, 1] * 6})
    parts = list(toxicity._gathered(iter([pdf[:3], pdf[3:3], pdf[3:]]), 3))
    assert [(piece, part, len(t)) for piece, part, t, _ in parts] == [(0, 0, 3), (0, 1, 2), (2, 0, 3), (2, 1, 3), (2, 2, 1)]
    expect = {toxicity.features(*flat(pa.array([t])))[0].tobytes(): i % 2 for i, t in enumerate(texts)}
    assert {w.tobytes(): int(y) for _, _, t, labels in parts for w, y in zip(t, labels)} == expect


@pytest.mark.parametrize("levels", [3, 40, 10_000])
def test_best_cuts_are_those_of_all_rows(spark, levels):
    rng = np.random.default_rng(levels)
    label = rng.integers(0, 2, 600).tolist()
    data = [("ab"[i % 3 > 0], float(rng.integers(0, levels) + y * levels // 4), y) for i, y in enumerate(label)]
    got = {r.lang: r for r in toxicity.best_cuts(spark.createDataFrame(data, "lang string, value double, label int")).collect()}
    for lang in "ab":
        own = sorted({v for x, v, _ in data if x == lang}, reverse=True)
        hits = sum(y for x, _, y in data if x == lang)

        def f1(cut):
            above = [y for x, v, y in data if x == lang and v >= cut]
            return 2 * sum(above) / (len(above) + hits)

        at = max(range(len(own)), key=lambda i: f1(own[i]))
        assert got[lang].cut == ((own[at] + own[at + 1]) / 2 if at + 1 < len(own) else own[at] - 1)
        assert (got[lang].n, got[lang].hits) == (sum(x == lang for x, _, _ in data), hits)


def test_labels_of_a_table_meet_texts_in_their_pieces(spark, monkeypatch):
    """As rows joined before, keys and labels repeated or null too; a text is shuffled once."""
    data, stored, store = labelled(300, 11), [], toxicity.materialise
    rows = [(i, t, lang) for i, t, lang, _ in data] + [(3, "again here", "en"), (3, "again here", None), (None, "x y", "en")]
    marks = [(i, y) for i, _, _, y in data if i % 4] + [(3, 1), (5, None), (None, 1), (9_999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, label int")
    whole = toxicity.train(docs.join(labels, "doc_id"), "text", "label", "doc_id", "lang", 100)
    monkeypatch.setattr(toxicity, "materialise", lambda df, name: stored.append(df) or store(df, name))
    assert toxicity.train(docs, "text", "label", "doc_id", "lang", 100, labels) == whole
    plan = stored[0]._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("shufflepartitionidpassthrough") == 2 and plan.count("Exchange") <= 3
    assert stored[0].count() == docs.join(labels.where("label is not null"), "doc_id").count()
