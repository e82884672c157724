import re
from collections import Counter

import numpy as np
import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F

from grainmill.llm import quality
from grainmill.session import materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    found = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(found), sum(map(len, found)), symbols, dup, len(covered), failed


TEXTS = [
    "a b c a b c",
    "a a a a",
    "a b a b a b x y z",
    "\x0b\x0c lead\x1cin g b   # * $%&|<> tail \n",
    "line\nline\n \n \nline \nother\r\nother\r\n",
    words(1, 60) + " " + words(1, 60),
    words(1, 60) + " " + words(2, 59),
    "É" * 10,
]


def test_base_counts(spark):
    data = [(i, t) for i, t in enumerate([*TEXTS, *[r[1] for r in rows()]])]
    got = quality.measured(spark.createDataFrame(data, "doc_id long, text string")).collect()
    for r in got:
        assert tuple(r[c] for c in (*quality.BASE, "base_failed")) == plain(data[r.doc_id][1]), r.doc_id


def clean_and_junk(n=400):
    clean = [(i, words(i, 80 + i % 60), "en", f"s{i % 2}") for i in range(n)]
    junk = [(n + i, " ".join(w + "###" for w in words(n + i, 90).split()), "en", "s0") for i in range(8)]
    shout = [(n + 10 + i, words(n + 10 + i, 90).upper() + "!!", "en", "s1") for i in range(8)]
    few = [(n + 20 + i, words(n + 20 + i, 90), "xx", None) for i in range(3)]
    return clean, junk + shout, few


def test_far_documents_go_and_others_stay(spark):
    clean, junk, few = clean_and_junk()
    docs = spark.createDataFrame(clean + junk + few, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {r[0] for r in clean + few}


def test_estimate_is_the_minimum_determinant_one(spark):
    """The final estimate is a fixed point: mean and covariance of its own nearest share."""
    clean, junk, _ = clean_and_junk()
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    stats = quality.measured(docs).withColumns({"group": F.lit("g"), quality.PIECE: F.lit(0)}).cache()
    made = quality.estimates(stats, "group").first()
    x = np.array([[r[f"stat_{a}"] for a in quality.STATS] for r in stats.where("NOT base_failed").collect()])
    centre = np.array([made[f"c_{a}"] for a in quality.STATS])
    w = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            w[i, j] = made[f"w_{i}_{j}"]
    d2 = (((x - centre) @ w.T) ** 2).sum(axis=1)
    near = x[d2 <= np.quantile(d2, quality.H, method="inverted_cdf")]
    floors = np.diag([f**2 for f in quality.FLOORS.values()])
    assert np.allclose(near.mean(axis=0), centre, atol=2e-3)
    assert np.allclose(np.cov(near.T, bias=True) + floors, np.linalg.inv(w.T @ w), atol=2e-3)
    stats.unpersist()


def plain_estimate(x):
    """Centre, covariance and log determinant of the best of the stated starts, by exact sorting."""
    floors = np.array(list(quality.FLOORS.values()))

    def rank(values, share):
        return np.sort(values, axis=0)[max(0, int(np.ceil(share * len(values))) - 1)]

    def of(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True) + np.diag(floors**2)

    middle = rank(x, 0.5)
    spread = 1.4826 * rank(np.abs(x - middle), 0.5) + floors
    worst = (np.abs(x - middle) / spread).max(axis=1)
    starts = [(middle, np.diag(spread**2)), of(x), of(x[worst <= rank(worst, quality.H)])]
    found = []
    for centre, v in starts:
        for _ in range(quality.STEPS):
            d2 = np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(v), x - centre)
            centre, v = of(x[d2 <= rank(d2, quality.H)])
        found.append((np.linalg.slogdet(v)[1], centre, v))
    return min(found, key=lambda f: f[0])


def test_verdicts_against_a_plain_estimate(spark):
    """Groups of one source, of a language's small sources, of small languages, and every row for the rest."""
    def odd(i, text):
        return text if i % 9 else " ".join(w + "$#" * (i % 4) for w in text.split())

    data = [(i, odd(i, words(i, 70 + i % 50)), "en", "big" if i % 3 else f"s{i % 12}") for i in range(360)]
    data += [(400 + i, odd(i, words(900 + i, 60 + i)), "fr", f"t{i % 3}") for i in range(120)]
    data += [(600 + i, odd(i, words(990 + i, 60 + i)), f"l{i % 2}", None) for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(4)
    stats = materialise(quality.measured(docs).drop("text").withColumns({c: F.lit(1) for c in ("c_symbols", "w_0_0", "scale", "edge", "d2")}), "t")
    judged = {r.doc_id: r for r in quality.judge(stats).collect()}
    assert {r.scale for r in judged.values()} == {1}
    rows_ = {r.doc_id: r for r in stats.collect()}
    x = {k: np.array([r[f"stat_{a}"] for a in quality.STATS]) for k, r in rows_.items()}
    used = [k for k, r in rows_.items() if not r.base_failed]
    groups = {"big": [k for k in used if rows_[k].source == "big"], "en": [], "fr": [], "rest": []}
    for k in used:
        if rows_[k].source != "big":
            groups[rows_[k].lang if rows_[k].lang in ("en", "fr") else "rest"].append(k)
    assert len(groups["rest"]) < quality.MIN_GROUP < len(groups["en"])
    rejected = 0
    for name, own in groups.items():
        base = np.array([x[k] for k in (used if name == "rest" else own)])
        _, centre, v = plain_estimate(base)
        inverse = np.linalg.inv(v)
        d2 = {k: (x[k] - centre) @ inverse @ (x[k] - centre) for k in own}
        every = np.einsum("ni,ij,nj->n", base - centre, inverse, base - centre)
        scale = max(1.0, np.sort(every)[int(np.ceil(0.5 * len(every))) - 1] / quality.MEDIAN_CHI2)
        for k in own:
            assert judged[k].distance == pytest.approx(d2[k] / scale, rel=0.02, abs=0.02), (name, k)
            assert judged[k].kept == (judged[k].distance <= quality.CUT)
            rejected += not judged[k].kept
    assert rejected > 10
    assert all(not judged[k].kept for k, r in rows_.items() if r.base_failed)


def test_a_pass_meets_one_table(spark, monkeypatch):
    """Concentration steps join the rows with one small table, so the driver plans and sends one a pass."""
    joins, write = {}, quality.materialise

    def spy(df, label="stage"):
        joins.setdefault(label, []).append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, label)

    monkeypatch.setattr(quality, "materialise", spy)
    docs = spark.createDataFrame(clean_and_junk(250)[0], "doc_id long, text string, lang string, source string")
    quality.judge(write(quality.measured(docs))).count()
    assert max(joins["quality-edge"] + joins["quality-step"]) == 1


def test_edge_rows(spark):
    docs = frame(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    expect = [r for r in rows() if not plain(r[1])[-1]]
    assert sorted(map(str, kept.collect())) == sorted(map(str, frame(spark, expect).collect()))


def test_empty_table(spark):
    assert quality.keep_good(frame(spark, [])).collect() == []


@pytest.mark.parametrize("n", [20, 200])
def test_equal_documents_have_no_outliers(spark, n):
    data = [(i, words(3, 80), "en", "s") for i in range(n)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    assert quality.keep_good(docs).count() == n
