import re
from collections import Counter, defaultdict

import pytest
from edges import frame, rows
from pyspark.sql import functions as F

from grainmill.llm import divergence, queries
from tools.check import compare, connect

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(data, min_df, top):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows, over dense vocabularies."""
    docs = [(TERM.findall((t or "").translate(LOWER)), lang or "", source or "") for t, lang, source in data]
    df, sums = defaultdict(Counter), defaultdict(Counter)
    for terms, lang, source in docs:
        df[lang].update(set(terms))
        sums[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in sums}:
        vocab = sorted(t for t, n in df[lang].items() if n >= min_df)
        groups = {s: sums[lang, s] for la, s in sums if la == lang}

        def shares(count):
            total = sum(count[t] for t in vocab)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(vocab)) for t in vocab}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in vocab), o.encode(), o) for o in groups if o != s]
            own = [(-f(p[s][t], q[t]), t.encode(), t) for t in vocab if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def check(df, data, min_df, top=10):
    got = divergence.audit(df, min_df=min_df, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain(data, min_df, top)


@pytest.mark.parametrize("min_df", [1, 2, 50])
def test_edge_rows(spark, min_df):
    check(frame(spark), [(r[1], r[2], r[3]) for r in rows()], min_df)


def test_sources_of_several_languages(spark):
    texts = ["the Cat sat", "the dog, the CAT", "ÉTÉ été 中文 the", "", None, "zebra zebra zebra the"]
    data = [(texts[i % 6], "en" if i % 5 else "fr", f"s{i % 4}") for i in range(60)]
    data += [("only here", "de", "alone"), (None, None, None), ("", None, "x"), ("the cat", None, "y")]
    df = spark.createDataFrame(data, "text string, lang string, source string").repartition(5)
    for min_df, top in ((1, 10), (3, 2), (12, 1)):
        check(df, data, min_df, top)


def test_ties_come_in_the_order_of_utf8(spark):
    # U+FF5E sorts before U+1F600 in UTF-8, and after it in UTF-16
    data = [("～ 😀 b a", "en", "s"), ("other", "en", "t")]
    df = spark.createDataFrame(data, "text string, lang string, source string")
    check(df, data, 1)
    got = divergence.audit(df, min_df=1).where("source = 's' AND part = 'term'").orderBy("rank")
    assert [r.item for r in got.collect()] == ["a", "b", "～", "😀"]


def test_a_hot_source(spark):
    data = [(f"w{i % 7} common words w{i % 3}x", "en", "hot" if i % 3 else f"s{i % 11}") for i in range(200)]
    df = spark.createDataFrame(data, "text string, lang string, source string").repartition(3)
    check(df, data, 4)


def test_large_counts_divide_exactly(spark):
    cases = [(0, 0, 1), (7, 9, 3), (10**15, 8 * 10**15, 10**12), (999, 10**9 + 7, 31), (5 * 10**12, 5 * 10**12, 1)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = df.select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in cases]


def test_no_rows_and_a_full_vocabulary(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        divergence.audit(frame(spark), min_df=1, vocab_size=5)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(queries.op13_divergence(spark, folder), connect(folder), queries.oracle_sql()["op13_divergence"]) == ""
