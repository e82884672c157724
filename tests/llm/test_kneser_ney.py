import math
from collections import Counter

import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F

from grainmill.llm import kneser_ney


class Plain:
    """The same model from whole dictionaries."""

    def __init__(self, texts):
        sequences = [self.tokens(t) for t in texts]
        self.count = Counter(w for s in sequences for w in s)
        self.pair = Counter(p for s in sequences for p in self.pairs(s))
        self.after = Counter(v for _, v in self.pair)
        self.total, self.kinds = Counter(), Counter()
        for (u, _), n in self.pair.items():
            self.total[u] += n
            self.kinds[u, min(n, 3)] += 1
        self.d2 = (0, *self.discounts(self.pair)) if self.pair else (0,) * 4
        self.d1 = (0, *self.discounts(self.after)) if self.pair else (0,) * 4
        self.n, self.v = sum(self.count.values()), len(self.count)

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), b"\n"]

    @staticmethod
    def pairs(tokens):
        return list(zip([b"\t", *tokens], tokens))

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        return kneser_ney.discounts(tuple(n[i] for i in (1, 2, 3, 4)))

    def probability(self, u, v):
        uniform = 1 / (self.v + 1)
        kinds = Counter(min(n, 3) for n in self.after.values())
        spare = sum(self.d1[i] * kinds[i] for i in (1, 2, 3))
        alone = (self.after[v] - self.d1[min(self.after[v], 3)] + spare * uniform) / len(self.pair) if self.pair else uniform
        if not self.total[u]:
            return alone
        n = self.pair[u, v]
        spare = sum(self.d2[i] * self.kinds[u, i] for i in (1, 2, 3))
        return (n - self.d2[min(n, 3)]) / self.total[u] + spare / self.total[u] * alone

    def expect(self, text):
        tokens = self.tokens(text)
        return (
            len(tokens),
            sum(self.count[t] > 0 for t in tokens),
            sum(math.log10((self.count[t] + 1) / (self.n + self.v + 1)) for t in tokens),
            sum(math.log10(self.probability(u, v)) for u, v in self.pairs(tokens)),
        )


TRAIN = [words(i, 40 + i) + " the cat the dog the cat" for i in range(30)] + ["The THE the", None, "", "a " * 500]
TEST = [*TRAIN[:6], None, "", "unseen words only", "The cat, the dog", words(77, 3_000)]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("bucket", [16 << 20, 300])
def test_scores_equal_the_plain_model(spark, bucket):
    plain = Plain(TRAIN)
    model = kneser_ney.train(docs(spark, TRAIN).repartition(5), bucket_bytes=bucket)
    assert (model.tokens, model.words, model.pairs) == (plain.n, plain.v, len(plain.pair))
    assert bucket > 300 or (model.bits >= 4 and model.hot)
    scored = docs(spark, TEST).select("doc_id", kneser_ney.score(F.col("text"), model).alias("s"))
    for r in scored.collect():
        assert tuple(r.s) == pytest.approx(plain.expect(TEST[r.doc_id]), rel=1e-9)


@pytest.mark.parametrize("first_bits", [0, 2])
def test_hot_words_do_not_follow_the_ranges(spark, first_bits):
    plain = Plain(TRAIN)
    model = kneser_ney.train(docs(spark, TRAIN).repartition(5), bucket_bytes=100, first_bits=first_bits)
    assert model.bits >= 5 and len(model.hot) <= 8 << first_bits
    scored = docs(spark, TEST).select("doc_id", kneser_ney.score(F.col("text"), model).alias("s"))
    for r in scored.collect():
        assert tuple(r.s) == pytest.approx(plain.expect(TEST[r.doc_id]), rel=1e-9)


def test_probabilities_of_all_words_sum_to_one():
    plain = Plain(TRAIN)
    for u in (b"the", b"\t", b"never seen"):
        assert sum(plain.probability(u, v) for v in [*plain.count, b"unknown"]) == pytest.approx(1)


def test_edge_rows(spark):
    plain = Plain([r[1] for r in rows()])
    model = kneser_ney.train(frame(spark))
    scored = frame(spark).select("text", kneser_ney.score(F.col("text"), model).alias("s")).collect()
    assert len(scored) == len(rows())
    for r in scored:
        assert tuple(r.s) == pytest.approx(plain.expect(r.text), rel=1e-9)


def test_no_training_rows(spark):
    model = kneser_ney.train(frame(spark, []))
    got = docs(spark, ["a b", None]).select(kneser_ney.score(F.col("text"), model).alias("s")).collect()
    assert [tuple(r.s) for r in got] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert frame(spark, []).select(kneser_ney.score(F.col("text"), model)).collect() == []
