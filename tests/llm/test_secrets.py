import random
import re

import numpy as np
import pytest
from edges import frame, rows, words
from pyspark.sql import functions as F

from grainmill.llm import secrets

PATTERN = re.compile(
    r"""(?:(?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
TEXTS = [
    "token=abc token=abcdef",
    "secret=token: abcdefgh",
    'PassWord : "hunter2hunter2" api_key="x.y-z_1" APIKEY=\'123456',
    "AKIAABC AKIA" + "Z" * 16 + " AKIAAKIA" + "Q1" * 10,
    "deadbeefdeadbeefdeadbeef xdeadbeefdeadbeefdeadbee " + "0" * 30,
    "ñ😀 secret = ñ secret = abcdef😀",
    "password=password=password=",
    "token=" + "a" * 50_000,
    "token = " * 3_000 + "abcdefgh",
]
HIDDEN = ["q7Xz0Lk9vT2bNw8RfJ4mYc1sHd6G", "Zx81-kQ02_pLmV93tYbW47nRc5JsA"]
PLAIN = ["internationalization_of_everything", "some_long_function_name_here", "notasecretbutaverylongword"]


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in PATTERN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans(spark):
    texts = [*TEXTS, *[r[1] for r in rows()]]
    for r in secrets.scan(docs(spark, texts)).collect():
        assert [tuple(s) for s in r.base_spans] == plain(texts[r.doc_id])
        assert {tuple(s) for s in r.base_spans} <= {tuple(s) for s in r.secret_spans}


@pytest.fixture(scope="module")
def weights(spark):
    ordinary = [words(i, 200) + " " + " ".join(PLAIN) for i in range(200)]
    secret = [words(i, 100) + f" token = {i * 7919:040x}" for i in range(100)]
    return secrets.pair_weights(docs(spark, ordinary + secret))


def test_models_add_random_strings_only(spark, weights):
    texts = [f"see {h}, then {p}." for h in HIDDEN for p in PLAIN]
    for r in secrets.scan(docs(spark, texts), weights=weights).collect():
        found = [texts[r.doc_id][s.start : s.end] for s in r.secret_spans if s.rank == 3]
        assert found == [HIDDEN[r.doc_id // len(PLAIN)]]


def test_short_random_strings_are_found(spark, weights):
    short = ["f9Kq2ZtR7mWx4BvL", "7Xz0Lk9vT2", "Q4w8Zr1Kp6Ty"]
    assert [len(s) for s in short] == [16, secrets.MIN_RUN, 12]
    texts = [f"key '{s}' or {p}, not internationally" for s in short for p in PLAIN]
    for r in secrets.scan(docs(spark, texts), weights=weights).collect():
        assert [texts[r.doc_id][s.start : s.end] for s in r.secret_spans] == [short[r.doc_id // len(PLAIN)]]


def test_log_ratio_is_the_sum_of_pair_weights(spark, weights):
    n = len(secrets.ALPHABET)
    word = HIDDEN[0]
    at = [secrets.ALPHABET.index(c) for c in word]
    expect = max(sum(w[a * n + b] for a, b in zip(at, at[1:])) for w in weights)
    got = spark.range(1).select(secrets.log_ratio(F.lit(word), weights)).first()[0]
    assert got == pytest.approx(expect)


def plain_weights(texts, made):
    """Pair weights from plain counts over distinct texts and the made strings."""
    n, index = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    counts = np.zeros((len(secrets.MODELS), n, n))

    def add(label, word):
        for a, b in zip(word, word[1:]):
            if a in index and b in index:
                counts[label, index[a], index[b]] += 1

    for text in {t or "" for t in texts}:
        for m in PATTERN.finditer(text):
            if len(m[1]) >= secrets.MIN_SAMPLE:
                add(1, m[1])
        for run in re.findall("[A-Za-z0-9+/_=-]+", PATTERN.sub(" ", text)):
            if len(run) >= secrets.MIN_SAMPLE:
                add(int(bool(re.fullmatch("AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", run))), run)
    for label, word in made:
        add(label, word)
        add(1, word)
    share = counts.sum(axis=1) + 0.5
    share /= share.sum(axis=1, keepdims=True)
    logs = np.log((counts + secrets.PRIOR * share[:, None, :]) / (counts.sum(axis=2, keepdims=True) + secrets.PRIOR))
    return (logs[1:] - logs[0]).reshape(len(secrets.MODELS) - 1, -1)


def test_weights_and_spans_against_plain_ones(spark):
    texts = [words(i, 60) for i in range(40)] + TEXTS[:7] + [f"x {h} y" for h in HIDDEN] + [None, "", words(1, 60)]
    made = [tuple(r) for r in secrets.made_strings(spark).collect()]
    assert len(made) == secrets.MADE * len(secrets.RANDOM)
    for label, word in made[:500]:
        assert len(word) == 32 and set(word) <= set(secrets.RANDOM[secrets.MODELS[label]])
    expect = plain_weights(texts, made)
    weights = secrets.pair_weights(docs(spark, texts))
    assert np.array(weights) == pytest.approx(expect, abs=1e-9)
    n, index = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    for r in secrets.scan(docs(spark, texts), weights=weights).collect():
        text, base = texts[r.doc_id] or "", plain(texts[r.doc_id])
        found = list(base)
        for m in re.finditer("[A-Za-z0-9+/_=-]{10,}", text):
            at = [index[c] for c in m[0]]
            score = max(sum(w[a * n + b] for a, b in zip(at, at[1:])) for w in expect)
            if score >= secrets.THRESHOLD and not any(b[0] < m.end() and m.start() < b[2] for b in base):
                found.append((m.start(), 3, m.end()))
        assert [tuple(s) for s in r.secret_spans] == sorted(found)


@pytest.mark.parametrize("kind", list(secrets.RANDOM))
@pytest.mark.parametrize("length", [12, 16, 20])
def test_random_strings_of_every_alphabet_are_found(spark, weights, kind, length):
    rng = random.Random(length)
    strings = ["".join(rng.choices(secrets.RANDOM[kind], k=length)) for _ in range(200)]
    rows_ = spark.createDataFrame([(s,) for s in strings], "s string")
    assert rows_.where(secrets.log_ratio(F.col("s"), weights) >= secrets.THRESHOLD).count() >= 180


def test_columns_of_any_name_stay(spark, weights):
    df = docs(spark, ["token=abcdefgh"]).withColumns({f"secret_{k}": F.lit(k) for k in secrets.KINDS})
    row = secrets.scan(df, weights=weights).first()
    assert [row[f"secret_{k}"] for k in secrets.KINDS] == list(secrets.KINDS) and len(row.secret_spans) == 1


def test_masked_text(spark, weights):
    texts = ["a token = abcdef0123 b", "none", "", f"x {HIDDEN[0]} y AKIA" + "B" * 16]
    found = secrets.scan(docs(spark, texts), weights=weights)
    got = {r.doc_id: r.m for r in found.select("doc_id", secrets.masked(F.col("text"), F.col("secret_spans")).alias("m")).collect()}
    assert got == {0: "a [SECRET] b", 1: "none", 2: "", 3: "x [SECRET] y [SECRET]"}


def test_edge_rows_and_empty_table(spark):
    found = secrets.scan(frame(spark))
    assert found.count() == len(rows()) and "base_spans" in found.columns
    assert {r.shard for r in found.collect()} == {"shard"}
    assert secrets.scan(frame(spark, [])).collect() == []
