import random
import re
import zlib
from collections import Counter

import pytest
from edges import frame, rows

from grainmill.llm import queries, spelling
from tools.check import compare, connect

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(data, min_length=7, min_count=2, spare=31):
    out = Counter()
    for key, text in data:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            out[run[:at] + run[at + 1 :] if h % spare == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words, ratio=10):
    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out, key=str)


def check(spark, words, ratio=10, **options):
    df = spark.createDataFrame(list(words.items()) or [], "word string, n long")
    got = spelling.variants(df, ratio, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(words, ratio)


@pytest.mark.parametrize("spare", [1, 2, 31])
@pytest.mark.parametrize("min_length", [1, 7])
def test_words_of_edge_rows(spark, spare, min_length):
    data = [(r[0], r[1]) for r in rows()]
    got = spelling.count_words(frame(spark), min_length=min_length, min_count=1, spare=spare)
    wanted = plain_words(data, min_length, 1, spare)
    wanted.pop("", None)
    assert {r.word: r.n for r in got.collect()} == wanted


def random_words(seed, n, letters="abé", least=1, most=7):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(least, most))): rng.choice([1, 2, 9, 30, 400, 5_000, 90_000]) for _ in range(n)}


@pytest.mark.parametrize("block_words", [1, 7, 1_000])
def test_variants_against_all_pairs(spark, block_words):
    check(spark, random_words(block_words, 300), 10, block_words=block_words)


def test_chains_ties_and_runs_of_equal_letters(spark):
    words = {"aaaaaaa": 1, "aaaaaaaa": 10, "aaaaaaaaa": 100, "aaaaaaab": 100, "aaaaaab": 3, "xyz": 5, "xyzz": 50, "xyyz": 50}
    check(spark, words)
    check(spark, words, 2)
    check(spark, {w: 7 for w in words})
    long = "x" * 20_000
    check(spark, {long: 1, long + "y": 40, long[1:]: 40, "y" + long: 3})


def test_no_words(spark):
    check(spark, {})
    assert spelling.count_words(frame(spark, [])).collect() == []
    odd = spark.createDataFrame([(None, 3), ("", 4), ("word", 5)], "word string, n int")
    assert [tuple(r) for r in spelling.variants(odd).collect()] == [("word", None, "word", 5, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(odd, 1)


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_a_prefix_has_one_number_in_every_block(size):
    words = sorted(random_words(3, 200, "ab", 1, 9))
    blocks = [words[i : i + size] for i in range(0, len(words), size)]
    last = [None, *[b[-1] for b in blocks]]
    edges = [
        (j, -1 if last[j] is None else spelling.common(last[j], b[0]), spelling.common(b[0], b[-1]))
        for j, b in enumerate(blocks)
    ]
    known = spelling.owners(edges)
    number, nodes = {}, {}
    for j, b in enumerate(blocks):
        for word, path in zip(b, spelling.number_block(b, j, known[j])):
            assert len(path) == len(word) + 1
            for i, node in enumerate(path):
                assert number.setdefault(word[:i], node) == node and nodes.setdefault(node, word[:i]) == word[:i]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(queries.op11_spelling(spark, folder), connect(folder), queries.oracle_sql()["op11_spelling"]) == ""
