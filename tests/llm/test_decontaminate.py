import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from edges import frame, rows, words

from grainmill.llm import decontaminate
from grainmill.llm.text import SLICE_BYTES, flat, word_hash, word_hashes


def plain_align(a, b):
    best = 0.0
    table = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            table[i, j] = max(
                0, table[i - 1, j - 1] + step, table[i - 1, j] + decontaminate.GAP, table[i, j - 1] + decontaminate.GAP
            )
            best = max(best, table[i, j])
    return best


@pytest.mark.parametrize("seed", range(5))
def test_alignment_equals_the_full_table(seed):
    rng = np.random.default_rng(seed)
    items = [rng.integers(1, 6, rng.integers(1, 25)).astype(np.uint64) for _ in range(30)]
    texts = [rng.integers(1, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(30)]
    best, _ = decontaminate.align(*decontaminate._padded(items), *decontaminate._padded(texts))
    assert best.tolist() == pytest.approx([plain_align(a, b) for a, b in zip(items, texts)])


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join("zz" + w if rng.random() < share else w for w in text.split())


ITEMS = [words(900 + i, 30 + i) for i in range(8)]


def docs_with_leaks():
    clean = [words(i, 300) for i in range(60)]
    put = lambda i, passage: f"{words(i, 90)} {passage}\n{words(i + 1, 120)}"
    leaked = {100: put(100, ITEMS[0]), 101: put(101, ITEMS[1].upper()), 102: put(102, edited(ITEMS[2], 0.2, 1))}
    leaked[103] = put(103, ITEMS[3][: len(ITEMS[3]) * 2 // 3])
    leaked[104] = ITEMS[4]
    leaked |= {1000 + i: put(1000 + i, ITEMS[5]) for i in range(150)}  # a passage that most documents share
    data = list(enumerate(clean)) + list(leaked.items()) + [(300, ITEMS[6][:40]), (301, None), (302, "")]
    return data, {(100, 0), (101, 1), (102, 2), (103, 3), (104, 4)} | {(1000 + i, 5) for i in range(150)}


def test_copies_and_edited_copies_are_found_and_nothing_else(spark):
    data, expect = docs_with_leaks()
    docs = spark.createDataFrame(data, "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expect
    texts = dict(data)
    for r in found:
        if r.similarity == 1:
            assert " ".join(texts[r.doc_id].split()[r.first_word : r.end_word]).lower() == ITEMS[r.item_id]
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert kept == {i for i, _ in data} - {d for d, _ in expect}


def test_a_common_phrase_of_all_items_links_nobody(spark):
    phrase = "choose the right answer"
    items = [(i, f"{phrase} {words(700 + i, 25)}") for i in range(40)]
    data = [(i, f"{words(i, 60)} {phrase} {words(i + 1, 60)}") for i in range(50)] + [(99, items[7][1])]
    found = decontaminate.leaks(
        spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(99, 7)}


def test_edge_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, words(1, 120)), (4, words(1, 120)), (None, words(4, 70))], none.schema)
    assert decontaminate.leaks(frame(spark), none).collect() == []
    assert decontaminate.leaks(frame(spark, []), items).collect() == []
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark), items).collect()}
    assert found == {(5, 4), (6, 4), (None, None)}
    kept = decontaminate.clean(frame(spark), items)
    assert kept.columns == frame(spark).columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, frame(spark, [r for r in rows() if r[0] not in (5, 6, None)]).collect())
    )


def test_seeds_are_rare_and_every_item_has_some(spark):
    common = " ".join(["alpha beta gamma delta"] * 10)
    items = spark.createDataFrame([(0, "alpha beta gamma delta alpha"), (1, ITEMS[0])], "item_id long, text string")
    docs = spark.createDataFrame([(i, common) for i in range(30)], "doc_id long, text string")
    found = decontaminate.leaks(docs, items).collect()
    assert {r.item_id for r in found} == {0} and len(found) == 30
    assert decontaminate.in_set(decontaminate.bit_set(np.array([word_hash(b"x")], np.uint64)), np.array([word_hash(b"x")], np.uint64))[0]


def test_a_text_that_many_items_share_is_found_for_all_of_them(spark):
    text = words(5000, 300)
    items = [(i, f"{text} {words(5100 + i, 15)}") for i in range(25)] + [(100 + i, words(5200, 40)) for i in range(25)]
    put = lambda i, passage: f"{words(i, 400)} {passage} {words(i + 1, 400)}"
    data = [(0, put(0, text)), (1, put(2, items[7][1])), (2, words(8, 900)), (3, put(4, items[30][1]))]
    found = decontaminate.leaks(
        spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    own = {(1, 7): 1.0}
    expect = {(d, i): own.get((d, i), 300 / 315) for d in (0, 1) for i in range(25)} | {(3, 100 + i): 1.0 for i in range(25)}
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert got.keys() == expect.keys()
    # Words that the items' own ends share with a document by chance may add a little.
    assert all(expect[pair] - 1e-6 <= got[pair] <= expect[pair] + 0.02 for pair in got)
    assert {(r.first_word, r.end_word) for r in found if r.similarity == 1} == {(400, 715), (400, 440)}


def test_a_passage_reaches_over_its_whole_item(spark):
    common = " ".join(["alpha beta gamma delta"] * 60)
    item = f"{common} one rare end"
    data = [(i, common) for i in range(30)] + [(99, f"{words(1, 200)} {item} {words(2, 200)}")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    got = {r.doc_id: (r.similarity, r.first_word, r.end_word) for r in found}
    assert got[99] == (1.0, 200, 443) and len(got) == 31


def test_a_phrase_of_all_items_makes_no_pairs_before_the_alignment(spark, monkeypatch):
    phrase = words(4000, 40)
    items = [(i, f"{phrase} {words(4100 + i, 60)}") for i in range(60)]
    data = [(i, f"{words(i, 60)} {phrase} {words(1000 + i, 60)}") for i in range(80)] + [(99, items[7][1])]
    met = []
    whole = decontaminate.candidates

    def counted(hits, class_of, members, held, needed):
        out = whole(hits, class_of, members, held, needed)
        met.append((out.count(), hits.join(class_of, "gram").join(members, "class").select("passage", "row").distinct().count()))
        return out

    monkeypatch.setattr(decontaminate, "candidates", counted)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(99, 7)}
    ((pairs, every),) = met
    assert every >= 81 * 60 and pairs < every / 10


def test_a_long_quote_of_part_of_an_item_is_found(spark):
    item = words(6000, 300)
    quote = " ".join(item.split()[60:180])
    short = " ".join(item.split()[60:100])
    put = lambda i, passage: f"{words(i, 200)} {passage} {words(i + 1, 200)}"
    data = [(0, put(0, quote)), (1, put(2, edited(quote, 0.1, 3))), (2, put(4, short)), (3, put(6, edited(quote, 0.5, 4)))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.leaks(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert found.keys() == {0, 1}
    assert found[0].similarity == pytest.approx(0.4, abs=0.02) and abs(found[0].first_word - 200) <= 2


def test_keys_of_other_types_are_kept(spark):
    docs = spark.createDataFrame([("a-1", ITEMS[0]), (None, ITEMS[1]), ("c", "nothing")], "doc_id string, text string")
    items = spark.createDataFrame([("x", ITEMS[0]), ("y", ITEMS[1])], "item_id string, text string")
    found = decontaminate.leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {("a-1", "x"), (None, "y")}


def test_all_rows_equal_brute_force(spark):
    """Every document with every item, whole texts, by the full table."""
    rng = random.Random(8)
    items = [words(7000 + i, rng.randint(8, 40)) for i in range(12)]
    items += [f"{words(7100, 15)} {words(7200 + i, 20)}" for i in range(6)]
    data = []
    for i in range(60):
        item = rng.choice(items).split()
        cut = item[: max(4, int(len(item) * rng.choice([0.4, 0.5, 0.6, 0.8, 1])))]
        data.append((i, f"{words(i, 20)} {edited(' '.join(cut), rng.choice([0, 0.1, 0.2]), i)} {words(500 + i, 20)}"))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    expect = {}
    for d, text in data:
        a = text.lower().split()
        grams = set(zip(a, a[1:], a[2:]))
        for i, item in enumerate(items):
            b = item.lower().split()
            near = plain_align(b, a) / len(b)
            if near >= decontaminate.SIMILARITY and grams & set(zip(b, b[1:], b[2:])):
                expect[d, i] = near
    assert len(expect) > 30
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(expect, abs=1e-6)


def test_long_regular_words_have_hashes_of_their_own():
    one = np.array([bin(i).count("1") % 2 for i in range(1024)], np.uint8) + 97
    other = np.array([195], np.uint8) - one
    for n in (64, 65, 512, 1024):
        assert word_hash(one[:n].tobytes()) != word_hash(other[:n].tobytes())
    text = b"short " + one.tobytes().upper() + b" tail"
    hashes, _ = word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert hashes[1] == word_hash(one.tobytes())


def test_words_are_counted_in_parts_of_few_bytes():
    text = pa.array([None, "", *(f"{i % 9} thé Wort{i % 50} " * 400 for i in range(600))])
    every, _ = word_hashes(*flat(text))
    marks = SimpleNamespace(value=decontaminate.bit_set(every[::3]))
    out = list(decontaminate._counted(marks)(iter([pa.RecordBatch.from_arrays([text], ["text"])])))
    assert len(out) >= sum(len((t or "").encode()) for t in text.to_pylist()) / SLICE_BYTES > 3
    got = Counter()
    for batch in out:
        assert batch.schema.types == [pa.int64(), pa.int64()]
        for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
            got[word] += n
    kept = every[decontaminate.in_set(marks.value, every)].view(np.int64)
    assert got == Counter(kept.tolist()) + Counter({None: len(every)})
