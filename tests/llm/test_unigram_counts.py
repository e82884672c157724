import random

import pytest
from edges import frame, rows, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from grainmill.llm import queries, unigram_counts


@pytest.fixture(scope="module")
def known():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.UNIGRAM_PIECES)
    special = lambda i: model.is_control(i) or model.is_unknown(i)
    pieces = [(f"\0{i}" if special(i) else model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    return Tokenizer(models.Unigram(pieces, 0, True))


def as_pieces(text):
    return "▁" + text.replace(" ", "▁") if text else ""


def test_counts_equal_the_library(spark, known):
    data = [*texts(), "a  b   c    d", "\n\n", "中文 😀́x", "é" * 300, "tab\tand\r\nline"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "doc_id long, text string")
    got = unigram_counts.count_tokens(docs, queries.UNIGRAM_PIECES).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(known.encode(as_pieces(t or "")).ids) for i, t in enumerate(data)}


@pytest.mark.parametrize("seed", range(30))
def test_ties_go_as_in_the_library(seed):
    """Small vocabularies of few scores, so that many paths are equal."""
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))): float(-rng.randint(1, 3)) for _ in range(12)}
    bytes_too = seed % 2 == 0
    listed = [("<unk>", 0.0), *pieces.items()]
    if bytes_too:
        listed += [(f"<0x{i:02X}>", -99.0) for i in range(256)]
    lowest = min(s for _, s in listed)
    library = Tokenizer(models.Unigram(listed, 0, bytes_too))
    vocabulary = unigram_counts.Vocabulary(list(pieces.items()), lowest, bytes_too)
    for _ in range(60):
        text = "".join(rng.choices("abcxé", weights=(9, 9, 9, 1, 1), k=rng.randint(1, 30)))
        assert vocabulary.best(text)[1] == len(library.encode(text).ids), text


def test_parts_add_up_to_the_whole():
    vocabulary = unigram_counts.read_vocabulary(queries.UNIGRAM_PIECES)
    assert vocabulary.segments
    for t in texts():
        n, score = unigram_counts.count_text(vocabulary, unigram_counts.Segments(vocabulary), t or "")
        assert not t or (score, n) == vocabulary.best(as_pieces(t))
    uneven = unigram_counts.Vocabulary([("▁a", -0.1), ("b", -0.3)], -0.3, False)
    assert not uneven.segments
    assert not unigram_counts.Vocabulary([("a▁b", -1.0)], -1.0, False).segments


def test_edge_rows_and_empty_table(spark):
    got = unigram_counts.count_tokens(frame(spark), queries.UNIGRAM_PIECES)
    assert got.select(F.count("*"), F.min("n_tokens")).first() == (len(rows()), 0)
    assert unigram_counts.count_tokens(frame(spark, []), queries.UNIGRAM_PIECES).collect() == []
