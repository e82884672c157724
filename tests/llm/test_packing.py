import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edges import frame, rows, texts
from tokenizers import Tokenizer

from grainmill.llm import packing, queries

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(JSON)
    made.encode_special_tokens = True
    return made


def unpacked(ids):
    return np.frombuffer(ids, "<u4").tolist()


def checked(pieces, wanted, limits, powers):
    """Every id in one piece, gapless sequences within the limits; how many ids lie in padded rows of max_tokens."""
    tokens, segments, losses = limits
    by_row, by_sequence = {}, {}
    for p in pieces:
        by_row.setdefault(p.uid, []).append((p.piece_start, unpacked(p.piece_ids)))
        by_sequence.setdefault(p.sequence_id, []).append((p.sequence_offset, len(p.piece_ids) // 4, p.piece_loss))
    joined = {}
    for uid, parts in by_row.items():
        ids = []
        for start, part in sorted(parts):
            assert start == len(ids) and part
            ids += part
        joined[uid] = ids
    assert joined == {uid: ids for uid, ids in wanted.items() if ids}
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens and len(parts) <= segments and sum(x[2] for x in parts) <= losses
        power = at & (at - 1) == 0
        assert not powers or power or at == tokens
        padding += 0 if power else tokens - at
    return padding


def packed(spark, data, limits, powers=False, loss=None, parts=3):
    made = [(i, np.array(ids, "<u4").tobytes(), None if loss is None else bytes(loss[i])) for i, ids in enumerate(data)]
    df = spark.createDataFrame(made, "uid long, ids binary, loss binary").repartition(parts)
    return packing.pack(df, *limits, loss=None if loss is None else "loss", keep=["uid"], powers=powers).collect()


@pytest.mark.parametrize("powers", [False, True])
@pytest.mark.parametrize("limits", [(16, 4, 16), (16, 3, 5), (100, 1, 100), (1, 1, 1), (64, 50, 20)])
def test_pieces_join_to_the_examples(spark, limits, powers):
    rng = random.Random(4)
    data = [[rng.randrange(2**32) for _ in range(rng.choice([0, 1, 2, 7, 16, 40, 300]))] for _ in range(150)]
    loss = [[rng.randrange(2) for _ in ids] for ids in data]
    for mask in (None, loss):
        got = packed(spark, data, limits, powers, mask)
        checked(got, dict(enumerate(data)), limits, powers)
        for p in got:
            n = len(p.piece_ids) // 4
            assert p.piece_loss == (n if mask is None else sum(mask[p.uid][p.piece_start : p.piece_start + n]))


def test_padding_is_little_though_limits_bind(spark):
    rng = random.Random(9)
    data = [[1] * min(1000, int(rng.paretovariate(0.9) * 20)) for _ in range(6_000)]
    loss = [[int(i > len(ids) * rng.random()) for i in range(len(ids))] for ids in data]
    limits = (512, 24, 400)
    padding = checked(packed(spark, data, limits, loss=loss, parts=1), dict(enumerate(data)), limits, False)
    assert padding < 0.02 * sum(map(len, data))


def test_repeated_tasks_give_the_same_sequences(spark):
    data = [[i] * (i % 37) for i in range(500)]
    first, again = (sorted(packed(spark, data, (32, 8, 32)), key=str) for _ in range(2))
    assert first == again


def test_ids_are_those_of_the_tokenizer(spark, tokenizer):
    odd = ["<|endoftext|> it's", "a\u0085b᠎c  d", "１２ ①½ ᾼ", *texts()]
    odd += ["\n".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(lo, lo + 512)) for lo in (0, 0x300, 0x2000, 0x1F300)]
    df = spark.createDataFrame(list(enumerate(odd)), "uid long, text string")
    got = df.select("uid", packing.token_ids(df.text, JSON, 0).alias("ids")).collect()
    for r in got:
        assert unpacked(r.ids) == [*tokenizer.encode(odd[r.uid] or "", add_special_tokens=False).ids, 0]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.encoding(public_tokenizers.path("word_bpe_49k.json"))


def test_edge_rows_and_limits(spark):
    df = frame(spark).withColumn("uid", packing.F.monotonically_increasing_id())
    df = df.withColumn("ids", packing.token_ids(df.text, JSON, 0)).select("*")
    got = packing.pack(df, 64, 8, 64, keep=["uid", "doc_id", "size", "lang"])
    assert got.columns[:4] == ["uid", "doc_id", "size", "lang"]
    wanted = {r.uid: unpacked(r.ids) for r in df.select("uid", "ids").collect()}
    assert len(wanted) == len(rows())
    checked(got.collect(), wanted, (64, 8, 64), False)
    assert packing.pack(df.limit(0), 64, 8, 64).collect() == []
    for bad in ((0, 1, 1), (1, 0, 1), (1, 1, 0)):
        with pytest.raises(ValueError):
            packing.pack(df, *bad)
    with pytest.raises(ValueError):
        packing.pack(df.withColumn("Piece_Ids", df.ids), 4, 4, 4, keep=["Piece_Ids"])


def test_query_against_the_tokenizer(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in docs.items()}
    by_doc, by_sequence = {}, {}
    for p in queries.op12_packing(spark, folder).collect():
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for found, ends in ((by_doc, {k: len(v) for k, v in ids.items()}), (by_sequence, {})):
        for k, parts in found.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == ends[k] if ends else at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    assert set(by_doc) == set(ids)
