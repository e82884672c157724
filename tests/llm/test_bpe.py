import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from edges import CLASHING, frame, rows, texts
from pyspark.sql import functions as F

from grainmill.llm import bpe, queries
from grainmill.llm.text import SLICE_BYTES

RANKS, PATTERN = queries.BPE_RANKS, public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("seed", range(20))
def test_merges_like_the_library(known, seed):
    rng = random.Random(seed)
    piece = "".join(rng.choices("abAB thé中.", k=rng.randint(1, 60)))
    expect = [i for m in regex.findall(PATTERN, piece) for i in bpe.merge_piece(bpe.read_ranks(RANKS), m.encode())]
    assert expect == known.encode_ordinary(piece)


@pytest.mark.parametrize("size", [1, 5, 1 << 17])
def test_kept_pieces_are_merged_alike(size):
    ranks, rng = bpe.read_ranks(RANKS), random.Random(size)
    pieces = bpe.Pieces(ranks, size)
    for _ in range(2_000):
        piece = "".join(rng.choices("aabthé中 ", k=rng.choice([1, 3, 9, 70])))
        assert ids(pieces[piece]) == bpe.merge_piece(ranks, piece.encode())
        assert len(pieces) <= size and len(pieces.old) <= size


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 512), (100, 20), (64, 64), (7, 2)])
def test_edge_rows(spark, known, chunk, overlap):
    data = [r for r in rows() if chunk > 64 or r[1] is None or len(r[1]) < 5_000]
    docs = frame(spark, data)
    out = bpe.encode(docs, RANKS, PATTERN, chunk_chars=chunk, overlap=overlap)
    assert sorted(out.columns) == sorted(docs.columns)
    got = sorted((r.doc_id is None, r.doc_id, ids(r.ids), r.kept) for r in out.collect())
    assert got == sorted((r[0] is None, r[0], known.encode_ordinary(r[1] or ""), "kept") for r in data)


def test_chunks_without_a_shared_boundary_are_joined(spark, known):
    data = [(1, "a" * 1_000 + " " + "b" * 500 + "  \n\n  c"), (2, " " * 777 + "x"), (3, "it's " * 300)]
    out = bpe.encode(spark.createDataFrame(data, "doc_id long, text string"), RANKS, PATTERN, chunk_chars=50, overlap=5)
    assert {r.doc_id: ids(r.ids) for r in out.collect()} == {i: known.encode_ordinary(t) for i, t in data}


def test_round_trip_and_query_digests(spark, tmp_path, known):
    frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op1_byte_bpe(spark, str(tmp_path)).collect():
        assert r.n_tokens is not None and len(r.ids_sha256) == 64
    out = bpe.encode(frame(spark), RANKS, PATTERN).withColumn("back", bpe.decode(F.col("ids"), RANKS))
    assert sorted(bytes(r.back) for r in out.collect()) == sorted((r[1] or "").encode() for r in rows())
    digest = {r.doc_id: r.ids_sha256 for r in queries.op1_byte_bpe(spark, str(tmp_path)).collect()}
    packed = np.array(known.encode_ordinary(texts()[4]), "<u4").tobytes()
    assert digest[4] == hashlib.sha256(packed).hexdigest()


def test_empty_table_and_null_ids(spark):
    assert bpe.encode(frame(spark, []), RANKS, PATTERN).collect() == []
    assert "ids" in CLASHING
    one = spark.sql("SELECT CAST(NULL AS BINARY) AS ids").select(bpe.decode(F.col("ids"), RANKS).alias("b"))
    assert bytes(one.first().b) == b""


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        bpe.encode(frame(spark), RANKS, PATTERN, chunk_chars=10, overlap=11)


def test_batches_are_worked_on_in_parts_of_few_bytes(spark, known):
    data = [(i, None if i % 7 == 3 else "" if i % 7 == 5 else f"{i} thé 中 " * 900) for i in range(400)]
    batch = pa.array([t for _, t in data])
    parts = list(bpe._parts(iter([batch.slice(0, 0), batch])))
    assert len(parts) > 3 and pa.concat_arrays(parts).equals(batch) and len(parts[0]) == 0
    assert max(sum(len((t or "").encode()) for t in p.to_pylist()) for p in parts) <= SLICE_BYTES
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    out = bpe.encode(docs, RANKS, PATTERN).withColumn("back", bpe.decode(F.col("ids"), RANKS))
    assert {r.doc_id: (ids(r.ids), bytes(r.back)) for r in out.collect()} == {
        i: (known.encode_ordinary(t or ""), (t or "").encode()) for i, t in data
    }


def test_pairs_are_forgotten_when_full():
    ranks, rng = bpe.read_ranks(RANKS), random.Random(3)
    pairs, few = bpe.Pairs(ranks), bpe.Pairs(ranks, 50)
    for _ in range(2_000):
        pair = rng.randrange(300) << 32 | rng.randrange(300)
        assert few[pair] == pairs[pair] and len(few) <= 50


def test_long_texts_are_cut_in_parts_and_joined_without_python(spark, known):
    data = [(i, f"{i} thé 中 " * 40_000) for i in range(12)]
    sizes = [len(out) for out in bpe._chunks(30_000, 500).func(iter([pa.array([t for _, t in data])]))]
    assert sum(sizes) == 12 and max(sizes) < 12
    docs = spark.createDataFrame(data, "uid string, text string").coalesce(1)
    out = bpe.encode_long(docs, RANKS, PATTERN, 30_000, 500)
    assert "InPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert {int(r.uid): ids(r.ids) for r in out.collect()} == {i: known.encode_ordinary(t) for i, t in data}
