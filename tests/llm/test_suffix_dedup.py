import random

import numpy as np
import pandas as pd
import pytest
from edges import frame, rows, words

from grainmill.llm import suffix_dedup


def plain(texts, length):
    """Kept bytes and removed spans of each text, from a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])))
        spans = [tuple(map(int, s)) for s in edge.reshape(-1, 2)]
        out.append((bytes(b for b, g in zip(d, gone) if not g), spans))
    return out


def mixed(seed):
    rng = random.Random(seed)
    parts = [words(100 + i, rng.randint(3, 12)) for i in range(12)] + ["=" * 40, "abab" * 12, "é" * 25]
    return ["".join(rng.choices(parts, k=rng.randint(0, 8))) + words(seed * 50 + i, rng.randint(0, 8)) for i in range(40)]


@pytest.mark.parametrize(("seed", "length", "shard"), [(1, 30, 20_000), (2, 30, 2), (3, 64, 3), (4, 8, 5)])
def test_equals_the_table_of_all_strings(spark, seed, length, shard):
    texts = mixed(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, length=length, shard_contexts=shard).collect()
    expect = plain(texts, length)
    assert len(got) == len(texts)
    for r in got:
        assert (bytes(r.kept_bytes), [tuple(s) for s in r.removed_spans]) == expect[r.doc_id], r.doc_id


@pytest.mark.parametrize("seed", [1, 4])
def test_shards_of_few_bytes(spark, seed):
    texts = mixed(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expect = plain(texts, 30)
    for r in suffix_dedup.remove_repeats(docs, length=30, shard_bytes=100).collect():
        assert (bytes(r.kept_bytes), [tuple(s) for s in r.removed_spans]) == expect[r.doc_id], r.doc_id


def test_suffix_arrays_are_bounded_by_bytes(monkeypatch):
    """4 MB of contexts in groups of 40 KB: one array at a time, far under 1 MB, and no row lost."""
    rng, sizes = random.Random(1), []
    text = [rng.randbytes(400) for _ in range(10_000)]
    rows = pd.DataFrame({"anchor": [i // 100 for i in range(len(text))], "shard": 0, "copies": 1, "bytes": text})
    rows["uid"], rows["at"] = rows.index, 0
    whole = suffix_dedup.repeated_starts

    def spy(texts, length):
        sizes.append(sum(map(len, texts)))
        return whole(texts, length)

    monkeypatch.setattr(suffix_dedup, "repeated_starts", spy)
    assert not sum(map(len, suffix_dedup._shard_repeats(200)([rows])))
    assert sum(sizes) == 4_000_000 and max(sizes) <= 1 << 20


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices("ab", k=rng.randint(1, 60))).encode() for _ in range(12)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    starts = np.cumsum(size) - size
    ends = np.repeat(starts + size, size)
    order, _ = suffix_dedup.suffix_array(data, ends, int(size.max()))
    suffix = [bytes(data[i : ends[i]]) for i in range(len(data))]
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (suffix[i], i))
    shared = suffix_dedup.common_prefixes(data, starts, ends, order)
    for a, b in zip(order, order[1:]):
        n = next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b])) if x != y), min(len(suffix[a]), len(suffix[b])))
        assert shared[b] == n


def test_long_text_in_blocks(spark):
    part = words(5, 40_000)
    texts = [part + words(6, 50), words(7, 30) + part[1_000:9_000], "y" * 150_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expect = plain(texts, 200)
    for r in suffix_dedup.remove_repeats(docs).collect():
        assert (bytes(r.kept_bytes), [tuple(s) for s in r.removed_spans]) == expect[r.doc_id]


def test_edge_rows_and_empty_table(spark):
    docs = frame(spark)
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == [*docs.columns, "removed_spans", "kept_bytes"]
    expect = sorted((repr(r[0]), k) for r, (k, _) in zip(rows(), plain([r[1] for r in rows()], 200)))
    assert sorted((repr(r.doc_id), bytes(r.kept_bytes)) for r in got.collect()) == expect
    assert sum(r.text is None for r in got.collect()) == 1
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
