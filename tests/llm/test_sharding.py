import zlib

import numpy as np
import pytest
from edges import frame, rows

from grainmill.llm import queries, sharding
from tools.check import compare, connect


def plain_jump(key, shards):
    key, at, ahead = key % 2**64, -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 40, 1000])
def test_jump_hash(shards):
    keys = np.concatenate([np.arange(-500, 500), np.array([2**63 - 1, -(2**63)])])
    assert sharding.jump_hash(keys.view(np.uint64), shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_one_more_shard_takes_rows_only_into_itself():
    keys = np.arange(20_000).view(np.uint64)
    old, new = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert set(new[old != new]) == {40} and 0.015 < (old != new).mean() < 0.035


@pytest.mark.parametrize("slot_rows", [100_000, 3])
def test_edge_rows(spark, slot_rows):
    data = rows()
    got = sharding.assign(frame(spark), 4, slot_rows=slot_rows).collect()
    expect = sorted(
        (str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode()), "key",
         plain_jump(-1 if r[0] is None else r[0], 4), plain_jump(-1 if r[0] is None else r[0], 5))
        for r in data
    )
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expect
    for s in range(4):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))


@pytest.mark.parametrize("slot_rows", [7, 2])
def test_slots_follow_the_key_and_stand_a_hot_one(spark, slot_rows):
    data = [(5, f"t{i}") for i in range(60)] + [(i, "x") for i in range(100)] + [(None, "n")] * 3
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = sharding.assign(docs, 3, slot_rows=slot_rows).collect()
    assert len(got) == len(data)
    for s in range(3):
        mine = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        keys = [-1 if r.doc_id is None else r.doc_id for r in mine]
        assert keys == sorted(keys)


def test_keys_of_text(spark):
    docs = spark.createDataFrame([(f"id-{i % 50}", f"t{i}") for i in range(120)] + [(None, "x")], "doc_id string, text string")
    got = sharding.assign(docs, 7).collect()
    assert len(got) == 121 and all(r.grown_shard in (r.shard, 7) for r in got)
    assert len({(r.doc_id, r.shard) for r in got}) == 51 and len({r.shard for r in got}) == 7
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_empty_table(spark):
    assert sharding.assign(frame(spark, []), 40).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(frame(spark), 0)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    sql = queries.oracle_sql()["op10_sharding"]
    assert compare(queries.op10_sharding(spark, folder), connect(folder), sql) == ""
