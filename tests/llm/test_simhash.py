import random

import numpy as np
import pytest
import xxhash
from edges import frame, rows, words

from grainmill.llm import simhash
from grainmill.llm.components import components


def plain_fingerprint(text, n=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + n]), 42) for i in range(max(1, len(found) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, k):
    """The least index of each value's group, by comparing all pairs."""
    group = list(range(len(values)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= k:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def clustered(seed, centres, around, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(around):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, flips)):
                value ^= 1 << bit
            out.add(value)
    return sorted(out)


@pytest.mark.parametrize("k", [0, 1, 3, 4])
def test_trie_join_equals_all_pairs(k):
    bits = np.array(clustered(k, 25, 12, 6), np.uint64)
    whole = np.array([[0, len(bits), 0, len(bits), 0, 0]])
    root = simhash.trie_join(bits, whole, k)
    assert root.tolist() == plain_groups([int(b) for b in bits], k)


@pytest.mark.parametrize("limit", [50_000, 8])
def test_links_lose_nothing(spark, limit):
    """Also where block values are so crowded that they are cut further."""
    values = clustered(5, 6, 40, 5)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), 4, limit)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in found.collect()]
    at = {v: i for i, v in enumerate(values)}
    group = list(range(len(values)))
    for _ in values:
        for a, b in pairs:
            group[at[a]] = group[at[b]] = min(group[at[a]], group[at[b]])
    assert group == plain_groups(values, 4)
    assert all(bin(a ^ b).count("1") <= 64 for a, b in pairs) and len(pairs) <= 5 * len(values) * (1 if limit > 8 else 99)


def test_edge_rows(spark):
    data = rows()
    got = simhash.near_duplicates(frame(spark)).collect()
    prints = [plain_fingerprint(r[1]) for r in data]
    groups = plain_groups(prints, 4)
    least = {}
    for r, g in zip(data, groups):
        least[g] = min([x for x in (least.get(g), r[0]) if x is not None], default=None)
    expect = [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(data, prints, groups)]
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={a}, fingerprint='{b}', component_id={c})" for a, b, c in expect)


def test_one_row_of_each_group_stays(spark):
    docs = frame(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 3, 5, 7, None} <= set(ids) and not {1, 2, 6} & set(ids)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []


def test_many_copies_make_few_links(spark):
    data = [(i, words(9, 60) + f" tail{i % 7}") for i in range(300)]
    got = simhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    prints = [plain_fingerprint(t) for _, t in data]
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(plain_groups(prints, 4)))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
