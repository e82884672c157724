"""SimHash fingerprints, their links within a few bits, and the groups that links make.

Fingerprints at most k bits apart agree on one of k + 1 blocks of bits. So each distinct
fingerprint is dealt out k + 1 times, once by each block's value, and those that meet form a
binary trie over the other bits. The trie is joined with itself: pairs of nodes go down
together, one bit a level, the error budget falls by one where their bits differ, and a pair
over its budget is dropped with everything below it.

A task returns no pairs but one link from each fingerprint to the least of its group there, so a
group of n costs n rows. A block value that very many fingerprints share is cut by further bits,
and pairs of such nodes within the budget become tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from grainmill.llm.components import components
from grainmill.session import materialise

SHINGLE = 4
MAX_BITS = 4
BITS = 64
NODE_LIMIT = 50_000  # fingerprints under one block value beyond which it is cut by further bits
RUN = 100_000  # fingerprints joined at once in a task, in whole groups
FRONTIER = 1 << 19  # node pairs held at once
LEAF = 64  # pairs of leaves below two nodes that are compared at once


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))], np.uint64
    )
    ones, step = np.zeros(BITS, np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        octets = hashes[at : at + step].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """64 bits as a signed long: a bit is set if it is in over half of the shingles' XXH64 values.

    Words are lower-cased (A-Z) and joined by single spaces, repeats count, and a text of fewer
    words is one shingle. Null texts and those without words get zero.
    """

    @F.arrow_udf("long")
    def score(texts: pa.Array) -> pa.Array:
        out = [fingerprint_of((t.as_py() or "").encode(), shingle) for t in texts]
        return pa.array(np.array(out, np.uint64).view(np.int64))

    return score(text)


def blocks(k: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the k + 1 blocks, counted from the highest bit."""
    edges = [round(i * BITS / (k + 1)) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _rotated(value: str, first: int) -> str:
    """SQL for the bits turned so that bit ``first`` from the top leads."""
    if not first:
        return value
    return f"shiftleft({value}, {first}) | shiftrightunsigned({value}, {BITS - first})"


class Forest:
    """Leaves with a group number each; groups join where a link is found."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above


def _one_group(forest: Forest, a0, a1, b0, b1) -> np.ndarray:
    """Whether all leaves under both nodes of a pair are in one group already."""
    change = np.concatenate([[0], np.cumsum(forest.root[1:] != forest.root[:-1])])
    same = (change[a1 - 1] == change[a0]) & (change[b1 - 1] == change[b0])
    return same & (forest.root[a0] == forest.root[b0])


def trie_join(bits: np.ndarray, pairs: np.ndarray, k: int) -> np.ndarray:
    """The group (least index) of each leaf, when those at most ``k`` bits apart are linked.

    ``bits``: the leaves, sorted within each node. ``pairs``: rows (start, end, start, end,
    errors, depth) of nodes to be joined, as ranges of leaves; a node with itself is a row too.
    The join runs with half the budget first: it links most of a dense group, and the second run
    drops node pairs that lie in one group already.
    """
    n = len(bits)
    forest = Forest(n)
    ones = [
        np.concatenate([[0], np.cumsum((bits >> np.uint64(BITS - 1 - d)) & np.uint64(1), dtype=np.int64)])
        for d in range(BITS)
    ]
    for budget in sorted({k // 2, k}):
        stack = [pairs]
        while stack:
            now = stack.pop()
            if len(now) > FRONTIER:
                stack += [now[: len(now) // 2], now[len(now) // 2 :]]
                continue
            a0, a1, b0, b1, err, depth = now.T
            alone = (a0 == b0) & (a1 - a0 < 2)
            keep = (err <= budget) & (a1 > a0) & (b1 > b0) & ~alone
            keep[keep] = ~_one_group(forest, a0[keep], a1[keep], b0[keep], b1[keep])
            now = now[keep]
            if not len(now):
                continue
            a0, a1, b0, b1, err, depth = now.T
            few = ((a1 - a0) * (b1 - b0) <= LEAF) | (depth >= BITS)
            _compare(forest, bits, now[few], budget)
            now = now[~few]
            for d in np.unique(now[:, 5]):
                stack.append(_descend(now[now[:, 5] == d], ones[d]))
    return forest.root


def _descend(now: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The pairs of children of each node pair, a bit further down."""
    a0, a1, b0, b1, err, depth = now.T
    am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
    deeper = depth + 1
    own = (a0 == b0) & (a1 == b1)
    out = [
        (a0, am, b0, bm, err, deeper),
        (am, a1, bm, b1, err, deeper),
        (a0, am, bm, b1, err + 1, deeper),
    ]
    rows = np.concatenate([np.stack(x, 1) for x in out])
    other = ~own
    crossed = np.stack([am, a1, b0, bm, err + 1, deeper], 1)[other]
    return np.concatenate([rows, crossed])


def _compare(forest: Forest, bits: np.ndarray, now: np.ndarray, budget: int) -> None:
    """Link the leaves under small node pairs that are within the budget."""
    step = max(1, (1 << 21) // LEAF)
    for at in range(0, len(now), step):
        a0, a1, b0, b1, _, _ = now[at : at + step].T
        wide = b1 - b0
        size = (a1 - a0) * wide
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        a, b = a0[row] + place // wide[row], b0[row] + place % wide[row]
        near = np.bitwise_count(bits[a] ^ bits[b]) <= budget
        forest.link(a[near], b[near])


def group_links(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """(a, b) links from each fingerprint to the least one of its group, for whole tasks' rows.

    Rows hold: block, its value, cut, side and mask (see ``links``), the turned bits, fp.
    """
    bits = rows["bits"].to_numpy().view(np.uint64)
    keys = rows[["block", "value", "node", "mask"]].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    ends = np.append(starts[1:], len(keys))
    mask = rows["mask"].to_numpy()[starts]
    side = np.concatenate([[0], np.cumsum(rows["side"].to_numpy())])
    middle = ends - (side[ends] - side[starts])  # rows of side 0 come first
    own = mask == 0
    zero = np.zeros(len(starts), np.int64)
    top = np.bitwise_count(mask.astype(np.uint64)).astype(np.int64)
    depth = rows["depth"].to_numpy()[starts].astype(np.int64)
    pairs = np.stack(
        [starts, np.where(own, ends, middle), np.where(own, starts, middle), ends, np.where(own, zero, top), depth], 1
    )
    root = trie_join(bits, pairs, k)
    fp = rows["fp"].to_numpy()
    linked = root != np.arange(len(root))
    return pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]})


def _join_runs(k: int, run: int):
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= run:
                rows = pd.concat(held, ignore_index=True)
                key = rows[["block", "value", "node", "mask"]].to_numpy()
                new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
                if len(new):
                    yield group_links(rows.iloc[: new[-1]], k)
                    held = [rows.iloc[new[-1] :]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            if len(rows):
                yield group_links(rows, k)

    return join


def links(fps: DataFrame, k: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) that join all distinct ``fp`` at most ``k`` bits apart, directly or in steps.

    A block value with more than ``node_limit`` fingerprints is cut by its next bits, 2 to 12 by
    its size. Each of its nodes then meets itself and each node that differs in up to k of these
    bits (``mask``), which is the trie join's own upper part done by Spark.
    """
    if not 0 <= k <= 15:
        raise ValueError("between 0 and 15 bits")
    dealt = [
        f"struct({i} AS block, shiftrightunsigned({_rotated('fp', first)}, {BITS - wide}) AS value,"
        f" {wide} AS wide, {_rotated('fp', first)} AS bits)"
        for i, (first, wide) in enumerate(blocks(k))
    ]
    rows = fps.select("fp", F.explode(F.expr(f"array({', '.join(dealt)})")).alias("d")).select("fp", "d.*")
    crowded = rows.groupBy("block", "value").count().where(F.col("count") > node_limit)
    crowded = materialise(
        crowded.select(
            "block", "value", F.expr(f"int(least(12, ceil(log2(count / {node_limit})) + 1))").alias("cut")
        ),
        "crowded",
    )
    plain = rows.selectExpr("*", "0L AS node", "0L AS mask", "0 AS side", "wide AS depth")
    if crowded.head(1):
        cut = rows.join(crowded, ["block", "value"])
        cut = cut.withColumn("sub", F.expr("shiftrightunsigned(shiftleft(bits, wide), 64 - cut)"))
        masks = F.expr(f"filter(sequence(0L, shiftleft(1L, cut) - 1), m -> bit_count(m) <= {k})")
        cut = cut.withColumn("mask", F.explode(masks)).selectExpr(
            "fp", "block", "value", "wide", "bits", "least(sub, sub ^ mask) AS node", "mask",
            "int(sub > (sub ^ mask)) AS side", "wide + cut AS depth",
        )
        plain = plain.join(crowded.select("block", "value"), ["block", "value"], "left_anti").unionByName(cut)
    keys = ["block", "value", "node", "mask"]
    # Bits compare as signed; turning the top one makes their order the trie's.
    ordered = plain.repartition(*keys).sortWithinPartitions(*keys, "side", F.expr("bits ^ shiftleft(1L, 63)"))
    return ordered.select(*keys, "side", "depth", "bits", "fp").mapInPandas(_join_runs(k, RUN), "a long, b long")


def grouped(scored: DataFrame, max_bits: int, node_limit: int) -> DataFrame:
    """(fp, group, component_id) of stored (id, fp) rows: the group's least fingerprint and least id."""
    nodes = materialise(scored.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = components(links(nodes.select("fp"), max_bits, node_limit))
    found = found.select(F.col("node").alias("fp"), F.col("component").alias("group"))
    placed = nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("group", "fp").alias("group"))
    least = placed.groupBy("group").agg(F.min("least").alias("component_id"))
    return materialise(placed.join(least, "group").select("fp", "group", "component_id"), "named")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    node_limit: int = NODE_LIMIT,
) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 hex digits), ``component_id``.

    The component is the smallest key among the documents reached over links of at most
    ``max_bits`` differing bits. Documents without words, null texts too, have fingerprint zero
    and are linked like any others. Equal fingerprints are one node of the join. A null key takes
    part but is nobody's smallest; a component of null keys only has a null id. Other columns of
    ``docs`` are ignored. An empty table gives no rows.
    """
    scored = docs.select(F.col(key).alias("id"), fingerprints(F.coalesce(F.col(text), F.lit("")), shingle).alias("fp"))
    scored = materialise(scored, "fingerprints")
    named = grouped(scored, max_bits, node_limit)
    return scored.join(named, "fp").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    node_limit: int = NODE_LIMIT,
) -> DataFrame:
    """``docs`` with one row of each group of ``near_duplicates``: the one of the smallest key.

    Of several rows with that key one stays; null keys come last. Rows are stored with a number
    first, so that the row chosen is the row kept.
    """
    scored = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(key).alias("id"),
        fingerprints(F.coalesce(F.col(text), F.lit("")), shingle).alias("fp"),
        F.monotonically_increasing_id().alias("uid"),
    )
    scored = materialise(scored, "numbered")
    named = grouped(scored.select("id", "fp"), max_bits, node_limit)
    chosen = scored.select("id", "fp", "uid").join(named, "fp").groupBy("group")
    chosen = chosen.agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("least")).select("least.uid")
    kept = scored.join(chosen, "uid", "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
