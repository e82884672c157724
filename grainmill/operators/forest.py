"""Random forests of a grid search, grown over rows that are binned and counted once.

The method is that of Spark ML's forest: binned features, a Poisson bootstrap, one pass over the rows per
level of all trees, the split of the largest gain. What its fits repeat is done once here:

* Rows of equal fold, class and bins are stored once, with their number n. How often a tree sees them is a
  Poisson variable of mean n, which is what n draws of mean 1 add up to.
* The forests of all folds and points advance together, so a level of all of them is one pass.
* A tree's draws follow from its number. Trees of one number that are equal so far, in forests of other points
  or folds, share a pass's sums of each block; their splits are looked for apart.

Draws and subsets of features come from the content of a block of rows, a tree's number and a node's place,
so a task that runs again repeats them. Cuts of the features come from all rows that are given, without labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from hashlib import md5
from math import ceil, log2, nan, sqrt
from sys import modules

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from grainmill.session import materialise

register_pickle_by_value(modules[__name__])  # executors need not have this package

BLOCK_ROWS = 1 << 16
PART_ROWS = 1 << 20  # before rows of equal bins are counted
CELLS = 1 << 23  # sums that a task holds at once, of 8 bytes
FEW = 8  # cells a row, beyond which sums are added cell by cell
MOST_CLASSES = 100  # as Spark ML has it
PURE = 2.0**-52
NO_FOLD = -1


@dataclass(frozen=True)
class Blocks:
    """Binned rows: per row of ``table`` one fold's rows of equal bins, some ten thousand of them."""

    table: DataFrame
    cuts: tuple[np.ndarray, ...]  # of each feature: bin b holds values up to cut b
    classes: int
    seed: int
    rows: Mapping[int, int]  # of each fold

    @property
    def shape(self) -> tuple[int, int, int]:
        """Features, bins and classes, as sums have them."""
        return len(self.cuts), 1 + max(map(len, self.cuts)), self.classes


@dataclass(frozen=True)
class Plan:
    """A forest to grow: it leaves out ``fold`` and looks at ``subset`` features in a node."""

    fold: int
    impurity: str
    subset: int
    trees: int
    depth: int


@dataclass
class Tree:
    """Nodes by number: a leaf has feature -1, other nodes their right child after the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    place: list[int] = field(default_factory=lambda: [1])  # as in a heap; its bits tell the depth
    stats: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])  # weight of each class

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for side, stats in enumerate((left, self.stats[node] - left)):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.gain.append(0.0)
            self.place.append(2 * self.place[node] + side)
            self.stats.append(stats)
        return first, first + 1

    def pruned(self) -> Tree:
        """Two leaves of the same class become one, as in Spark ML."""
        feature = list(self.feature)
        says = [int(np.argmax(s)) for s in self.stats]
        for node in range(len(feature) - 1, -1, -1):  # children come after their parents
            if feature[node] >= 0:
                a, b = self.left[node], self.left[node] + 1
                if feature[a] < 0 and feature[b] < 0 and says[a] == says[b]:
                    feature[node] = -1
        return Tree(feature, self.cut, self.left, self.gain, self.place, self.stats)


def impurity_of(stats: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy in bits over the last axis; 0 where there is no weight."""
    weight = stats.sum(-1, keepdims=True)
    share = stats / np.where(weight > 0, weight, 1.0)
    if kind == "gini":
        return np.where(weight[..., 0] > 0, 1.0 - (share * share).sum(-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1.0))).sum(-1)


def features_per_node(strategy: str, trees: int, features: int) -> int:
    """Spark ML's reading of ``featureSubsetStrategy`` for a classifier."""
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {
        "all": features, "sqrt": ceil(sqrt(features)), "log2": max(1, ceil(log2(features))), "onethird": ceil(features / 3),
    }
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else ceil(float(strategy) * features)


# -- rows to blocks ------------------------------------------------------------


def _feature_cuts(rows: DataFrame, names: Sequence[str], max_bins: int, facts: Row) -> tuple[np.ndarray, ...]:
    """Between all values of a feature that has no more than ``max_bins``, else its quantiles."""
    # The estimate is off by a few percent, so the features that may have few values are counted exactly.
    few = [n for n in names if facts[f"{n}_values"] <= 2 * max_bins]
    found = rows.agg(*[F.collect_set(n).alias(n) for n in few]).first() if few else {}
    out = []
    for name in names:
        values = np.unique(found[name]) if name in few else None
        if values is not None and len(values) <= max_bins:
            below, above = values[:-1], values[1:]
            with np.errstate(invalid="ignore", over="ignore"):
                between = below + (above - below) / 2
            out.append(np.where((between >= below) & (between < above), between, below))
        else:
            out.append(np.unique(facts[f"{name}_cuts"]))
    return tuple(out)


def _binned(cuts: Sequence[np.ndarray], bin_type: np.dtype) -> Callable:
    width = len(cuts) * bin_type.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            bins = np.empty((n, len(cuts)), bin_type)
            for j, cut in enumerate(cuts):
                bins[:, j] = np.searchsorted(cut, batch.column(2 + j).to_numpy(zero_copy_only=False))
            ends = np.arange(n + 1, dtype=np.int64) * width
            packed = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(bins.tobytes())]
            )
            yield pa.record_batch([batch.column(0), batch.column(1), packed], ["fold", "label", "bins"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their fold to one row per block."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        labels, counts = (np.concatenate([h[k] for h in held]) for k in (1, 3))
        values = [held[0][0], int(counts.sum()), labels.astype(np.uint8).tobytes(), b"".join(h[2] for h in held), counts.tobytes()]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], ["fold", "rows", "labels", "bins", "counts"])

    for batch in batches:
        folds = batch.column("fold").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(folds)) + 1).tolist(), len(folds)]
        for first, end in zip(edges, edges[1:]):
            for a in range(first, end, BLOCK_ROWS):
                part = batch.slice(a, min(end - a, BLOCK_ROWS))
                if held and (held[0][0] != folds[a] or sum(len(h[1]) for h in held) + part.num_rows > BLOCK_ROWS):
                    yield block()
                    held = []
                bins = b"".join(part.column("bins").to_pylist())
                held.append((int(folds[a]), part.column("label").to_numpy(), bins, part.column("n").to_numpy()))
    if held:
        yield block()


def blocks_of(
    train: DataFrame, features: Sequence[str], label: str, fold: Column, folds: int, max_bins: int, seed: int
) -> Blocks:
    """``train`` as blocks; rows that lack the label or a feature are left out."""
    names = [f"f_{j}" for j in range(len(features))]
    values = [F.col(f).cast("double").alias(n) for f, n in zip(features, names)]
    rows = train.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), fold.alias("fold"), *values)
    for name in names:
        rows = rows.where(F.col(name).isNotNull() & ~F.isnan(name))
    levels = [i / max_bins for i in range(1, max_bins)]
    facts = rows.agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count_if(F.col("label") != F.floor("label")).alias("odd"),
        F.count("*").alias("n"), *[F.approx_count_distinct(n).alias(f"{n}_values") for n in names],
        *[F.percentile_approx(n, levels, 10_000).alias(f"{n}_cuts") for n in names],
    ).first()
    if not facts["n"]:
        raise ValueError("no row has a label and all features")
    if not (facts["least"] >= 0 and facts["most"] < MOST_CLASSES and not facts["odd"]):
        raise ValueError(f"labels are whole numbers from 0 to {MOST_CLASSES - 1}, not from {facts['least']} to {facts['most']}")
    cuts = _feature_cuts(rows, names, max_bins, facts)
    bin_type = _bin_type(cuts)
    binned = rows.select("fold", F.col("label").cast("int").alias("label"), *names).mapInArrow(
        _binned(cuts, bin_type), "fold int, label int, bins binary"
    )
    keys = ["fold", "label", "bins"]
    counted = binned.groupBy(*keys).agg(F.count("*").alias("n"))
    # As many files for each core, so that a scan deals them out evenly.
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = cores * ceil(facts["n"] / (cores * PART_ROWS))
    table = counted.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        _packed, "fold int, rows long, labels binary, bins binary, counts binary"
    )
    stored = materialise(table, "blocks")
    by_fold = {r["fold"]: r["n"] for r in stored.groupBy("fold").agg(F.sum("rows").alias("n")).collect()}
    return Blocks(stored, cuts, int(facts["most"]) + 1, seed, {f: by_fold.get(f, 0) for f in range(folds)})


def _bin_type(cuts: Sequence[np.ndarray]) -> np.dtype:
    return np.dtype(np.uint8 if max(map(len, cuts)) < 1 << 8 else np.uint16 if max(map(len, cuts)) < 1 << 16 else np.uint32)


@dataclass
class _Block:
    """One block on an executor."""

    fold: int
    labels: np.ndarray
    bins: np.ndarray  # of all rows, feature by feature within a row
    counts: np.ndarray
    key: int

    def draws(self, seed: int, tree: int) -> np.ndarray:
        """How often tree number ``tree`` sees each row."""
        return np.random.default_rng([seed % 2**64, tree, self.key]).poisson(self.counts).astype(float)


def _read(batches: Iterator[pa.RecordBatch], bin_type: np.dtype, features: int) -> Iterator[_Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            fold, _, labels, bins, counts = (batch.column(c)[k].as_py() for c in range(5))
            # The first row tells blocks apart, for no two have an equal one.
            first = md5(f"{fold}-{labels[0]}-".encode() + bins[: features * bin_type.itemsize]).digest()
            yield _Block(
                fold, np.frombuffer(labels, np.uint8).astype(np.int64), np.frombuffer(bins, bin_type),
                np.frombuffer(counts, np.int64), int.from_bytes(first, "big"),
            )


def _fall(block: _Block, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> Iterator[tuple]:
    """Rows and the leaves they reach, those of one depth at a time."""
    node = np.zeros(len(rows), np.int64)
    width = len(block.bins) // len(block.labels)
    while len(rows):
        asked = feature[node]
        leaf = asked < 0
        if leaf.all():
            yield rows, node
            return
        if leaf.any():
            yield rows[leaf], node[leaf]
            rows, node, asked = rows[~leaf], node[~leaf], asked[~leaf]
        node = left[node] + (block.bins[rows * width + asked] > cut[node])


# -- growing -------------------------------------------------------------------


def _level_sums(job, bin_type: np.dtype, shape: tuple[int, int, int], seed: int, slots: int, per_piece: int) -> Callable:
    """Weights by node, feature, bin and class: a row per task and piece of the nodes, with the cells if only some are met."""
    features, bins, classes = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for block in _read(batches, bin_type, features):
            if sums is None:
                sums = np.zeros((slots, features, bins, classes))
            cells = [block.bins[j::features].astype(np.int64) * classes + block.labels for j in range(features)]
            for tree, routes in job.value:
                users = [(route, [at for fold, at in used if fold != block.fold]) for route, used in routes]
                if not any(used for _, used in users):
                    continue
                draws = block.draws(seed, tree)
                seen = np.flatnonzero(draws)
                for (feature, cut, left, slot, n), used in users:
                    if not used:
                        continue
                    reached = [(rows, slot[node]) for rows, node in _fall(block, seen, feature, cut, left)]
                    if not reached:
                        continue
                    rows, at = map(np.concatenate, zip(*reached))
                    rows, at = rows[at >= 0], at[at >= 0]
                    weights, own = draws[rows], bins * classes
                    for j in range(features):
                        if len(rows) * FEW < n * own:  # few cells are met
                            to = at * (features * own) + j * own + cells[j][rows]
                            for base in used:
                                np.add.at(sums.reshape(-1)[base * features * own :], to, weights)
                            continue
                        added = np.bincount(at * own + cells[j][rows], weights, n * own).reshape(n, bins, classes)
                        for base in used:
                            sums[base : base + n, j] += added
        if sums is not None:
            for piece, a in enumerate(range(0, slots, per_piece)):
                flat = sums[a : a + per_piece].reshape(-1)
                met = np.flatnonzero(flat)
                met = met.astype(np.int32) if 12 * len(met) < flat.nbytes else None
                values = [piece, None if met is None else met.tobytes(), (flat if met is None else flat[met]).tobytes()]
                kinds = [pa.int32(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], ["piece", "cells", "sums"])

    return run


def best_splits(sums: np.ndarray, kind: str, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each node the feature, cut and gain of its best split, and the classes' weights left of it and in all."""
    whole = sums[:, 0].sum(1)
    left = sums.cumsum(2)[:, :, :-1]
    right = whole[:, None, None] - left
    n, n_left, n_right = whole.sum(-1), left.sum(-1), right.sum(-1)
    share = np.where(n > 0, n, 1.0)[:, None, None]
    lost = (n_left * impurity_of(left, kind) + n_right * impurity_of(right, kind)) / share
    gain = impurity_of(whole, kind)[:, None, None] - lost
    gain = np.where((n_left >= 1) & (n_right >= 1) & allowed[:, :, None], gain, -np.inf)
    if not gain.shape[2]:  # no feature has a cut
        none = np.zeros(len(sums), np.int64)
        return none, none, none - np.inf, whole * 0, whole
    best = gain.reshape(len(sums), -1).argmax(1)
    feature, cut = np.divmod(best, gain.shape[2])
    row = np.arange(len(sums))
    return feature, cut, gain[row, feature, cut], left[row, feature, cut], whole


def _splitter(rules, shape: tuple[int, int, int], per_piece: int) -> Callable:
    """Adds up the tasks' sums of a piece and splits its nodes."""

    def run(table: pa.Table) -> pa.Table:
        piece = table.column("piece")[0].as_py()
        kinds, allowed = (r[piece * per_piece :][:per_piece] for r in rules.value)
        sums = np.zeros((len(kinds), *shape))
        flat = sums.reshape(-1)
        for cells, part in zip(table.column("cells"), table.column("sums")):
            part = np.frombuffer(part.as_buffer(), float)
            if cells.is_valid:
                flat[np.frombuffer(cells.as_buffer(), np.int32)] += part
            else:
                flat += part
        out = []
        for kind in np.unique(kinds):
            at = np.flatnonzero(kinds == kind)
            feature, cut, gain, left, whole = best_splits(sums[at], str(kind), allowed[at])
            out.append((at + piece * per_piece, feature, cut, gain, left, whole))
        slot, feature, cut, gain, left, whole = (np.concatenate(part) for part in zip(*out))
        return pa.table(
            {
                "slot": pa.array(slot, pa.int32()), "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32()),
                "gain": pa.array(gain, pa.float64()), "left": pa.array(left.tolist(), pa.list_(pa.float64())),
                "whole": pa.array(whole.tolist(), pa.list_(pa.float64())),
            }
        )

    return run


def _drawn(seed: int, numbers: Sequence[int], places: Sequence[int], subsets: Sequence[int], features: int) -> np.ndarray:
    """Which features each node may use: those of the smallest hashes (SplitMix64) of seed, tree, place and feature."""

    def mix(x: np.ndarray) -> np.ndarray:
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    tree = mix(mix(np.array([seed % 2**64], np.uint64)) ^ np.array(numbers, np.uint64))
    hashed = mix(mix(tree ^ np.array(places, np.uint64))[:, None] ^ np.arange(features, dtype=np.uint64))
    return hashed.argsort(1).argsort(1) < np.array(subsets)[:, None]


def _split_nodes(blocks: Blocks, plans: Sequence[Plan], trees: Mapping, nodes: Sequence[tuple]) -> list:
    """One pass over the rows: for each (tree number, plan, node) what ``Tree.split`` takes, the weights and which sides are mixed."""
    sc = blocks.table.sparkSession.sparkContext
    features = blocks.shape[0]
    starts: dict[tuple, int] = {}
    own: dict[tuple, list[int]] = {}
    for slot, (number, plan, node) in enumerate(nodes):
        starts.setdefault((number, plan), slot)
        own.setdefault((number, plan), []).append(node)
    routes: dict[int, dict] = {}
    for (number, plan), some in own.items():
        tree = trees[number, plan]
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[some] = np.arange(len(some))
        route = (*(np.array(x, np.int64) for x in (tree.feature, tree.cut, tree.left)), slot, len(some))
        same = tuple(x.tobytes() for x in route[:4])
        routes.setdefault(number, {}).setdefault(same, (route, []))[1].append((plans[plan].fold, starts[number, plan]))
    places = [trees[number, plan].place[node] for number, plan, node in nodes]
    allowed = _drawn(blocks.seed, [n for n, _, _ in nodes], places, [plans[p].subset for _, p, _ in nodes], features)
    kinds = np.array([plans[plan].impurity for _, plan, _ in nodes])
    per_piece = ceil(len(nodes) / (2 * sc.defaultParallelism))
    job = sc.broadcast([(number, list(same.values())) for number, same in routes.items()])
    rules = sc.broadcast((kinds, allowed))
    sums = _level_sums(job, _bin_type(blocks.cuts), blocks.shape, blocks.seed, len(nodes), per_piece)
    found = (
        blocks.table.mapInArrow(sums, "piece int, cells binary, sums binary")
        .groupBy("piece")
        .applyInArrow(
            _splitter(rules, blocks.shape, per_piece),
            "slot int, feature int, cut int, gain double, left array<double>, whole array<double>",
        )
        .toArrow()
        .sort_by("slot")
    )
    job.destroy()
    rules.destroy()
    feature, cut, gain = (found.column(c).to_pylist() for c in ("feature", "cut", "gain"))
    left, whole = (np.array(found.column(c).to_pylist()) for c in ("left", "whole"))
    # Which children are to be split further, left and right.
    mixed = np.zeros((len(nodes), 2), bool)
    for kind in set(kinds.tolist()):
        some = kinds == kind
        mixed[some] = np.stack([impurity_of(x[some], kind) >= PURE for x in (left, whole - left)], 1)
    return list(zip(feature, cut, gain, left, whole, mixed.tolist(), strict=True))


def grow(blocks: Blocks, plans: Sequence[Plan]) -> list[list[Tree]]:
    """The trees of each plan, in order of their numbers; all plans grow level by level together."""
    trees = {(t, p): Tree() for p, plan in enumerate(plans) for t in range(plan.trees)}
    open_nodes = [(t, p, 0) for t, p in sorted(trees)]
    at_once = max(1, CELLS // int(np.prod(blocks.shape)))
    while open_nodes:
        following = []
        for a in range(0, len(open_nodes), at_once):
            nodes = open_nodes[a : a + at_once]
            for (t, p, node), found in zip(nodes, _split_nodes(blocks, plans, trees, nodes), strict=True):
                feature, cut, gain, left, whole, mixed = found
                tree, depth = trees[t, p], trees[t, p].place[node].bit_length() - 1
                if not node:
                    tree.stats[0] = whole
                if gain > 0 and depth < plans[p].depth:
                    children = tree.split(node, feature, cut, gain, left)
                    if depth + 1 < plans[p].depth:
                        following += [(t, p, child) for child, go_on in zip(children, mixed) if go_on]
        open_nodes = sorted(following)
    return [[trees[t, p].pruned() for t in range(plan.trees)] for p, plan in enumerate(plans)]


# -- what a forest says --------------------------------------------------------


def _shares(tree: Tree) -> tuple[np.ndarray, ...]:
    stats = np.array(tree.stats)
    weight = stats.sum(1, keepdims=True)
    return *(np.array(x, np.int64) for x in (tree.feature, tree.cut, tree.left)), stats / np.where(weight > 0, weight, 1.0)


def _right_rows(job, bin_type: np.dtype, features: int) -> Callable:
    """Rows of the fold left out whose class a forest predicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, bin_type, features):
            rows = np.arange(len(block.labels))
            points, right = [], []
            for point, fold, trees in job.value:
                if fold != block.fold:
                    continue
                votes = 0.0
                for feature, cut, left, share in trees:
                    leaf = np.empty(len(rows), np.int64)
                    for some, node in _fall(block, rows, feature, cut, left):
                        leaf[some] = node
                    votes = votes + share[leaf]
                points.append(point)
                right.append(int(block.counts[votes.argmax(1) == block.labels].sum()))
            folds = pa.array([block.fold] * len(points), pa.int32())
            yield pa.record_batch([folds, pa.array(points, pa.int32()), pa.array(right, pa.int64())], ["fold", "point", "right"])

    return run


def java_trees(spark: SparkSession, trees: Sequence[Tree], blocks: Blocks, kind: str):
    """The trees as Spark ML's forest model has them."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    nodes, impurities = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity
    calculator = impurities.GiniCalculator if kind == "gini" else impurities.EntropyCalculator
    models = jvm.org.apache.spark.ml.classification
    out = gateway.new_array(models.DecisionTreeClassificationModel, len(trees))
    for k, tree in enumerate(trees):

        def node(i: int):
            stats = tree.stats[i]
            weights = gateway.new_array(jvm.double, len(stats))
            for c, weight in enumerate(stats):
                weights[c] = float(weight)
            own = calculator(weights, int(stats.sum()))
            says, impurity = float(np.argmax(stats)), float(impurity_of(stats, kind))
            if tree.feature[i] < 0:
                return nodes.LeafNode(says, impurity, own)
            split = nodes.ContinuousSplit(tree.feature[i], float(blocks.cuts[tree.feature[i]][tree.cut[i]]))
            left, right = node(tree.left[i]), node(tree.left[i] + 1)
            return nodes.InternalNode(says, impurity, float(tree.gain[i]), left, right, split, own)

        out[k] = models.DecisionTreeClassificationModel(node(0), len(blocks.cuts), blocks.classes)
    return out


def search(blocks: Blocks, points: Sequence[RandomForestClassifier]) -> list[list[float]]:
    """For each fold the accuracy of every point's forest, grown on the other folds' rows, on the fold's own; NaN without any."""
    folds, features = sorted(blocks.rows), blocks.shape[0]
    whole = sum(blocks.rows.values())
    for fold in folds:
        if blocks.rows[fold] == whole:
            raise ValueError(f"The training data at fold {fold} is empty.")
    tried = [(k, _plan(point, fold, features)) for fold in folds for k, point in enumerate(points)]
    grown = grow(blocks, [plan for _, plan in tried])
    forests = [(k, plan.fold, [_shares(t) for t in trees]) for (k, plan), trees in zip(tried, grown, strict=True)]
    job = blocks.table.sparkSession.sparkContext.broadcast(forests)
    right = blocks.table.mapInArrow(_right_rows(job, _bin_type(blocks.cuts), features), "fold int, point int, right long")
    found = {(r["fold"], r["point"]): r["n"] for r in right.groupBy("fold", "point").agg(F.sum("right").alias("n")).collect()}
    job.destroy()
    return [[found[f, k] / blocks.rows[f] if blocks.rows[f] else nan for k in range(len(points))] for f in folds]


def _plan(point: RandomForestClassifier, fold: int, features: int) -> Plan:
    subset = features_per_node(point.getFeatureSubsetStrategy(), point.getNumTrees(), features)
    return Plan(fold, point.getImpurity().lower(), subset, point.getNumTrees(), point.getMaxDepth())


def fit(blocks: Blocks, point: RandomForestClassifier) -> RandomForestClassificationModel:
    """The point's forest over the rows of all folds, as a Spark ML model."""
    spark = blocks.table.sparkSession
    plan = _plan(point, NO_FOLD, blocks.shape[0])
    (trees,) = grow(blocks, [plan])
    trees = java_trees(spark, trees, blocks, plan.impurity)
    made = spark._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel
    model = point._copyValues(point._create_model(made(point.uid, trees, len(blocks.cuts), blocks.classes)))
    model._transfer_params_to_java()
    return model
