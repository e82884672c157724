"""Removal of every byte covered by a long string that starts elsewhere too.

Where two strings of ``length`` bytes are equal, the least hash of their ``GRAM``-byte pieces is
at the same place in both. So each string is owned by the piece with its least hash (the anchor),
neighbouring strings of one anchor form a context, and equal strings always have anchors of equal
hash. Contexts whose anchor comes once in all documents hold nothing repeated and go no further.

Of contexts with a common anchor, equal ones are repeated as a whole. The others meet in shards:
each shard's suffix array is built by Larsson-Sadakane refinement, Kasai's common prefixes give
the strings that two suffixes share, and anchors with too many contexts, or too many bytes of them,
for one shard are dealt out over several, whose sorted strings are merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from grainmill.llm.text import _WEIGHT, _power, fresh, flat, mixed, slices
from grainmill.session import materialise

LENGTH = 200
GRAM = 48
BLOCK = 1 << 17  # starts of strings looked at together
SHARD_CONTEXTS = 20_000  # of one anchor in one shard
# A suffix array and its prefixes take some 160 times their bytes while they are made.
SHARD_BYTES = 1 << 20  # of one anchor's contexts in one shard
RUN_BYTES = 1 << 19  # of contexts in one suffix array, beyond one shard
_PLACE = np.uint64((1 << 18) - 1)


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` neighbouring hashes, the first of equal ones."""
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        keys = np.minimum(keys[:-step], keys[step:])
        span += step
    return (keys & _PLACE).astype(np.int64)


def contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(row, first start in the row, number of starts, anchor hash, context hash) of each context.

    ``data`` holds all rows' bytes, ``offsets`` where they begin. Rows shorter than ``length``
    have none. The context is the bytes of all its strings: starts + length - 1 of them.
    """
    gram = min(GRAM, length)
    found = []
    for begin in range(0, len(data), BLOCK):
        part = data[begin : begin + BLOCK + length - 1]
        starts = len(part) - length + 1
        if starts <= 0:
            break
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_WEIGHT[part] * _power("up", len(part)), out=sums[1:])
        down = _power("down", len(part))
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        place = _least_places(grams, length - gram + 1)
        row = np.searchsorted(offsets, np.arange(begin, begin + starts), "right") - 1
        fits = np.arange(begin, begin + starts) + length <= offsets[row + 1]
        new = np.ones(starts, bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        count = np.add.reduceat(fits.astype(np.int64), first)  # those that fit lead their run
        first, count = first[count > 0], count[count > 0]
        end = first + count + length - 1
        whole = mixed((sums[end] - sums[first]) * down[first])
        found.append((row[first], first + begin - offsets[row[first]], count, grams[place[first]], whole))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchor_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, at = batch.column(0).to_numpy(), 0
            for part in slices(batch.column(1)):
                row, start, n, anchor, whole = contexts(*flat(part), length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid[row + at]),
                        pa.array(start),
                        pa.array(n.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                    ],
                    names=["uid", "at", "n", "anchor", "context"],
                )
                at += len(part)

    return rows


def suffix_array(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and ranks of all suffixes by their first ``depth`` bytes; each stops at its own end.

    ``ends``: for every place, where its text ends. Larsson-Sadakane: sort by the first bytes, then
    by the rank of the suffix as far on as is sorted already, twice as far each time, and only
    within groups that are still equal.
    """
    n = len(data)
    key = np.zeros(n, np.int64)
    for i in range(7):  # seven bytes of nine bits, zero past the end
        byte = np.zeros(n, np.int64)
        byte[: n - i] = data[i:].astype(np.int64) + 1
        byte[np.arange(n) + i >= ends] = 0
        key = (key << 9) | byte
    order = np.argsort(key, kind="stable")
    sorted_keys = key[order]
    first = np.ones(n, bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    h = 7
    while h < depth:
        alone = first & np.append(first[1:], True)
        slot = np.flatnonzero(~alone)  # places in the order that are not settled, in whole groups
        if not len(slot):
            break
        suffix = order[slot]
        ahead = suffix + h
        inside = ahead < ends[suffix]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort((rank[suffix] << 32) | second, kind="stable")
        group, second, suffix = rank[suffix][by], second[by], suffix[by]
        order[slot] = suffix
        new = np.ones(len(slot), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        first[slot] = new
        rank[suffix] = slot[np.maximum.accumulate(np.where(new, np.arange(len(slot)), 0))]
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the prefix each suffix shares with the one before it in ``order``, by place.

    Kasai: in text order a suffix shares at most one byte less than the suffix a byte before it
    did, so comparing goes on from there. All texts (from ``starts`` to their ends) take their
    steps side by side.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    size = ends[starts] - starts
    by = np.argsort(-size, kind="stable")
    starts, size = starts[by], size[by]
    length = np.zeros(len(starts), np.int64)
    for t in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -t, "left"))  # texts longer than t
        here = starts[:live] + t
        there = before[here]
        now = np.maximum(length[:live] - 1, 0)
        now[there < 0] = 0
        open_ = np.flatnonzero(there >= 0)
        while len(open_):
            i, j, k = here[open_], there[open_], now[open_]
            fits = (i + k < ends[i]) & (j + k < ends[j])
            open_, i, j, k = open_[fits], i[fits], j[fits], k[fits]
            open_ = open_[data[i + k] == data[j + k]]
            now[open_] += 1
        length[:live] = now
        shared[here] = now
    return shared


def repeated_starts(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, whether another start has the same string, its class) of all string starts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)
    ends = (starts + size)[text]
    # To the full depth, equal suffixes in text order: Kasai's step relies on it.
    order, _ = suffix_array(data, ends, int(size.max(initial=0)))
    shared = common_prefixes(data, starts[size > 0], ends, order)
    with_before = shared[order] >= length
    with_after = np.append(with_before[1:], False)
    twice = np.zeros(len(data), bool)
    twice[order] = with_before | with_after
    kind = np.empty(len(data), np.int64)
    kind[order] = np.cumsum(~with_before)
    at = np.flatnonzero(np.arange(len(data)) + length <= ends)
    return text[at], at - starts[text[at]], twice[at], kind[at]


def _intervals(uid: np.ndarray, start: np.ndarray, length: int) -> pd.DataFrame:
    """Runs of neighbouring starts in one document as (uid, from, to) of the bytes they cover."""
    by = np.lexsort((start, uid))
    uid, start = uid[by], start[by]
    new = np.ones(len(uid), bool)
    new[1:] = (uid[1:] != uid[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(uid))[: len(first)] - 1
    return pd.DataFrame({"uid": uid[first], "from": start[first], "to": start[last] + length})


def _in_runs(batches: Iterator[pd.DataFrame], work) -> Iterator[pd.DataFrame]:
    """Apply ``work`` to runs of whole (anchor, shard) groups of about ``RUN_BYTES``."""
    held, size = [], 0
    for batch in batches:
        for part in [batch.iloc[i : i + 1000] for i in range(0, len(batch), 1000)]:
            held.append(part)
            size += int(part["bytes"].str.len().sum())
            if size < RUN_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            key = rows[["anchor", "shard"]].to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if len(new):
                yield work(rows.iloc[: new[-1]])
                rows = rows.iloc[new[-1] :]
            held, size = [rows], int(rows["bytes"].str.len().sum())
    if held and len(rows := pd.concat(held, ignore_index=True)):
        yield work(rows)


def _shard_repeats(length: int):
    """Intervals of contexts that are alone with their bytes but share strings with others."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        text, place, twice, _ = repeated_starts(list(rows["bytes"]), length)
        twice &= (rows["copies"].to_numpy() == 1)[text]
        return _intervals(
            rows["uid"].to_numpy()[text[twice]], rows["at"].to_numpy()[text[twice]] + place[twice], length
        )

    return lambda batches: _in_runs(batches, work)


def _shard_strings(length: int):
    """One row of each different string of a shard: anchor, its 128-bit hash, where it starts."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        text, place, _, kind = repeated_starts(list(rows["bytes"]), length)
        _, one = np.unique(kind, return_index=True)
        text, place = text[one], place[one]
        data, offsets = flat(pa.array(list(rows["bytes"]), pa.binary()))
        at = offsets[text] + place
        keys = []
        for salt in (0, 0x5BD1E995):
            weight = mixed(_WEIGHT + np.uint64(salt))
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(weight[data] * _power("up", len(data)), out=sums[1:])
            keys.append(mixed((sums[at + length] - sums[at]) * _power("down", len(data))[at]).view(np.int64))
        return pd.DataFrame(
            {
                "anchor": rows["anchor"].to_numpy()[text],
                "key": keys[0],
                "more": keys[1],
                "shard": rows["shard"].to_numpy()[text],
                "uid": rows["uid"].to_numpy()[text],
                "start": rows["at"].to_numpy()[text] + place,
                "alone": rows["copies"].to_numpy()[text] == 1,
            }
        )

    return lambda batches: _in_runs(batches, work)


def _merged(length: int):
    """Strings that come from two shards: each is looked for by binary search among all sorted ones."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rows["key"].iloc[-1]
            whole = int(np.searchsorted(rows["key"].to_numpy(), last, "left"))
            yield _crossing(rows.iloc[:whole], length)
            rest = rows.iloc[whole:]
        if rest is not None:
            yield _crossing(rest, length)

    return merge


def _crossing(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    keys = np.empty(len(rows), [("key", np.int64), ("more", np.int64)])
    keys["key"], keys["more"] = rows["key"], rows["more"]
    keys.sort()
    own = np.empty_like(keys)
    own["key"], own["more"] = rows["key"], rows["more"]
    twice = np.searchsorted(keys, own, "right") - np.searchsorted(keys, own, "left") > 1
    return _intervals(rows["uid"].to_numpy()[twice], rows["start"].to_numpy()[twice], length)


def _places(parts: Iterator[pa.Array]) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of each part."""
    at = 0
    for part in parts:
        yield at, len(part)
        at += len(part)


def _cut_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "shard", "shards", "copies", "uid", "at", "bytes"]
    parts = (b.slice(at, n) for b in batches for at, n in _places(slices(b.column(1))))
    for part in parts:
        rows: dict[str, list] = {k: [] for k in names}
        for uid, text, wanted in zip(*(c.to_pylist() for c in part.columns[:3])):
            data = text.encode()
            for w in wanted:
                for k in ("anchor", "shard", "shards", "copies"):
                    rows[k].append(w[k])
                rows["uid"].append(uid)
                rows["at"].append(w["at"])
                rows["bytes"].append(data[w["at"] : w["at"] + w["size"]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[k], pa.binary() if k == "bytes" else pa.int32() if k in names[1:3] else pa.int64())
                for k in names
            ],
            names=names,
        )


def repeated_intervals(docs: DataFrame, length: int, shard_contexts: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(uid, from, to) byte ranges to be removed from (uid, text, ...) rows; ranges may overlap."""
    rows = docs.select("uid", "text").mapInArrow(
        _anchor_rows(length), "uid long, at long, n int, anchor long, context long"
    )
    rows = materialise(rows, "contexts")
    # Stored, so that the join reads both sides anew and a hot anchor's rows can be split.
    common = materialise(rows.groupBy("anchor").count().where("count > 1").select("anchor"), "common-anchors")
    members = materialise(rows.join(common, "anchor", "left_semi"), "repeated-anchors")
    kinds = members.groupBy("anchor", "context", "n").agg(
        F.count("*").alias("copies"), F.min(F.struct("uid", "at")).alias("first")
    )
    kinds = materialise(kinds.select("anchor", "context", "n", "copies", "first.*"), "kinds")
    # Equal contexts are repeated from end to end, wherever they are.
    copied = kinds.where("copies > 1").select("anchor", "context", "n")
    whole = members.join(copied, ["anchor", "context", "n"]).select(
        "uid", F.col("at").alias("from"), (F.col("at") + F.col("n") + (length - 1)).alias("to")
    )
    unlike = kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.min("copies").alias("least"), F.sum(F.col("n") + (length - 1)).alias("bytes")
    )
    unlike = unlike.where("kinds > 1 AND least = 1").selectExpr(
        "anchor", f"int(ceil(greatest(kinds / {shard_contexts}, bytes / {shard_bytes}))) AS shards"
    )
    wanted = kinds.join(unlike, "anchor").select(
        "uid",
        F.struct(
            "anchor",
            F.pmod(F.xxhash64("context"), "shards").cast("int").alias("shard"),
            "shards",
            "copies",
            "at",
            (F.col("n") + (length - 1)).alias("size"),
        ).alias("w"),
    )
    wanted = wanted.groupBy("uid").agg(F.collect_list("w").alias("wanted"))
    # The columns are those of the last join with the texts, so that one shuffle of them serves both.
    fetched = docs.join(wanted, "uid").select("uid", "text", "wanted", *[c for c in docs.columns if c not in ("uid", "text")])
    cut = materialise(
        fetched.mapInArrow(
            _cut_bytes, "anchor long, shard int, shards int, copies long, uid long, at long, bytes binary"
        ),
        "context-bytes",
    )
    dealt = cut.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard")
    ranges = "uid long, from long, to long"
    inside = dealt.mapInPandas(_shard_repeats(length), ranges)
    over = cut.where("shards > 1").repartition("anchor", "shard").sortWithinPartitions("anchor", "shard")
    strings = over.mapInPandas(
        _shard_strings(length),
        "anchor long, key long, more long, shard int, uid long, start long, alone boolean",
    )
    across = strings.repartition("key").sortWithinPartitions("key").mapInPandas(_merged(length), ranges)
    return whole.unionByName(inside).unionByName(across)


def merged_spans(spans: Column) -> Column:
    """Overlapping or touching (from, to) ranges made one, in order."""
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def step(acc: Column, x: Column) -> Column:
        joins = x["from"] <= acc["to"]
        return F.struct(
            F.when(joins, acc["from"]).otherwise(x["from"]).alias("from"),
            F.when(joins, F.greatest(acc["to"], x["to"])).otherwise(x["to"]).alias("to"),
            F.when(joins | (acc["to"] < 0), acc["out"])
            .otherwise(F.array_append(acc["out"], F.struct(acc["from"].alias("from"), acc["to"].alias("to"))))
            .alias("out"),
        )

    minus = F.lit(-1).cast("long")
    return F.aggregate(
        F.array_sort(spans),
        F.struct(minus.alias("from"), minus.alias("to"), none.alias("out")),
        step,
        lambda a: F.when(a["to"] < 0, a["out"]).otherwise(
            F.array_append(a["out"], F.struct(a["from"].alias("from"), a["to"].alias("to")))
        ),
    )


def without(text: Column, spans: Column) -> Column:
    """The text's bytes outside of the spans, which are in order and apart."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, cuts in zip(texts, spans):
            data, at, kept = (text.as_py() or "").encode(), 0, []
            for span in cuts.as_py() or []:
                kept.append(data[at : span["from"]])
                at = span["to"]
            out.append(b"".join([*kept, data[at:]]))
        return pa.array(out, pa.binary())

    return cut(text, spans)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    shard_contexts: int = SHARD_CONTEXTS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with ``removed_spans`` (byte ranges, in order, apart) and ``kept_bytes``.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any
    document or the same; copies of a document remove each other. Null and empty texts have
    nothing to remove. Columns of these names are replaced. ``docs`` must come in the same order
    whenever it is read, as stored tables do, since rows are told apart by their place.
    """
    if length < 8:
        raise ValueError("the length must be 8 or more")
    kept = [c for c in docs.columns if c not in ("removed_spans", "kept_bytes")]
    plain = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *[F.col(c).alias(f"c_{i}") for i, c in enumerate(kept) if c != text],
        *([F.col(text).isNull().alias("none")]),
    )
    ranges = repeated_intervals(plain, length, shard_contexts, shard_bytes)
    spans = ranges.groupBy("uid").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    joined = plain.join(spans.select("uid", merged_spans(F.col("spans")).alias("spans")), "uid", "left")
    joined = joined.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<from:bigint,to:bigint>>")))
    back = [
        (F.when(~F.col("none"), F.col("text")) if c == text else F.col(f"c_{i}")).alias(c) for i, c in enumerate(kept)
    ]
    return joined.select(
        *back, F.col("spans").alias("removed_spans"), without(F.col("text"), F.col("spans")).alias("kept_bytes")
    )
