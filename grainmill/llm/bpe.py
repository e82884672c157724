"""Byte-level BPE: texts to token ids by a rank file, and ids back to bytes.

Texts of up to ``chunk_chars`` characters are encoded where they lie. Longer ones are cut into
overlapping chunks that are pre-tokenised in parallel. A chunk finds the first boundary in its
overlap that its own matches share with matches begun afresh at the next chunk's start; from a
shared boundary on, both go the same way, so the chunk ends there and the next one begins there.
Chunks that share none (a run of letters longer than the overlap) are joined and matched as one.

Ids are packed as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.llm.text import flat, fresh, slices
from grainmill.session import materialise

CHUNK_CHARS = 32_768
OVERLAP = 512
CACHED_PIECES = 1 << 17  # of one generation; a task keeps two
CACHED_PAIRS = 1 << 17
NEVER = 1 << 40  # the rank of two tokens that make none


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    words = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        words[rank] = token
    return words


def merge_piece(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Ids of one piece: the pair of the lowest rank is joined first, the leftmost of equals.

    A heap holds the pairs, so a piece of n bytes takes n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part at i is piece[i:ends[i]]; 0 where it is gone

    def pair(i: int) -> tuple[int, int, int] | None:
        j = ends[i]
        rank = ranks.get(piece[i : ends[j]]) if j < n else None
        return None if rank is None else (rank, i, ends[j])

    heap = [p for i in range(n) if (p := pair(i))]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = ends[i]
        if not j or j >= n or ends[j] != end:
            continue  # one of its parts has been joined otherwise
        ends[i], ends[j] = end, 0
        if end < n:
            before[end] = i
        for k in (before[i], i):
            if k >= 0 and (p := pair(k)):
                heapq.heappush(heap, p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class Pairs(dict):
    """Rank of the token that two tokens make, by both ids in one number; looked up when first asked for.

    When ``size`` pairs are kept, all are forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], size: int = CACHED_PAIRS):
        super().__init__()
        self.ranks, self.words, self.size = ranks, vocabulary(ranks), size

    def __missing__(self, pair: int) -> int:
        rank = self.ranks.get(self.words[pair >> 32] + self.words[pair & 0xFFFFFFFF], NEVER)
        if len(self) >= self.size:
            self.clear()
        self[pair] = rank
        return rank


class Pieces(dict):
    """Packed ids by pre-token; computed when first asked for.

    Two generations: when the new one is full it takes the place of the old one, and what is asked for
    again moves over, so frequent pieces stay and rare ones are forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], size: int = CACHED_PIECES):
        super().__init__()
        self.ranks, self.pairs, self.old, self.size = ranks, Pairs(ranks), {}, size
        self.bytes = [ranks.get(bytes([b])) for b in range(256)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._packed(piece.encode())
        if len(piece) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _packed(self, piece: bytes) -> bytes:
        """As ``merge_piece``; for a short piece a search through its pairs is faster than a heap."""
        if piece in self.ranks:
            return self.ranks[piece].to_bytes(4, "little")
        if len(piece) > 64:
            return np.array(merge_piece(self.ranks, piece), "<u4").tobytes()
        parts, pairs = [self.bytes[b] for b in piece], self.pairs
        merged = [pairs[x << 32 | y] for x, y in zip(parts, parts[1:])]
        while merged and (low := min(merged)) < NEVER:
            i = merged.index(low)  # the leftmost of equals
            parts[i] = low
            del parts[i + 1], merged[i]
            if i:
                merged[i - 1] = pairs[parts[i - 1] << 32 | low]
            if i < len(merged):
                merged[i] = pairs[low << 32 | parts[i + 1]]
        return b"".join([p.to_bytes(4, "little") for p in parts])


def resync(match: regex.Pattern, text: str, at: int, to_end: bool) -> int | None:
    """The first position from ``at`` on where matches from 0 and matches from ``at`` both begin.

    ``to_end``: the text ends where its document ends; else its last match may be cut short
    and what it says is left out. None: they share no boundary.
    """
    limit = len(text) + 1 if to_end else len(text)
    fresh = {at} | {m.end() for m in match.finditer(text, at) if m.end() < limit}
    own = (m.end() for m in match.finditer(text) if at <= m.end() < limit)
    return next((end for end in own if end in fresh), None)


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The batches' rows in parts of few bytes, each worked on and sent back alone: what a part needs is a
    multiple of its bytes, and a batch has as many rows as the session says, however long. An empty batch is a part."""
    for batch in batches:
        yield from slices(batch) if len(batch) else [batch]


def _encoder(path: str, pattern: str):
    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, match = Pieces(read_ranks(path)), regex.compile(pattern)
        for part in _parts(batches):
            yield pa.array([b"".join(map(pieces.__getitem__, match.findall(t.as_py() or ""))) for t in part], pa.binary())

    return encode


def _chunks(length: int, overlap: int):
    kind = pa.list_(pa.struct([("no", pa.int32()), ("last", pa.bool_()), ("piece", pa.string())]))

    @F.arrow_udf("array<struct<no:int,last:boolean,piece:string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in _parts(batches):
            out = []
            for t in part.to_pylist():
                n = -(-len(t) // length)
                out.append(
                    [
                        {"no": i, "last": i == n - 1, "piece": t[i * length : (i + 1) * length + overlap]}
                        for i in range(n)
                    ]
                )
            yield pa.array(out, kind)

    return cut


def _meeting(pattern: str, length: int):
    @F.arrow_udf("int")
    def meet(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        match = regex.compile(pattern)
        for pieces, last in batches:
            # A chunk is short; its text is taken alone, so that a batch of any size costs a number a row.
            yield pa.array(
                [
                    None if end.as_py() else resync(match, piece.as_py(), length, False)
                    for piece, end in zip(pieces, last, strict=True)
                ],
                pa.int32(),
            )

    return meet


def encode_long(docs: DataFrame, path: str, pattern: str, length: int, overlap: int) -> DataFrame:
    """(uid, ids) of (uid, text) rows whose texts are cut, matched in parallel and joined again."""
    chunk = docs.select("uid", F.explode(_chunks(length, overlap)("text")).alias("c")).select("uid", "c.*")
    parts = 2 * docs.sparkSession.sparkContext.defaultParallelism
    chunk = chunk.repartition(parts, "uid", "no")
    meeting = chunk.select("uid", "no", "last", _meeting(pattern, length)("piece", "last").alias("meet"))
    # From here a row is a chunk's number and an offset; the texts stay where they are.
    by_doc = Window.partitionBy("uid").orderBy("no")
    before = F.lag("meet").over(by_doc)
    bounds = meeting.select(
        "uid",
        "no",
        F.coalesce(before - length, F.lit(0)).alias("skip"),
        F.sum(F.when((F.col("no") == 0) | before.isNotNull(), 1).otherwise(0)).over(by_doc).alias("run"),
        F.coalesce("meet", F.lit(length)).alias("stop"),
    )
    placed = chunk.join(bounds, ["uid", "no"])
    # A run is one chunk, or several without a shared boundary between them: their texts are put
    # end to end and matched as one text.
    kept = F.when(F.col("last"), F.col("piece")).otherwise(F.expr("substring(piece, 1, stop)"))
    runs = placed.select("uid", "run", "no", kept.substr(F.col("skip") + 1, F.length("piece") + 1).alias("p"))
    texts = runs.groupBy("uid", "run").agg(
        F.min("no").alias("first"), F.array_sort(F.collect_list(F.struct("no", "p"))).alias("all")
    )
    texts = texts.select("uid", "first", F.array_join(F.col("all.p"), "").alias("text"))
    ids = texts.select("uid", "first", _encoder(path, pattern)("text").alias("ids"))
    # Joined as hexadecimal text, in which Spark has a join of arrays that takes one pass.
    packed = ids.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "ids"))).alias("all"))
    return packed.select("uid", F.unhex(F.array_join(F.transform(F.col("all.ids"), F.hex), "")).alias("ids"))


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    output: str = "ids",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with its texts' ids in ``output``, which replaces a column of that name.

    Null and empty texts have no ids (an empty value). Equal rows each keep their own. Special
    tokens in a text are ordinary text.
    """
    if not 0 < overlap <= chunk_chars:
        raise ValueError("the overlap must be between 1 and the length of a chunk")
    value = F.coalesce(F.col(text), F.lit(""))
    short = docs.where(F.length(value) <= chunk_chars)
    near = short.withColumn(output, _encoder(ranks, pattern)(value))
    # Copies of a long text are encoded once, then joined to each row that has it. The ids are
    # stored between, so that the join's skewed keys can be split.
    key = fresh(docs, "text_key")
    far = docs.withColumn(key, F.sha2(value, 256)).where(F.length(value) > chunk_chars)
    texts = far.select(F.col(key).alias("uid"), value.alias("text")).dropDuplicates(["uid"])
    ids = materialise(encode_long(texts, ranks, pattern, chunk_chars, overlap), "long-ids")
    long = far.drop(output).join(ids.select(F.col("uid").alias(key), F.col("ids").alias(output)), key)
    return near.unionByName(long.select(*near.columns))


def decode(ids: Column, ranks: str) -> Column:
    """The bytes that packed ids stand for; no ids, null ones too, stand for no bytes.

    Bytes are given, not text: ids cut at any place may end within a character.
    """

    @F.arrow_udf("binary")
    def join_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = pa.array(vocabulary(read_ranks(ranks)), pa.large_binary())
        for part in _parts(batches):
            packed, offsets = flat(part)
            tokens = words.take(pa.array(packed.view("<u4")))
            _, ends, data = tokens.buffers()
            ends = np.frombuffer(ends, np.int64)[: len(tokens) + 1] if len(tokens) else np.zeros(1, np.int64)
            rows = pa.py_buffer(np.ascontiguousarray(ends[offsets // 4]))
            joined = pa.Array.from_buffers(pa.large_binary(), len(part), [None, rows, data or pa.py_buffer(b"")])
            yield joined.cast(pa.binary())

    return join_bytes(ids)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
