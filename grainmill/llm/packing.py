"""Packing examples into sequences under limits on tokens, segments and loss-bearing tokens at once.

Vector bin packing with a dot-product heuristic: of the examples at hand the one whose demand has
the largest dot product with what is left of the open sequence, both as shares of the limits, comes
next. When none fits, the one with the largest product is cut where the sequence ends and its rest
goes back. Each task packs the rows that it reads, a pool of them at a time, so nothing is shuffled and
the memory does not grow with the input; each task leaves one sequence that may not be full.

Ids are packed as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

POOL = 512  # examples to choose from
_TASK = 1 << 40  # numbers of a task's sequences

# The pattern of the byte-level tokenizers whose JSON names none of its own.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_names() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, then the others in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a byte-level BPE JSON file, merged by rank, for which ids must rise with merges."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, before = made["model"], made.get("pre_tokenizer") or {}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab["".join(m)] for m in merges]
    if model.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or made.get("normalizer"):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError(f"{path}: ids do not rise with the merges")
    of, special = byte_names(), {t["content"] for t in made.get("added_tokens", [])}
    ranks = {bytes(of[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: Column, path: str, end: int | None = None) -> Column:
    """Packed ids of each text, then ``end``; special tokens in a text are ordinary, null texts empty."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, tail = encoding(path), [] if end is None else [end]
        for batch in batches:
            ids = (encoder.encode_ordinary(t.as_py() or "") + tail for t in batch)
            yield pa.array([np.array(i, "<u4").tobytes() for i in ids], pa.binary())

    return encode(text)


class Example:
    """What is left of one example: its row, its ids from ``start`` on and the loss-bearing tokens before each."""

    __slots__ = ("row", "ids", "before", "start")

    def __init__(self, row: int, ids: np.ndarray, loss: np.ndarray | None):
        self.row, self.ids, self.start = row, ids, 0
        self.before = None if loss is None else np.concatenate([[0], np.cumsum(loss != 0)])

    def tokens(self) -> int:
        return len(self.ids) - self.start

    def losses(self, stop: int) -> int:
        """Loss-bearing tokens from ``start`` to ``stop``."""
        return stop - self.start if self.before is None else int(self.before[stop] - self.before[self.start])

    def reach(self, tokens: int, losses: int) -> int:
        """The furthest place that so many tokens and loss-bearing tokens allow."""
        stop = min(len(self.ids), self.start + tokens)
        if self.before is None:
            return min(stop, self.start + losses)
        return min(stop, int(np.searchsorted(self.before, self.before[self.start] + losses, "right")) - 1)


class Packer:
    """Packs examples as they come; ``out`` takes (example's row, ids, start, losses, sequence, offset)."""

    def __init__(self, limits: tuple[int, int, int], first: int, powers: bool, out: list):
        self.limits, self.next, self.powers, self.out = limits, first, powers, out
        self.pool: list[Example] = []
        self.need = np.zeros((POOL, 3))  # tokens, segments and losses of the pool's examples
        self.scale = 1.0 / np.array(limits, float) ** 2

    def add(self, example: Example) -> None:
        tokens, _, losses = self.limits
        while example.tokens() > tokens or example.losses(len(example.ids)) > losses:
            stop = example.reach(tokens, losses)  # more than a sequence holds: its head is one by itself
            self.close([(example, example.start, stop)])
            example.start = stop
        if example.tokens():
            self._keep(example)
            if len(self.pool) >= POOL:
                self.fill()

    def _keep(self, example: Example) -> None:
        self.need[len(self.pool)] = example.tokens(), 1, example.losses(len(example.ids))
        self.pool.append(example)

    def _take(self, at: int) -> Example:
        """Take an example out of the pool; the last one moves to its place."""
        taken, last = self.pool[at], self.pool.pop()
        if at < len(self.pool):
            self.pool[at], self.need[at] = last, self.need[len(self.pool)]
        return taken

    def fill(self) -> None:
        """Fill one sequence from the pool."""
        left, parts = np.array(self.limits, float), []
        while self.pool and (left > 0).all():
            need = self.need[: len(self.pool)]
            product = need @ (left * self.scale)
            fits = (need <= left).all(axis=1)
            at = int(np.where(fits, product, -1.0).argmax()) if fits.any() else int(product.argmax())
            example = self._take(at)
            stop = example.reach(int(left[0]), int(left[2]))
            parts.append((example, example.start, stop))
            left -= (stop - example.start, 1, example.losses(stop))
            example.start = stop
            if example.tokens():
                self._keep(example)
        self.close(parts)

    def close(self, parts: list[tuple[Example, int, int]]) -> None:
        """Write a sequence; one that is not full is cut at powers of two, whose sequences need no padding."""
        used = sum(stop - start for _, start, stop in parts)
        sizes = [used]
        if self.powers and used < self.limits[0]:
            sizes = [1 << i for i in range(used.bit_length() - 1, -1, -1) if used >> i & 1]
        parts = parts[::-1]
        for size in sizes:
            offset = 0
            while offset < size:
                example, start, stop = parts.pop()
                end = min(stop, start + size - offset)
                if end < stop:
                    parts.append((example, end, stop))
                losses = end - start if example.before is None else int(example.before[end] - example.before[start])
                self.out.append((example.row, example.ids[start:end].tobytes(), start, losses, self.next, offset))
                offset += end - start
            self.next += 1


def pack(
    examples: DataFrame,
    max_tokens: int,
    max_segments: int,
    max_loss: int,
    ids: str = "ids",
    loss: str | None = None,
    keep: Sequence[str] = (),
    powers: bool = False,
) -> DataFrame:
    """One row per piece of an example: the ``keep`` columns, then piece_start, piece_ids, piece_loss,
    sequence_id, sequence_offset.

    ``ids`` holds packed token ids. ``loss`` names a binary column with one byte per id, zero where
    the token bears no loss; without it all do. A piece is the example's ids from piece_start on; every id
    lies in exactly one piece, in sequence sequence_id from sequence_offset on, which is gapless from 0.
    A sequence holds at most ``max_tokens`` ids, ``max_segments`` pieces and ``max_loss`` loss-bearing
    ids, whatever the examples' lengths. With ``powers`` sequences that stay short are cut at powers of two.

    Examples without ids (null or empty) give no rows; repeated rows are packed each; kept columns
    must not have one of the new names. Sequence numbers are unique, and the same when a task is repeated.
    """
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("limits must be at least 1")
    made = ["piece_start", "piece_ids", "piece_loss", "sequence_id", "sequence_offset"]
    if clash := {k.lower() for k in keep} & set(made):
        raise ValueError(f"kept columns may not be named {sorted(clash)}")
    kept = [f"kept_{i}" for i in range(len(keep))]
    rows = examples.select(
        F.col(ids).alias("ids"),
        (F.lit(None).cast("binary") if loss is None else F.col(loss)).alias("loss"),
        *[F.col(k).alias(name) for k, name in zip(keep, kept)],
    )
    kinds = [T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(made, kinds)])
    schema = T.StructType([*[T.StructField(n, rows.schema[n].dataType) for n in kept], *schema.fields])
    limits = (max_tokens, max_segments, max_loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        packer = Packer(limits, TaskContext.get().partitionId() * _TASK, powers, out)
        waiting = None  # kept columns of the rows that examples in the pool refer to
        for batch in batches:
            own = batch.select(kept)
            table = pa.Table.from_batches([own]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([own])])
            first = table.num_rows - batch.num_rows
            for i, (packed, mask) in enumerate(zip(batch.column("ids"), batch.column("loss"))):
                if not (packed := packed.as_py()):
                    continue
                mask = mask.as_py()
                packer.add(
                    Example(first + i, np.frombuffer(packed, "<u4"), None if mask is None else np.frombuffer(mask, np.uint8))
                )
            yield from pieces(table, out)
            # Only the pool's rows stay.
            waiting = table.take(pa.array([e.row for e in packer.pool], pa.int64()))
            for i, e in enumerate(packer.pool):
                e.row = i
        while packer.pool:
            packer.fill()
        if out:
            yield from pieces(waiting, out)

    def pieces(table: pa.Table, out: list) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(out), 4096):
            row, packed, start, losses, sequence, offset = zip(*out[at : at + 4096])
            new = [pa.array(start, pa.int64()), pa.array(packed, pa.binary()), *[pa.array(x, pa.int64()) for x in (losses, sequence, offset)]]
            columns = table.take(pa.array(row, pa.int64())).combine_chunks().columns
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*kept, *made])
        out.clear()

    return rows.mapInArrow(run, schema).select(*[F.col(n).alias(k) for n, k in zip(kept, keep)], *made)
