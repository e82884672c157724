"""Reading documents and looking at Arrow text columns as flat byte arrays.

Words are runs of bytes other than space and the control characters 9 to 13, which is what
``bytes.split()`` finds too; lower case means A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 20  # text worked on at once inside a task, so that its arrays stay in the cache
BLOCK = 1 << 17
LONG_WORD = 64  # bytes, above which a word's hash is no polynomial

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WEIGHT = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, at, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The column cut into runs of rows of about ``limit`` bytes; one row at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield column.slice(at, to - at)
        at = to


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWERS = {"up": powers(_BASE, BLOCK), "down": powers(_INVERSE, BLOCK)}


def _power(kind: str, n: int) -> np.ndarray:
    if n > len(_POWERS[kind]):
        _POWERS[kind] = powers(_BASE if kind == "up" else _INVERSE, 1 << int(n - 1).bit_length())
    return _POWERS[kind][:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; rows end words."""
    word = ~_SEPARATOR[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and how many words lie before each row's start.

    The hash is a polynomial in the word's bytes modulo 2**64, taken from running sums over
    blocks of text, then scrambled. Modulo a power of two, words of a very regular structure
    cancel out once they are some hundred bytes long, so words over ``LONG_WORD`` bytes have a
    BLAKE2 hash instead. Two words share a hash with a probability near 2**-64.
    """
    starts, ends = word_spans(data, offsets)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        block = data[begin : int(ends[to - 1])]
        block = _LOWER[block] if lower else block
        sums = np.empty(len(block) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_WEIGHT[block] * _power("up", len(block)), out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        hashes[at:to] = (sums[e] - sums[s]) * _power("down", len(block))[s]
        at = to
    hashes = mixed(hashes)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        word = data[starts[i] : ends[i]]
        hashes[i] = int.from_bytes(blake2b(_LOWER[word] if lower else word, digest_size=8).digest(), "little")
    return hashes, np.searchsorted(starts, offsets)


def word_hash(word: bytes) -> int:
    """The hash that ``word_hashes`` gives to one word."""
    return int(word_hashes(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0][0])
