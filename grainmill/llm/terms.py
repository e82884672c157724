"""Terms of texts as byte strings: maximal runs of chosen bytes, and each document's sparse vector of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from grainmill.llm.text import flat

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def run_spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of true bytes; rows end runs."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    last[:-1] &= ~member[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(member))]
    first[inner] = member[inner]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings of the given lengths that lie end to end in ``data``."""
    at = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(data)])


def vectors(texts: pa.Array, member_of) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The exact sparse vectors of a run of documents: (terms, row, term number, count).

    ``member_of`` tells of an array of bytes which belong to terms. Terms have A-Z in lower case;
    null texts have none. Entries are sorted by row and term number.
    """
    data, offsets = flat(texts)
    member = member_of(data)
    starts, ends = run_spans(member, offsets)
    coded = binary_array(LOWER[data[member]], ends - starts).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.searchsorted(offsets, starts, "right") - 1
    size = max(1, len(coded.dictionary))
    entry, count = np.unique(row * size + codes, return_counts=True)
    return coded.dictionary, entry // size, entry % size, count
