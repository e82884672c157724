"""Hash-based identity, ordering and pseudo-random draws.

All are pure functions of a row's columns, so a task that is run again after an
executor is lost produces the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

NULL_MARK = "~"  # stands for null, so ('a', null) and (null, 'a') stay different


def _joined(columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]


def row_identity(columns: Sequence[str]) -> Column:
    """A replay-safe row id: the md5 of the identifying columns.

    Each value is preceded by its length, so that different rows never make one text; a null
    has no length.
    """
    texts = [F.col(c).cast("string") for c in columns]
    sized = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts]
    return F.md5(F.concat(*sized))


def seeded_digest(columns: Sequence[str], seed: int) -> Column:
    """32 hex digits that order rows pseudo-randomly for a given seed.

    The columns are joined apart from the seed, so that draws of several seeds join them once.
    """
    return F.md5(F.concat(F.lit(f"{seed}-"), F.concat_ws("-", *_joined(columns))))


def seeded_int(columns: Sequence[str], seed: int) -> Column:
    """The first 32 bits of the seeded digest as a bigint."""
    return F.conv(F.substring(seeded_digest(columns, seed), 1, 8), 16, 10).cast("bigint")


def seeded_uniform(columns: Sequence[str], seed: int) -> Column:
    """A draw from [0, 1) with 32-bit resolution."""
    return seeded_int(columns, seed) / F.lit(float(2**32))


def hashed_uniform(columns: Sequence[str], seed: int) -> Column:
    """A draw from [0, 1) with 52-bit resolution; cheaper, but Spark's own hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(2**52)) / F.lit(float(2**52))


def hashed_normal(
    columns: Sequence[str], seed: int, uniform: Callable[[Sequence[str], int], Column] = hashed_uniform
) -> Column:
    """A standard normal draw (Box and Muller 1958) from two hashed uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(columns, seed)))
    return radius * F.cos(F.lit(2.0) * F.pi() * uniform(columns, seed + 1))
