"""Splits and samples that are exact, seeded and need no global sort."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.functions.hashing import seeded_digest, seeded_int, seeded_uniform
from grainmill.operators.joins import key_join
from grainmill.session import materialise

LEAF_ROWS = 4_000_000  # rows of one group that a single window task may hold
STEP = 3  # hex digits fixed per refinement: 4,096 slots per group
DEEPEST = 12  # digits after which a slot holds copies of one key and hardly anything else


def in_share(keys: Sequence[str], share: float, seed: int) -> Column:
    """Whether a row falls in the first ``share`` of the hash range. No shuffle."""
    return seeded_int(keys, seed) < F.lit(int(share * 2**32))


def train_test_split(
    df: DataFrame, keys: Sequence[str], share: float = 0.7, seed: int = 123, name: str = "split"
) -> DataFrame:
    """Label each row train or test by key hash; sizes match ``share`` in expectation."""
    return df.withColumn(name, F.when(in_share(keys, share, seed), "train").otherwise("test"))


def _with_cut(df: DataFrame, cuts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach each group's cut. ``cuts`` is a written table, so its size is known and
    the planner decides whether to broadcast it."""
    if by:
        return key_join(df, cuts, by, "left")
    row = cuts.first()
    literals = [
        F.lit(row[f.name] if row else None).cast(f.dataType).alias(f.name) for f in cuts.schema
    ]
    return df.select("*", *literals)


def hash_cutoffs(
    rows: DataFrame,
    target: Callable[[Column], Column],
    by: Sequence[str] = (),
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Per group, the digest of the row at position ``target`` in digest order.

    ``rows`` has the ``by`` columns and a ``_digest`` of 32 hex digits; ``target`` turns
    a group's row count into a position. Result: ``by``, ``cut``, ``at_cut`` (rows equal
    to the cut that are taken) and ``tied`` (rows equal to the cut); no row for a group
    of which nothing is taken.

    A radix selection: each round counts rows by the next three digits, keeps the slot
    that holds the cut, and stops once that slot is small enough for one task. Counts
    combine before the shuffle, and 4,096 slots of a group meet in a window. Among
    10^14 different keys about one shares its first twelve digits with another, so a slot
    still large by then holds copies of one key, which the last step counts as one.
    """
    by = list(by)
    whole = Window.partitionBy(*by)
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    in_cut = (F.col("_before") < F.col("_need")) & (
        F.col("_need") <= F.col("_before") + F.col("_inside")
    )
    n = F.count(F.lit(1)).alias("_inside")
    cuts, depth = None, 0
    while True:
        slot = F.substring("_digest", depth + 1, STEP).alias("_slot")
        if cuts is None:
            slots = rows.groupBy(*by, slot).agg(n)
            total = F.sum("_inside").over(whole)
            slots = slots.withColumns(
                {"_prefix": F.lit(""), "_need": F.least(target(total).cast("bigint"), total)}
            )
        else:
            inside = _with_cut(rows, cuts.drop("_inside"), by).filter(
                F.col("_digest").startswith(F.col("_prefix"))
            )
            slots = inside.groupBy(*by, "_prefix", "_need", slot).agg(n)
        running = slots.withColumn("_before", F.sum("_inside").over(upto.orderBy("_slot")) - F.col("_inside"))
        cuts = materialise(
            running.filter(in_cut).select(
                *by,
                F.concat("_prefix", "_slot").alias("_prefix"),
                (F.col("_need") - F.col("_before")).alias("_need"),
                "_inside",
            ),
            "cuts",
        )
        depth += STEP
        largest = cuts.agg(F.max("_inside")).first()[0]
        if largest is None or largest <= leaf_rows or depth >= DEEPEST:
            break
    # Equal digests collapse before the window, so copies of a row arrive as one.
    leaf = (
        _with_cut(rows, cuts.drop("_inside"), by)
        .filter(F.col("_digest").startswith(F.col("_prefix")))
        .groupBy(*by, "_need", "_digest")
        .agg(n)
    )
    ranked = leaf.withColumn("_before", F.sum("_inside").over(upto.orderBy("_digest")) - F.col("_inside"))
    found = ranked.filter(in_cut).select(
        *by,
        F.col("_digest").alias("cut"),
        (F.col("_need") - F.col("_before")).alias("at_cut"),
        F.col("_inside").alias("tied"),
    )
    return materialise(found, "cutoff")


def mark_smallest(
    df: DataFrame,
    target: Callable[[Column], Column],
    keys: Sequence[str] | None,
    seed: int,
    by: Sequence[str] = (),
    name: str = "chosen",
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Mark exactly ``target`` rows per group, the first in seeded hash order of ``keys``.

    Once the cutoffs are known this is one scan with a comparison. Rows whose key is not
    unique and straddles a cut are ordered by a hash of the whole row (``keys`` None);
    equal rows that still straddle are counted and marked by number.
    """
    by, columns = list(by), df.columns
    if keys is None:
        digest = F.md5(F.to_json(F.struct(F.lit(seed), *columns), {"ignoreNullFields": "false"}))
    else:
        digest = seeded_digest(keys, seed)
    cuts = hash_cutoffs(df.select(*by, digest.alias("_digest")), target, by, leaf_rows)
    rows = _with_cut(df.withColumn("_digest", digest), cuts, by)
    below = F.coalesce(F.col("_digest") <= F.col("cut"), F.lit(False))
    if cuts.filter("at_cut < tied").isEmpty():
        return rows.select(*columns, below.alias(name))
    split = F.coalesce((F.col("_digest") == F.col("cut")) & (F.col("at_cut") < F.col("tied")), F.lit(False))
    clear = rows.filter(~split).select(*columns, below.alias(name))
    tied = rows.filter(split)
    if keys is not None:
        tied = tied.select(*columns, F.col("at_cut").alias("_take"))
        marked = mark_smallest(tied, lambda total: F.col("_take"), None, seed, [*by, "_take"], name, leaf_rows)
    else:
        marked = (
            tied.groupBy(*columns, "at_cut")
            .agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_number", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
            .withColumn(name, F.col("_number") <= F.col("at_cut"))
        )
    return clear.unionByName(marked.select(*columns, name))


def exact_split(
    df: DataFrame,
    keys: Sequence[str],
    share: float = 0.7,
    seed: int = 123,
    name: str = "split",
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Label floor(share * n) rows train and the rest test."""
    def target(total: Column) -> Column:
        return F.floor(total * F.lit(share))

    marked = mark_smallest(df, target, keys, seed, (), "_chosen", leaf_rows)
    return marked.withColumn(name, F.when(F.col("_chosen"), "train").otherwise("test")).drop("_chosen")


def balanced_sample(
    df: DataFrame,
    label: str,
    n: int,
    keys: Sequence[str],
    seed: int,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``n`` rows of every class, or all of a class that has fewer."""
    marked = mark_smallest(df, lambda total: F.lit(n), keys, seed, [label], "_chosen", leaf_rows)
    return marked.filter("_chosen").drop("_chosen")


def draw_class(
    df: DataFrame, classes: Sequence, weights: Sequence[float], keys: Sequence[str], seed: int, name: str = "drawn"
) -> DataFrame:
    """Give each row a class drawn by weight: one uniform against cumulative weights."""
    total, running = float(sum(weights)), 0.0
    tests = []
    for label, weight in zip(classes, weights):
        running += weight
        tests.append(F.when(F.col("_u") < F.lit(running / total), F.lit(label)))
    drawn = F.coalesce(*tests[:-1], F.lit(classes[-1]))
    return df.withColumn("_u", seeded_uniform(keys, seed)).withColumn(name, drawn).drop("_u")


def alias_table(weights: Sequence[float]) -> tuple[list[float], list[int]]:
    """Per class the share of its own slot that it keeps, and the class that has the rest (Vose 1991).

    Slots are equally likely, so a draw is one slot and one comparison, however many classes there are.
    """
    total, n = float(sum(weights)), len(weights)
    if not n or total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative and need a positive sum")
    share, other = [w * n / total for w in weights], list(range(n))
    small, large = [i for i in range(n) if share[i] < 1], [i for i in range(n) if share[i] >= 1]
    while small and large:
        i, j = small.pop(), large[-1]
        other[i] = j
        share[j] -= 1 - share[i]
        if share[j] < 1:
            small.append(large.pop())
    for i in [*small, *large]:  # what is left differs from 1 by rounding only; a class of no weight keeps nothing
        share[i] = 1.0 if weights[i] else 0.0
        other[i] = i if weights[i] else max(range(n), key=weights.__getitem__)
    return share, other


def draw_of_many(df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int, name: str = "drawn") -> DataFrame:
    """Give each row the number of a class drawn by weight, in constant time per row.

    The table of the classes enters as two constant arrays, so it is meant for up to some 100,000.
    """
    share, other = alias_table(weights)
    slots = F.col("_u") * F.lit(float(len(share)))
    slot = F.least(F.floor(slots).cast("int"), F.lit(len(share) - 1))
    kept = F.from_json(F.lit(json.dumps(share)), "array<double>")
    rest = F.from_json(F.lit(json.dumps(other)), "array<int>")
    drawn = F.when(slots - slot < F.get(kept, slot), slot).otherwise(F.get(rest, slot))
    return df.withColumn("_u", seeded_uniform(keys, seed)).withColumn(name, drawn).drop("_u")
