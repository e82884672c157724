"""Key joins: observations with labels, feature lookup, late labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from grainmill.functions.columns import KEYS, LOOKUP_KEYS
from grainmill.session import fits_broadcast

MOST_HOT = 8192  # keys looked for at most: two for each shuffle partition, in any case
TRACKED = 8  # sketch entries for each key looked for; counts are off by at most 1/(6 * keys) of the rows


def _partitions(spark: SparkSession) -> int:
    conf = spark.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or conf.get("spark.sql.shuffle.partitions"))


def key_hash(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> Column | None:
    """A hash of the keys that is equal on both sides whenever the join calls them equal.

    A hash depends on the type, while the join compares values: integers of any width are
    hashed as the widest. Other keys must have one type on both sides, or there is no hash.
    """
    out = []
    for key in keys:
        kinds = [df.schema[key].dataType for df in (facts, lookup)]
        if all(isinstance(k, T.IntegralType) for k in kinds):
            out.append(F.col(key).cast("bigint"))
        elif kinds[0] == kinds[1]:
            out.append(F.col(key))
        else:
            return None
    return F.xxhash64(*out)


def hot_keys(facts: DataFrame, key: Column, limit: int) -> dict[int, float]:
    """Share of the rows by key hash, of each that holds over 1/limit of them: fewer than ``limit``.

    A mergeable frequent-items sketch over the key columns only: each task sends one
    small sketch, rows are not shuffled. A false alarm costs a few repeated rows.
    """
    tracked = TRACKED * limit
    found = facts.select(key.alias("_key")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.expr(f"approx_top_k(_key, {limit}, {tracked})").alias("top"),
    ).first()
    n_rows = found["n_rows"]
    shares = {t["item"]: t["count"] / n_rows + 1 / (0.75 * tracked) for t in found["top"]}
    return {k: share for k, share in shares.items() if share * limit > 1}


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark can hash values of a type: not maps, nor what holds them."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema if _hashable(f.dataType)])


def _pieces(key: Column, shares: dict[int, float], partitions: int, salts: int | None) -> Column:
    """Into how many pieces each key is cut: none is larger than half an average shuffle partition."""
    by_pieces: dict[int, list[int]] = {}
    for hashed, share in shares.items():
        by_pieces.setdefault(salts or max(2, 1 << ceil(2 * share * partitions).bit_length()), []).append(hashed)
    pieces = F.lit(1)
    for n, hashes in sorted(by_pieces.items()):
        pieces = F.when(key.isin(hashes), F.lit(n)).otherwise(pieces)
    return pieces


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which rows of frequent keys are spread over several tasks.

    A key is hot if it fills a good part of an average shuffle partition, and is cut into pieces
    no larger than half of one, or into ``salts``. Hot keys of the facts are looked for in ``hot_from``,
    any cheap frame with their keys, by default the facts. In an inner join the lookup's hot keys are
    cut too: each piece of one side meets each piece of the other in a task of its own, a grid of
    tasks for a key that is hot on both sides. In other joins a lookup row that is repeated must stay whole.
    If no key is hot, or the sides' key types differ in more than the width of integers, this is a
    plain join, whose skewed partitions Spark splits. The salts depend on a row's content and its
    partition number, never on row order, so a repeated task repeats them.
    """
    key = key_hash(facts, lookup, keys)
    if key is None:
        return facts.join(lookup, list(keys), how)
    partitions = _partitions(facts.sparkSession)
    limit = min(MOST_HOT, max(512, 2 * partitions))
    hot = hot_keys(facts if hot_from is None else hot_from, key, limit)
    hot_lookup = hot_keys(lookup, key, limit) if how == "inner" else {}
    if not hot and not hot_lookup:
        return facts.join(lookup, list(keys), how)
    left, right, salted = facts, lookup, list(keys)
    for name, shares, cut, whole in (("_salt", hot, "left", "right"), ("_cell", hot_lookup, "right", "left")):
        if not shares:
            continue
        pieces = _pieces(key, shares, partitions, salts)
        sides = {"left": left, "right": right}
        place = F.pmod(row_hash({"left": facts, "right": lookup}[cut]) + F.spark_partition_id(), pieces).cast("int")
        sides[cut] = sides[cut].withColumn(name, place)
        sides[whole] = sides[whole].withColumn(name, F.explode(F.sequence(F.lit(0), pieces - 1)))
        left, right = sides["left"], sides["right"]
        salted.append(name)
    return left.join(right, salted, how).drop("_salt", "_cell")


def key_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salted: bool | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join on ``keys``, kept once.

    A side under the planner's broadcast limit is left to the planner; larger sides
    are joined with salting, unless ``salted`` says otherwise.
    """
    if salted is None:
        salted = not (fits_broadcast(lookup) or (how == "inner" and fits_broadcast(facts)))
    if salted:
        return salted_join(facts, lookup, keys, how, hot_from=hot_from)
    return facts.join(lookup, list(keys), how)


def join_labels(observations: DataFrame, labels: DataFrame, keys: Sequence[str] = tuple(KEYS), **options) -> DataFrame:
    """Observations that have a label; rows with a null key never match."""
    return key_join(observations, labels, keys, "inner", **options)


def lookup_features(
    rows: DataFrame,
    features: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = tuple(LOOKUP_KEYS),
    exclude: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Fetch ``names`` by key. A row without features stays, with nulls."""
    found = key_join(rows, features.select(*keys, *names), keys, "left", **options)
    return found.drop(*exclude)


def count_missing(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """How many looked-up rows lack at least one of ``names``."""
    absent = reduce(Column.__or__, [F.col(n).isNull() for n in names])
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(absent, 1)).alias("n_missing"),
    )


def join_late_labels(
    scored: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] = tuple(LOOKUP_KEYS),
    counted: str | None = None,
    **options,
) -> DataFrame:
    """Scored rows whose label has arrived, matched without the date; keys may be hot on both sides.

    With ``counted`` equal rows of a side are joined as one, and that column tells how many joined rows
    each row stands for: a key that is hot on both sides gives no product of its copies, but
    one of its different rows.
    """
    repeated = [c for c in labels.columns if c in scored.columns and c not in keys]
    labels = labels.drop(*repeated)
    if counted is None:
        return key_join(scored, labels, keys, "inner", **options)
    sides = [df.groupBy(*df.columns).agg(F.count("*").alias(n)) for df, n in ((scored, "_copies"), (labels, "_found"))]
    joined = key_join(*sides, keys, "inner", **options)
    return joined.withColumn(counted, F.col("_copies") * F.col("_found")).drop("_copies", "_found")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_classes(df: DataFrame, label: str, classes: dict, name: str = "target") -> DataFrame:
    """Per-class frames of one table put together with a numeric class, in one scan."""
    number = F.create_map(*[F.lit(v) for pair in classes.items() for v in pair])
    return df.filter(F.col(label).isin(*classes)).withColumn(name, number[F.col(label)])
