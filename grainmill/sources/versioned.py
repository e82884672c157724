"""Versioned, keyed parquet tables.

A table is a folder with one ``_version=N`` folder per write and a small parquet log of committed
versions. Each log row says which folders hold each of the table's partitions at that version, so a
write adds folders for the partitions it touches and the others stay the same files. A version is
visible once its log row exists: a job that dies half way leaves nothing behind for readers. One
writer at a time.

Of a keyed table each version also has a Bloom filter over the keys it wrote. A batch is tested
against the filters first, and only folders that may hold one of its keys are read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from grainmill.session import fits_broadcast

LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("schema", T.StringType(), False),
        T.StructField("keys", T.ArrayType(T.StringType()), False),
        T.StructField("partition_by", T.ArrayType(T.StringType()), False),
        # partition folder ('' for a table without) to the versions whose folders hold its rows
        T.StructField("parts", T.MapType(T.StringType(), T.ArrayType(T.LongType())), False),
        T.StructField("committed_at", T.TimestampType(), False),
    ]
)

KEYS_PER_WORD = 4  # of a Bloom filter: four bits of each in a 64-bit word, about one false alarm in 200 keys
FOLD_AT = 32  # folders of one partition beyond which a write puts them together
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name that Spark gives to null


class KeyViolation(ValueError):
    """Rows that break a table's primary key."""


def latest_version(log: DataFrame, version: str = "version", by: Sequence[str] = ()) -> DataFrame:
    """The newest version in a log, overall or per table."""
    newest = F.max(F.col(version).cast("bigint")).alias("latest_version")
    return log.groupBy(*by).agg(newest) if by else log.agg(newest)


def _kept(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key ``new`` lacks.

    Only the keys of ``new`` take part in the join: a small batch is broadcast by
    the planner under its own size limit and ``old`` is then not shuffled at all.
    """
    return old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns)


def bloom_place(keys: Sequence[str], words: Column) -> tuple[Column, Column]:
    """The word of a Bloom filter of ``words`` words that a key falls into, and its bits there."""
    first = F.xxhash64(*keys)
    second = F.xxhash64(F.lit(1), *keys)
    bits = F.lit(0).cast("bigint")
    for i in range(4):
        place = F.pmod(F.shiftrightunsigned(second, 6 * i), F.lit(64)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return F.pmod(first, words), bits


def bloom_words(rows: DataFrame, keys: Sequence[str], n_rows: int) -> DataFrame:
    """(words, word, bits): the filter over the keys of ``rows``, as words with any bit set."""
    words = max(1, -(-n_rows // KEYS_PER_WORD))
    word, bits = bloom_place(keys, F.lit(words).cast("bigint"))
    set_ = rows.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return set_.select(F.lit(words).cast("bigint").alias("words"), "word", "bits")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats or is null. Counts combine before the shuffle."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    bad = (
        df.select(*keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) | missing)
    )
    example = bad.limit(1).collect()
    if example:
        raise KeyViolation(f"key {list(keys)} repeats or is null: {example[0].asDict()}")


class VersionedTable:
    """A parquet table whose past versions stay readable."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None):
        """``name``: under which the newest version is found in the session's catalog."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.name = name

    # -- versions -------------------------------------------------------------

    def log(self) -> DataFrame:
        """Committed versions, one row each; empty when the table is new."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/_commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def latest(self) -> int | None:
        """The newest committed version number, None for a table not yet written."""
        return latest_version(self.log()).first()[0]

    def exists(self) -> bool:
        return self.latest() is not None

    def _commit_row(self, version: int | None = None):
        log = self.log()
        if version is None:
            version = self.latest()
        return None if version is None else log.filter(F.col("version") == int(version)).first()

    # -- reading --------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as of ``version``. Other versions' files are not opened."""
        row = self._commit_row(version)
        if row is None:
            raise LookupError(f"no version {version if version is not None else ''} of {self.path}")
        return self._scan(row["parts"], row["schema"])

    def added_since(self, version: int) -> DataFrame | None:
        """The rows that appends have added after ``version``; None if other writes lie between."""
        later = self.log().filter(F.col("version") > int(version)).orderBy("version").collect()
        if any(row["mode"] not in ("append", "fold") for row in later) or not later:
            return None if later else self.read().limit(0)
        parts: dict[str, list[int]] = {}
        for row in later:
            if row["mode"] == "append":
                parts = _merged(parts, self._written(row["version"], row["partition_by"]))
        return self._scan(parts, later[-1]["schema"])

    def _scan(self, parts: Mapping[str, Sequence[int]], schema: str, file: str | None = None) -> DataFrame:
        """The rows in the folders of ``parts``; the file of each as column ``file``, if named."""
        kind = T.StructType.fromJson(json.loads(schema))
        folders = [f"{self.path}/_version={v}{part}" for part, versions in parts.items() for v in versions]
        if not folders:
            none = self.spark.createDataFrame([], kind)
            return none.withColumn(file, F.lit("")) if file else none
        rows = self.spark.read.option("basePath", self.path).schema(kind).parquet(*folders)
        return rows.select(*kind.fieldNames(), *([F.col("_metadata.file_path").alias(file)] if file else []))

    def _written(self, version: int, partition_by: Sequence[str]) -> dict[str, list[int]]:
        """The partitions that a version's folder has, by listing it."""
        jvm = self.spark._jvm
        root = f"{self.path}/_version={version}"
        system = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        parts = [""]
        for _ in partition_by:
            parts = [
                f"{part}/{status.getPath().getName()}"
                for part in parts
                for status in system.listStatus(jvm.org.apache.hadoop.fs.Path(root + part))
                if status.isDirectory() and "=" in status.getPath().getName()
            ]
        return {part: [version] for part in parts}

    # -- writing --------------------------------------------------------------

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = (), keys: Sequence[str] = ()) -> int:
        """Replace contents and schema. Reading this same table in ``df`` is safe."""
        version, schema = (self.latest() or 0) + 1, df.schema.json()
        parts = self._write(df, version, schema, partition_by, keys)
        return self._log(version, "overwrite", schema, keys, partition_by, parts)

    def append(self, df: DataFrame) -> int:
        """Add a batch; only the batch is written, and folders of the table that may hold one of
        its keys are looked through for it."""
        row = self._commit_row()
        if row is None:
            return self.overwrite(df)
        df = _as_stored(df, row["schema"])
        version, keys = row["version"] + 1, row["keys"]
        parts = self._write(df, version, row["schema"], row["partition_by"], keys)
        if keys:
            batch = self._scan(parts, row["schema"])
            suspects = self._suspects(batch, row)
            taken = suspects.select(*keys).join(batch.select(*keys), list(keys), "left_semi") if suspects else None
            if taken is not None and (example := taken.first()):
                raise KeyViolation(f"key {list(keys)} is taken: {example.asDict()}")
        self._log(version, "append", row["schema"], keys, row["partition_by"], _merged(row["parts"], parts))
        self._fold_long()
        return version

    def create(self, df: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> int | None:
        """Create a keyed table if it is absent; return its version, or None if present."""
        if self.exists():
            return None
        return self.overwrite(df, partition_by, keys)

    def upsert(self, df: DataFrame, keys: Sequence[str] = ()) -> int:
        """Update rows with equal keys, insert the others, as a new version.

        Partitions that hold a key of the batch are written anew; those that only gain rows gain a
        folder; all others stay the same files.
        """
        row = self._commit_row()
        if row is None:
            raise LookupError(f"{self.path} does not exist")
        keys = list(keys) or list(row["keys"])
        if not keys:
            raise ValueError(f"{self.path} has no key")
        df = _as_stored(df, row["schema"])
        version, partition_by, schema = row["version"] + 1, row["partition_by"], row["schema"]
        # The batch goes straight to the new version's folder and is checked there: its keys and
        # the table's are unique, so the merged keys are, and the large side needs no check.
        self._write_files(_rebalanced(df, partition_by), version, partition_by)
        added = self._written(version, partition_by)
        batch = self._scan(added, schema)
        require_unique(batch, keys)
        changed = self._holders(batch, keys, row)
        if changed:
            old = self._scan({part: row["parts"][part] for part in changed}, schema)
            kept = _kept(old, batch, keys)
            if not fits_broadcast(batch.select(*keys)):
                # Else the old rows are not shuffled by the join and still lie partition by partition.
                kept = _rebalanced(kept, partition_by)
            self._write_files(kept, version, partition_by, "append")
            added = self._written(version, partition_by)
        others = {part: v for part, v in row["parts"].items() if part not in changed}
        self._write_bloom(version, added, schema, keys)
        self._log(version, "upsert", schema, keys, partition_by, _merged(others, added))
        self._fold_long()
        return version

    def _suspects(self, batch: DataFrame, row, keys: Sequence[str] = (), file: str | None = None) -> DataFrame | None:
        """The rows of folders that may hold a key of ``batch``, by the filters; None if no folder may."""
        keys = list(keys) or list(row["keys"])
        live = {v for versions in row["parts"].values() for v in versions}
        found = live
        if keys == list(row["keys"]):
            folders = [f"{self.path}/_blooms/_version={v}" for v in sorted(live)]
            if not folders:
                return None
            stored = self.spark.read.option("basePath", f"{self.path}/_blooms").parquet(*folders)
            sizes = [tuple(r) for r in stored.select("_version", "words").distinct().collect()]
            if not sizes:
                return None
            choices = F.array(*[F.struct(F.lit(v).alias("_version"), F.lit(n).cast("bigint").alias("words")) for v, n in sizes])
            asked = batch.select(*keys, F.explode(choices).alias("_c"))
            word, bits = bloom_place(keys, F.col("_c.words"))
            asked = asked.select(F.col("_c._version").alias("_version"), word.alias("word"), bits.alias("asked"))
            hits = asked.join(stored.drop("words"), ["_version", "word"]).where(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked"))
            found = {r["_version"] for r in hits.select("_version").distinct().collect()}
        parts = {part: [v for v in versions if v in found] for part, versions in row["parts"].items()}
        return self._scan(parts, row["schema"], file) if found else None

    def _holders(self, batch: DataFrame, keys: Sequence[str], row) -> set[str]:
        """The table's partitions that hold a key of ``batch``: at most one name of each is collected."""
        suspects = self._suspects(batch, row, keys, "_file")
        if suspects is None:
            return set()
        held = suspects.select(*keys, "_file").join(batch.select(*keys), list(keys), "left_semi")
        folders = held.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct().collect()
        names = {r["folder"] for r in folders} | {unquote(r["folder"]) for r in folders}
        ends = {name[name.rindex("/_version=") :] for name in names if "/_version=" in name}
        return {part for part, versions in row["parts"].items() if any(f"/_version={v}{part}" in ends for v in versions)}

    def _write(self, df: DataFrame, version: int, schema: str, partition_by, keys) -> dict[str, list[int]]:
        self._write_files(_rebalanced(df, partition_by), version, partition_by)
        parts = self._written(version, partition_by)
        if keys:
            # Checked on the written files, so ``df`` is computed once.
            require_unique(self._scan(parts, schema), keys)
            self._write_bloom(version, parts, schema, keys)
        return parts

    def _write_files(self, df, version, partition_by, mode="overwrite") -> None:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/_version={version}")

    def _write_bloom(self, version: int, parts, schema: str, keys: Sequence[str]) -> None:
        rows = self._scan(parts, schema)
        words = bloom_words(rows, keys, rows.count())
        words.write.mode("overwrite").parquet(f"{self.path}/_blooms/_version={version}")

    def _log(self, version, mode, schema, keys, partition_by, parts) -> int:
        row = (version, mode, schema, list(keys), list(partition_by), dict(parts), datetime.now(timezone.utc))
        log_row = self.spark.createDataFrame([row], LOG_SCHEMA)
        log_row.coalesce(1).write.mode("append").parquet(f"{self.path}/_commits")
        if self.name:
            self.publish()
        return version

    def fold(self) -> int:
        """Make one version of a chain of writes; what is read stays the same."""
        row = self._commit_row()
        if row is None:
            raise LookupError(f"{self.path} does not exist")
        if all(versions == [row["version"]] for versions in row["parts"].values()):
            return row["version"]
        return self.overwrite(self.read(), row["partition_by"], row["keys"])

    def _fold_long(self) -> None:
        """Write partitions of over ``FOLD_AT`` folders anew, as one folder each; the others stay."""
        row = self._commit_row()
        long = {part: versions for part, versions in row["parts"].items() if len(versions) > FOLD_AT}
        if long:
            version, schema, partition_by = row["version"] + 1, row["schema"], row["partition_by"]
            self._write_files(_rebalanced(self._scan(long, schema), partition_by), version, partition_by)
            parts = self._written(version, partition_by)
            if row["keys"]:
                self._write_bloom(version, parts, schema, row["keys"])
            others = {part: v for part, v in row["parts"].items() if part not in long}
            self._log(version, "fold", schema, row["keys"], partition_by, others | parts)

    def publish(self) -> None:
        """Let ``spark.table(name)`` read the newest version, in every session of this catalog.

        The name is a view over the version's folders, replaced after each commit, with one branch
        per folder and the partitions that are taken from it; no data file is opened for it but
        those the planner looks at. The database is made if it is absent.
        """
        row = self._commit_row()
        database, _, table = self.name.rpartition(".")
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        casts = [f"CAST({{0}} AS {kind}) AS `{name}`" for name, kind in kinds.items()]
        listed = ", ".join(c.format(f"`{name}`") for c, name in zip(casts, kinds))
        by_version: dict[int, list[str]] = {}
        for part, versions in row["parts"].items():
            for version in versions:
                by_version.setdefault(version, []).append(part)
        branches = []
        for version, parts in sorted(by_version.items()):
            tests = " OR ".join(_test(part, kinds) for part in sorted(parts))
            branches.append(f"SELECT {listed} FROM parquet.`{self.path}/_version={version}` AS folder WHERE {tests}")
        none = "SELECT " + ", ".join(c.format("NULL") for c in casts) + " WHERE false"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database or 'default'}`")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{database or 'default'}`.`{table}` AS " + (" UNION ALL ".join(branches) or none)
        )


def _test(part: str, kinds: Mapping[str, str]) -> str:
    """SQL that is true for the rows of one partition folder."""
    tests = []
    for step in part.split("/")[1:]:
        column, _, value = step.partition("=")
        column, value = unquote(column), unquote(value)
        literal = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        same = f"CAST(`{column}` AS {kinds[column]}) = CAST({literal} AS {kinds[column]})"
        tests.append(f"`{column}` IS NULL" if value == NULL_PARTITION else same)
    return "(" + (" AND ".join(tests) or "true") + ")"


def _merged(old: Mapping[str, Sequence[int]], new: Mapping[str, Sequence[int]]) -> dict[str, list[int]]:
    return {part: [*old.get(part, []), *new.get(part, [])] for part in {**old, **new}}


class TableStore:
    """``database.table`` names mapped to versioned tables under one root."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")

    def table(self, name: str) -> VersionedTable:
        database, _, table = name.rpartition(".")
        return VersionedTable(self.spark, f"{self.root}/{database or 'default'}.db/{table}", name)

    def view(self, name: str, version: int | None = None) -> str:
        """Make a table known to SQL in this session; return the view's name."""
        view = name.replace(".", "_")
        self.table(name).read(version).createOrReplaceTempView(view)
        return view

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """One shuffle whose partitions AQE splits or merges by size: no small files, and a
    date that holds most rows is written by many tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _as_stored(df: DataFrame, schema: str) -> DataFrame:
    """A batch in the table's column order; names and types must be the table's."""
    current = T.StructType.fromJson(json.loads(schema))
    if {(f.name, f.dataType) for f in current} != {(f.name, f.dataType) for f in df.schema}:
        raise ValueError(f"batch schema {df.schema.simpleString()} is not {current.simpleString()}")
    return df.select(*current.fieldNames())
