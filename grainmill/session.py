"""Session settings, shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. AQE splits skewed join partitions, merges small
# ones after each shuffle and balances partitioned writes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


_LOCAL: dict[str, str] = {}  # the folder of a local application that names none
_SCOPES: list[str] = []  # folders of the jobs under way


def build_session(app: str, cores: str | int = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="grainmill-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, grouped by application and job for later removal."""
    app = spark.sparkContext.applicationId
    return "/".join([f"{shared_dir(spark)}/grainmill-{app}", *_SCOPES[-1:], f"{label}-{uuid.uuid4().hex}"])


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables, once no frame reads them any more."""
    _delete(spark, f"{shared_dir(spark)}/grainmill-{spark.sparkContext.applicationId}")


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Within it scratch tables go to a folder of their own, which is removed at the end.

    For jobs that leave only stored tables behind: no frame made within may be read afterwards.
    """
    scope = f"job-{uuid.uuid4().hex}"
    _SCOPES.append(scope)
    try:
        yield
    finally:
        _SCOPES.remove(scope)
        _delete(spark, f"{shared_dir(spark)}/grainmill-{spark.sparkContext.applicationId}/{scope}")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives executor loss, and keeps column pruning for readers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(table: DataFrame, most: int | None = None) -> DataFrame:
    """At least one partition per core, for passes of fits over a small table of few files.

    A table that the planner takes for larger than one scan split per core is returned as it is, unless
    ``most`` bounds the bytes of a partition, by the planner's estimate: then it has as many as that takes.
    """
    spark = table.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = estimated_bytes(table)
    if most is not None:
        return table.repartition(max(cores, ceil(size / most)))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return table if size >= cores * split else table.repartition(cores)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own size estimate for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate is under its own broadcast limit."""
    jvm_conf = df.sparkSession._jsparkSession.sessionState().conf()
    return 0 <= estimated_bytes(df) <= jvm_conf.autoBroadcastJoinThreshold()
