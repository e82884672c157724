"""Model versions, stages and run tags as plain tables.

``model_versions(name, version, stage, run_id)`` holds one row per version, version as
text; ``run_tags(run_id, key, value, logged_at)`` is append-only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Stage and gate names.
UNSTAGED, STAGING, PRODUCTION = "None", "Staging", "Production"
PASSED, FAILED = "passed", "failed"
MINIMAL_THRESHOLD = 0.8


def newest_models(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """The highest version of every model, compared as a number; any stage by default."""
    if stage is not None:
        versions = versions.filter(F.col("stage") == stage)
    rest = [c for c in versions.columns if c not in ("name", "version")]
    ranked = F.struct(F.col("version").cast("bigint").alias("n"), "version", *rest)
    return (
        versions.groupBy("name")
        .agg(F.max_by(ranked, ranked["n"]).alias("m"))
        .select("name", "m.version", *[f"m.{c}" for c in rest])
    )


def gate(measured: DataFrame, threshold: float = MINIMAL_THRESHOLD, metric: str = "accuracy") -> DataFrame:
    """Tag each measured row passed or failed; an unknown metric fails."""
    ok = F.coalesce(F.col(metric) >= F.lit(threshold), F.lit(False))
    return measured.withColumn("validation", F.when(ok, PASSED).otherwise(FAILED))


def promote(versions: DataFrame, chosen: DataFrame, stage: str) -> DataFrame:
    """``versions`` with the chosen (name, version) rows moved to ``stage``."""
    moved = chosen.select("name", "version", F.lit(stage).alias("_stage"))
    found = versions.join(moved, ["name", "version"], "left")
    return found.withColumn("stage", F.coalesce("_stage", "stage")).select(*versions.columns)


def promote_to_staging(
    versions: DataFrame, measured: DataFrame, environment: str, threshold: float = MINIMAL_THRESHOLD
) -> DataFrame:
    """Newest unstaged version of each model to Staging, if it passed in ``staging``.

    ``measured`` has name, version and accuracy.
    """
    if environment != "staging":
        return versions
    passed = gate(measured, threshold).filter(F.col("validation") == PASSED)
    newest = newest_models(versions, UNSTAGED)
    chosen = newest.join(passed.select("name", "version"), ["name", "version"], "left_semi")
    return promote(versions, chosen, STAGING)


def promote_to_production(versions: DataFrame) -> DataFrame:
    """Newest Staging version of each model to Production, without another check."""
    return promote(versions, newest_models(versions, STAGING), PRODUCTION)


def latest_tags(tags: DataFrame, order: Column | str = "logged_at") -> DataFrame:
    """The last value of every (run, key); equal moments are settled by value."""
    order = F.col(order) if isinstance(order, str) else order
    last = F.max(F.struct(order.alias("at"), "value"))
    return tags.groupBy("run_id", "key").agg(last.alias("last")).select("run_id", "key", "last.value")


def resolve_tags(
    versions: DataFrame, tags: DataFrame, keys: Sequence[str], order: Column | str = "logged_at"
) -> DataFrame:
    """Newest version of each model with its run's tags as columns.

    Tags of other runs and keys are left out before grouping, and one grouping both takes the
    last value and turns keys into columns.
    """
    newest = newest_models(versions)
    order = F.col(order) if isinstance(order, str) else order
    last = [
        F.max(F.when(F.col("key") == k, F.struct(order.alias("at"), "value")))["value"].alias(k)
        for k in keys
    ]
    wanted = tags.filter(F.col("key").isin(*keys)).join(newest.select("run_id"), "run_id", "left_semi")
    return newest.join(wanted.groupBy("run_id").agg(*last), "run_id", "left")
