"""The given tables in the roles the queries need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grainmill.sources.scans import scan_parquet

OBS_KEYS = ["Id", "date", "hour"]
OBS_LOOKUP = ["Id", "hour"]
OBS_NAMES = {"m_value": "z_value", "m_k": "z_k", "m_user": "z_user", "m_minute": "z_minute"}
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CLASSES = [0, 1, 2]
DOC_FEATURES = ["n_chars", "n_words"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf}/{name}.parquet")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as keyed observations with four measures."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("Id"),
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("value").alias("m_value"),
        F.get_json_object("props", "$.k").cast("double").alias("m_k"),
        F.col("user_id").cast("double").alias("m_user"),
        F.minute("ts").cast("double").alias("m_minute"),
    )


def event_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("Id"),
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("target"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a unique key, four measures and a three-class label."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        *LINE_FEATURES,
        F.when(flag == "A", 0).when(flag == "N", 1).when(flag == "R", 2).alias("target"),
    )


def signal_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items whose class follows from a feature, so that a model can learn it."""
    cut = F.when(F.col("l_quantity") < 17, 0).when(F.col("l_quantity") < 34, 1).otherwise(2)
    return lines(spark, sf).withColumn("target", cut)


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", "n_chars", F.size(F.split("text", " ")).alias("n_words")
    )


def document_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("target"))


def model_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a version log: a customer is a model, an order one of its versions."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.when(status == "O", "None").when(status == "P", "Staging").otherwise("Production").alias("stage"),
        F.col("o_orderkey").alias("run_id"),
    )


def measured_models(spark: SparkSession, sf: str) -> DataFrame:
    """A measured accuracy per version, from the order total."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        (F.col("o_totalprice") / 500000.0).alias("accuracy"),
    )


def run_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as tags of a run (the order), logged at the ship date."""
    key = F.when(F.col("l_linestatus") == "F", "train_dataset_version").otherwise("test_dataset_version")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        key.alias("key"),
        F.col("l_partkey").alias("value"),
        F.col("l_shipdate").alias("logged_at"),
    )
