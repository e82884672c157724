"""Documents made ready for training, in five stages that each read what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from grainmill.llm import bpe, decontaminate, quality, secrets, simhash
from grainmill.llm.text import table
from grainmill.session import materialise

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one of the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; the number of characters follows."""
    found = secrets.scan(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    text = secrets.masked(F.col("text"), F.col("secret_spans"))
    masked = found.select("row", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return masked.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of the bytes that they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), BPE_RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), BPE_RANKS), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", encoding),
]

# No SQL: estimates from quantile sketches, links along chains, alignments and merges have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
