"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from grainmill.llm import bpe, decontaminate, divergence, kneser_ney, oracles, packing, quality, secrets, sharding, simhash, spelling, suffix_dedup, toxicity, unigram_counts
from grainmill.llm.text import table
from grainmill.session import materialise

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UNIGRAM_PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL_JSON = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 40
MAX_TOKENS = 1024
MAX_SEGMENTS = 64
END_ID = 0


def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), BPE_RANKS), 256).alias("decoded_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    stats = materialise(quality.measured(docs).drop("text"), "quality-stats")
    judged = quality.judge(stats)
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "distance")


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return unigram_counts.count_tokens(docs, UNIGRAM_PIECES).select("doc_id", "n_tokens", "token_score")


def op5_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7))
    docs = docs.select("doc_id", "text", (fold == 2).alias("held_out"))
    model = kneser_ney.train(docs.where(~F.col("held_out")))
    scored = docs.select("doc_id", "held_out", kneser_ney.score(F.col("text"), model).alias("s"))
    return scored.select(
        "doc_id",
        "held_out",
        "s.n_tokens",
        "s.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "s.base_score",
        "s.score",
    )


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    docs = docs.select("doc_id", "text", "lang", (fold == 1).alias("held_out"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    net, thresholds = toxicity.train(docs.where(~F.col("held_out")), "text", "label", "doc_id", "lang", labels=labels)
    scored = docs.select("doc_id", "held_out", "lang", toxicity.score(F.col("text"), net).alias("score"))
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= toxicity.AT).cast("int").alias("predicted"),
        toxicity.flagged(F.col("lang"), F.col("score"), thresholds).alias("flagged"),
    )


def op7_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    base, every = F.col("base_spans"), F.col("secret_spans")
    return secrets.scan(docs).select(
        "doc_id",
        *[secrets.count_of(base, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.render(base), 256).alias("base_sha256"),
        secrets.render(every).alias("spans"),
    )


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    removed, kept = F.col("removed_spans"), F.col("kept_bytes")
    n_removed = F.aggregate(removed, F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        (F.octet_length(kept) + n_removed).cast("long").alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign(table(spark, sf, "documents"), SHARDS)


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf, "documents")))


def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", packing.token_ids(F.col("text"), BYTE_LEVEL_JSON, END_ID).alias("ids"))
    rows = rows.withColumn("doc_tokens", (F.octet_length("ids") / 4).cast("long"))
    # All tokens of a document bear loss.
    pieces = packing.pack(rows, MAX_TOKENS, MAX_SEGMENTS, MAX_TOKENS, keep=["doc_id", "doc_tokens"], powers=True)
    return pieces.select(
        "doc_id",
        F.col("piece_start").alias("start"),
        (F.octet_length("piece_ids") / 4).cast("long").alias("length"),
        F.crc32("piece_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        F.col("sequence_offset").alias("offset"),
    )


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


REGISTERED = (
    op1_byte_bpe,
    op2_decontamination,
    op3_quality_rules,
    op4_token_counts,
    op5_kneser_ney,
    op6_toxicity,
    op7_secret_scans,
    op8_suffix_dedup,
    op9_simhash,
    op10_sharding,
    op11_spelling,
    op12_packing,
    op13_divergence,
)


def queries() -> dict:
    return {f.__name__: f for f in REGISTERED} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL where SQL can express a query; the others are tested against brute force."""
    sql = {
        "op10_sharding": oracles.sharding(SHARDS),
        "op11_spelling": oracles.spelling(spelling.MIN_LENGTH, spelling.MIN_COUNT, spelling.RATIO, spelling.SPARE),
        "op13_divergence": oracles.divergence(divergence.MIN_DF, divergence.TOP),
    }
    return sql if corpus_pipeline.ORACLE_SQL is None else sql | {"pipeline": corpus_pipeline.ORACLE_SQL}
