"""Source divergence audit: how far each source's use of terms lies from other sources' and its language's.

A CountVectorizer for each language: every document becomes its exact sparse vector of term
counts, terms in at least ``min_df`` documents of the language are its vocabulary, which may be
as large as integers go. The vocabulary is a table: it is neither collected nor broadcast, so
vectors hold terms and not places in an array. Vectors are summed by language and source as
``Summarizer`` would, first within a task's slice of documents, then by Spark.

Sources of a language are compared on what both of them hold. What only one of them holds, or
neither, follows from how often each count occurs, so no pair is evaluated over a dense vocabulary:
with p0 and q0 the shares of absent terms, the sum over all V terms of f(p, q) is

    sum over own terms of f(p, q0) + sum over the other's terms of f(p0, q)
    + (V - own - other's) f(p0, q0) + sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0).

All arithmetic is in whole numbers. A share times 10**9 is divided digit by digit in base 1,000,
so counts may reach 9 * 10**15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.llm.terms import vectors
from grainmill.llm.text import slices
from grainmill.session import materialise

MIN_DF = 10
VOCAB_SIZE = 2**31 - 1  # terms that a language may keep; more raise an error, none is dropped
TOP = 10
SLICE = 8 << 20  # bytes of text whose vectors are summed at once

SUMS = "lang string, source string, term string, n long, n_docs long"
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = True
_TERM[128:] = True


def _group_sums(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
    """Sums of the documents' vectors by language and source; a group's own row has no term."""
    terms, row, code, count = vectors(texts, _TERM.__getitem__)
    groups = pa.StructArray.from_arrays([langs, sources], ["lang", "source"]).to_pylist()
    number: dict[tuple, int] = {}
    of_row = np.array([number.setdefault((g["lang"], g["source"]), len(number)) for g in groups], np.int64)
    size = max(1, len(terms))
    cell, place = np.unique(of_row[row] * size + code, return_inverse=True)
    n = np.bincount(place, count, len(cell)).astype(np.int64) if len(cell) else cell
    n_docs = np.bincount(place, minlength=len(cell)).astype(np.int64)
    names = list(number)
    group = np.concatenate([cell // size, np.arange(len(names))])
    none = np.zeros(len(names), np.int64)
    lang, source = (pa.array([g[i] for g in names], pa.string()).take(pa.array(group)) for i in (0, 1))
    own = terms.take(pa.array(cell % size)).cast(pa.binary()).cast(pa.string())
    term = pa.concat_arrays([own, pa.nulls(len(names), pa.string())])
    return pa.RecordBatch.from_arrays(
        [lang, source, term, pa.array(np.concatenate([n, none])), pa.array(np.concatenate([n_docs, none]))],
        ["lang", "source", "term", "n", "n_docs"],
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in slices(batch.column("text"), SLICE):
            part = batch.slice(at, len(texts))
            at += len(texts)
            yield _group_sums(texts, part.column("lang"), part.column("source"))


def term_sums(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of each term in each group.

    Every group also has a row without a term. Nulls in the three columns count as ''. A group
    or a term that most rows share arrives as one row of each slice of documents.
    """
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(text).cast("string"), empty).alias("text"),
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source).cast("string"), empty).alias("source"),
    )
    parts = rows.mapInArrow(_summed, SUMS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 (count + 2) / (total + 2 terms)), without a product beyond 64 bits."""
    whole = total + 2 * terms
    quotient, rest = F.lit(0).cast("long"), count + 2
    # count + 2 is at most ``whole``, so each product is at most 1,000 times ``whole``.
    for _ in range(3):
        scaled = rest * 1000
        quotient, rest = quotient * 1000 + _div(scaled, whole), scaled % whole
    return quotient + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); shares are at most 10**9 + 1, so the square fits 64 bits."""
    return _div((p - q) * (p - q), p + q)


def vocabulary(sums: DataFrame, min_df: int = MIN_DF, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """(lang, term, lang_n) of the terms that lie in at least ``min_df`` documents of their language."""
    terms = sums.where("term IS NOT NULL").groupBy("lang", "term")
    kept = terms.agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("df")).where(F.col("df") >= min_df)
    kept = materialise(kept.drop("df"), "divergence-terms")
    large = kept.groupBy("lang").count().where(F.col("count") > vocab_size).first()
    if large:
        raise ValueError(f"language {large['lang']!r} keeps {large['count']} terms, more than {vocab_size}")
    return kept


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources; f is symmetric."""
    own = ["lang", "source", "g_n", "g_terms", "vocab", "p0"]
    one, other = groups.select(*own), groups.select("lang", *[F.col(c).alias(f"o_{c}") for c in own[1:]])
    # What one group holds and the other need not: as many times as a count occurs in the group.
    counts = kept.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    held = counts.join(other, "lang").where("source <> o_source")
    held = held.groupBy("lang", "source", "o_source").agg(F.sum(F.col("terms") * gap(F.col("p"), F.col("o_p0"))).alias("held"))
    # What both hold; the smaller name comes first.
    a = kept.select("lang", "term", "source", "p", "p0")
    b = kept.select("lang", "term", *[F.col(c).alias(f"o_{c}") for c in ("source", "p", "p0")])
    p, q, p0, q0 = (F.col(c) for c in ("p", "o_p", "p0", "o_p0"))
    more = gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)
    shared = a.join(b, ["lang", "term"]).where("source < o_source")
    shared = shared.groupBy("lang", "source", "o_source").agg(F.sum(more).alias("value"))
    swapped = shared.select("lang", F.col("o_source").alias("source"), F.col("source").alias("o_source"), "value")
    turned = held.select("lang", F.col("o_source").alias("source"), F.col("source").alias("o_source"), F.col("held").alias("value"))
    absent = (F.col("vocab") - F.col("g_terms") - F.col("o_g_terms")) * gap(p0, q0)
    none = one.join(other, "lang").where("source <> o_source")
    none = none.select("lang", "source", "o_source", F.coalesce(absent, F.lit(0)).alias("value"))
    parts = none.unionByName(shared).unionByName(swapped).unionByName(turned).unionByName(held.withColumnRenamed("held", "value"))
    return parts.groupBy("lang", "source", F.col("o_source").alias("item")).agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_df: int = MIN_DF,
    top: int = TOP,
    vocab_size: int = VOCAB_SIZE,
) -> DataFrame:
    """lang, source, part, item, value, rank: each source's distance to others, and its own terms.

    Part ``pair``: every other source of the language, by the sum of f over all kept terms. Part
    ``term``: the ``top`` kept terms that the source uses more than its language does, by f. f of
    two shares p and q is (p - q)**2 / (p + q), rounded down. Ranks follow falling values, then
    rising names in UTF-8 order.

    Nulls in the three columns count as ''. A group without terms is compared like any other; a
    language that keeps no term gives pairs of value 0. A source that is alone in its language has
    no pairs. Repeated rows count as often as they come; other columns are not read; no rows give
    no rows. The pairs of one language are as many as the square of its sources, as asked for.
    """
    sums = materialise(term_sums(docs, text, lang, source), "divergence-sums")
    terms = vocabulary(sums, min_df, vocab_size)
    kept = sums.drop("n_docs").join(terms, ["lang", "term"])
    # One row of each group and language from here on; stored, so that the planner knows their size.
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("g_n"), F.count("*").alias("g_terms"))
    whole = terms.groupBy("lang").agg(F.sum("lang_n").alias("l_n"), F.count("*").alias("vocab"))
    groups = sums.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left")
    groups = groups.join(whole, "lang", "left").na.fill(0, ["g_n", "g_terms", "l_n", "vocab"])
    p0 = F.when(F.col("vocab") > 0, share(F.lit(0), F.col("g_n"), F.col("vocab")))
    groups = materialise(groups.withColumn("p0", p0), "divergence-groups")
    kept = kept.join(groups, ["lang", "source"])
    kept = materialise(
        kept.select(
            "lang", "source", "term", "p0",
            share(F.col("n"), F.col("g_n"), F.col("vocab")).alias("p"),
            share(F.col("lang_n"), F.col("l_n"), F.col("vocab")).alias("q"),
        ),
        "divergence-kept",
    )
    ahead = kept.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [
        part.withColumn("part", F.lit(name)).withColumn("rank", F.row_number().over(by_value))
        for name, part in (("pair", _pairs(kept, groups)), ("term", ahead))
    ]
    out = ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
    return out.select("lang", "source", "part", "item", "value", "rank")
