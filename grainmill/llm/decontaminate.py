"""Benchmark decontamination: rare n-grams join documents to test items, alignment scores them.

An n-gram of a test item is rare if its words' frequencies in the corpus let it be expected by
chance less than once in ``1 / RARE`` words, however often it was really copied and however many
items have it. Documents are searched for these seeds; the words around a seed, as far as an
alignment of its item can reach, form a passage, and the passage is aligned with each item whose
seed it holds (Smith-Waterman over words), which finds edited and partly paraphrased copies too.
Items of equal words are aligned once. Seeds that the same items have are one class, so a text
that many items share joins its passages to them once and not once for each of its seeds. A
passage meets the items of a shared class only over a word of each item's rarer part, without
which no alignment could score enough: a phrase of all items pairs nobody by itself.

Words are compared lower-cased (A-Z) by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from grainmill.llm.text import fresh, flat, mixed, slices, word_hashes
from grainmill.session import materialise

N = 3  # words of a seed
RARE = 1e-8
MIN_SEEDS = 3  # an item with fewer rare n-grams uses its rarest others too
STRETCH = 16  # n-grams of an item, the rarest of which is a seed whether rare or not
SIMILARITY = 0.5
QUOTE = 50  # score that is enough for an item of any length, if it comes from nearly equal words
QUOTE_IDENTITY = 0.7  # score over the document's words that such a quote covers: 8 in 10 of them equal
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
FILTER_BITS = 25  # of the set of seeds that tasks test words against: 4 MB, whatever the benchmark's size
REACH_BITS = 18  # of the tables of how far the seeds' items reach: 2 MB
CELLS = 1 << 20  # of alignments computed side by side


def grams(words: np.ndarray, n: int = N) -> np.ndarray:
    """A hash of each run of ``n`` word hashes."""
    out = words[: len(words) - n + 1] if len(words) >= n else words[:0]
    for k in range(1, n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) ^ words[k : len(words) - n + 1 + k])
    return out


def bit_set(values: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    out = np.zeros(1 << (bits - 3), np.uint8)
    place = values & np.uint64((1 << bits) - 1)
    np.bitwise_or.at(out, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return out


def in_set(marks: np.ndarray, values: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    place = values & np.uint64((1 << bits) - 1)
    octet = marks[(place >> np.uint64(3)).astype(np.int64)]
    return (octet >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def set_of(values: DataFrame) -> np.ndarray:
    """The bit set of one long column's values; tasks make parts of it, whose number is fixed."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            marks |= bit_set(batch.column(0).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([marks.tobytes()])], names=["marks"])

    marks = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in values.coalesce(4).mapInArrow(part, "marks binary").toLocalIterator():
        marks |= np.frombuffer(row[0], np.uint8)
    return marks


def _slot(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64((1 << REACH_BITS) - 1)).astype(np.int64)


def reach_of(seed: DataFrame) -> np.ndarray:
    """Most words before and after each seed, by the low bits of its hash; made like ``set_of``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = np.zeros((2, 1 << REACH_BITS), np.uint32)
        for batch in batches:
            at = _slot(batch.column(0).to_numpy().view(np.uint64))
            for k in (0, 1):
                np.maximum.at(far[k], at, batch.column(k + 1).to_numpy().astype(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array([far.tobytes()])], names=["far"])

    far = np.zeros(2 << REACH_BITS, np.uint32)
    for row in seed.select("gram", "before", "after").coalesce(4).mapInArrow(part, "far binary").toLocalIterator():
        far = np.maximum(far, np.frombuffer(row[0], np.uint32))
    return far.reshape(2, -1)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, at = word_hashes(*flat(batch.column(1)))
        packed = [words[a:b].tobytes() for a, b in zip(at, at[1:])]
        each = [words[a:b].view(np.int64) for a, b in zip(at, at[1:])]
        gram = [grams(words[a:b]).view(np.int64) for a, b in zip(at, at[1:])]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary()), pa.array(each, longs), pa.array(gram, longs)],
            names=["item", "packed", "words", "grams"],
        )


def _counted(marks):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                words, _ = word_hashes(*flat(part))
                found, n = np.unique(words[in_set(marks.value, words)], return_counts=True)
                each = pa.array([None], pa.int64()), pa.array(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(each), pa.array(np.append(len(words), n))],
                    names=["word", "n"],
                )

    return count


def seeds(items: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(gram, item, before, after) of the seeds of ``items`` (item, words, grams), given the corpus' texts,
    and (word, log_p), the corpus' share of each of the items' words.

    These are the rare n-grams, the rarest of every ``STRETCH`` and the ``MIN_SEEDS`` rarest.
    An alignment through a seed that scores ``similarity`` reaches at most ``before`` words of a
    document before it and ``after`` words behind it: each word it skips costs ``GAP``.
    """
    spark = items.sparkSession
    words = items.select("item", F.posexplode("words").alias("at", "word"))
    marks = spark.sparkContext.broadcast(set_of(words.select("word")))
    counts = texts.mapInArrow(_counted(marks), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "benchmark-words")
    marks.unpersist()
    total = counts.where("word IS NULL").select("n").first()
    log_p = F.log10((F.coalesce("n", F.lit(0)) + 1) / ((total[0] if total else 0) + 1))
    scored = words.join(counts.where("word IS NOT NULL"), "word", "left").select("item", "at", log_p.alias("log_p"))
    share = counts.where("word IS NOT NULL").select("word", log_p.alias("log_p"))
    ahead = Window.partitionBy("item").orderBy("at").rowsBetween(0, N - 1)
    scored = scored.withColumn("log_p", F.sum("log_p").over(ahead))
    gram = items.select("item", F.size("words").alias("size"), F.posexplode("grams").alias("at", "gram"))
    gram = gram.join(scored, ["item", "at"])
    rarest = Window.partitionBy("item").orderBy("log_p", "gram", "at")
    local = Window.partitionBy("item", F.floor(F.col("at") / STRETCH)).orderBy("log_p", "gram", "at")
    ranked = gram.withColumns({"rank": F.row_number().over(rarest), "local": F.row_number().over(local)})
    wanted = (F.col("log_p") < float(np.log10(RARE))) | (F.col("rank") <= MIN_SEEDS) | (F.col("local") == 1)
    skipped = F.ceil(F.col("size") * max((1 - similarity) / -GAP, (1 - QUOTE_IDENTITY) / -GAP))
    chosen = ranked.where(wanted).groupBy("gram", "item").agg(
        F.max(F.col("at") + skipped).alias("before"), F.max(F.col("size") - N - F.col("at") + skipped).alias("after")
    )
    return materialise(chosen, "seeds"), share


def seed_classes(seed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, class) and (class, row) of ``seed`` (gram, item): seeds of the same items are one class."""
    mark = lambda n: F.bit_xor(F.xxhash64("item", F.lit(n)))
    held = seed.groupBy("gram").agg(mark(0).alias("a"), mark(1).alias("b"), F.count("*").alias("items"))
    named = Window.partitionBy("a", "b", "items")
    held = materialise(held.select("gram", F.min("gram").over(named).alias("class")), "seed-classes")
    first = held.where(F.col("gram") == F.col("class"))
    return held, first.join(seed, "gram").select("class", F.col("item").alias("row"))


def least(size, threshold: float):
    """Words of an item of ``size`` words that an alignment has to match at least."""
    return np.minimum(threshold * size, QUOTE)


def needed_words(items: DataFrame, share: DataFrame, similarity: float) -> DataFrame:
    """(row, word): the rarer words of each item, one of which a passage has to hold.

    An alignment matches ``least`` of an item's words, so it cannot do without all of the others
    and one more; these are taken to be the item's rarest, by their share of the corpus.
    """
    words = items.select("row", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    words = words.join(share, "word", "left")
    rarest = Window.partitionBy("row").orderBy(F.col("log_p").asc_nulls_first(), "word", "at")
    spare = F.col("size") - F.ceil(F.least(F.col("size") * similarity, F.lit(float(QUOTE))) - 1e-6)
    ranked = words.withColumn("rank", F.row_number().over(rarest))
    return ranked.where(F.col("rank") <= spare + 1).select("row", "word").distinct()


def candidates(
    hits: DataFrame, class_of: DataFrame, members: DataFrame, words: DataFrame, needed: DataFrame
) -> DataFrame:
    """(passage, row, seeds): the items each passage is aligned with, and how many of their seeds it has.

    ``hits`` (passage, gram) and ``words`` (passage, word) are what the passages hold. A class of
    one item pairs its passages at once; from a class of more, a passage meets those items only
    that need a word it has. What is left out could not be reported.
    """
    held = hits.join(class_of, "gram").groupBy("passage", "class").agg(F.count("*").alias("n"))
    sizes = members.groupBy("class").agg(F.count("*").alias("items"))
    held = materialise(held.join(sizes, "class"), "passage-classes")
    single = held.where("items = 1").join(members, "class").select("passage", "row", "n")
    shared = held.where("items > 1")
    wanted = members.join(sizes.where("items > 1").select("class"), "class").join(needed, "row")
    met = (
        shared.join(words, "passage")
        .join(wanted, ["class", "word"])
        .select("passage", "class", "n", "row")
        .distinct()
        .select("passage", "row", "n")
    )
    return single.union(met).groupBy("passage", "row").agg(F.sum("n").alias("seeds"))


PASSAGE = "first long, words binary, each array<long>, hits array<long>"


def _passages(marks, far):
    """Rows of the words around seeds, as far as the seeds reach; what overlaps is one row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, row = batch.column(0), 0
            out: list[tuple] = []
            for part in slices(batch.column(1)):
                words, at = word_hashes(*flat(part))
                gram = grams(words)
                hit = np.flatnonzero(in_set(marks.value, gram))
                doc = np.searchsorted(at, hit, "right") - 1
                inside = hit + N <= at[doc + 1]
                hit, doc = hit[inside], doc[inside]
                before, after = far.value[:, _slot(gram[hit])].astype(np.int64)
                start, end = np.maximum(at[doc], hit - before), np.minimum(at[doc + 1], hit + N + after)
                order = np.argsort(start, kind="stable")
                hit, doc, start, end = hit[order], doc[order], start[order], np.maximum.accumulate(end[order])
                new = np.ones(len(hit), bool)
                new[1:] = start[1:] >= end[:-1]
                edge = np.flatnonzero(new)
                for lo, hi in zip(edge, np.append(edge[1:], len(hit))):
                    d, first, last = int(doc[lo]), int(start[lo]), int(end[hi - 1])
                    each = np.unique(words[first:last]).view(np.int64)
                    hits = np.unique(gram[hit[lo:hi]]).view(np.int64)
                    out.append((row + d, first - int(at[d]), words[first:last].tobytes(), each, hits))
                row += len(part)
            longs = pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.binary(), longs, longs)
            columns = zip(*out) if out else ([], [], [], [], [])
            rows, *columns = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [keys.take(rows), *columns], names=["doc", "first", "words", "each", "hits"]
            )

    return find


def align(items: np.ndarray, sizes: np.ndarray, passages: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each row's item and passage: its score, and the passage word it ends with.

    Rows are filled up with words that match nothing. One step handles one item word of all rows:
    a gap along the passage is a running maximum once each column's cost is added.
    """
    rows, width = passages.shape
    slope = np.float32(-GAP) * np.arange(width, dtype=np.float32)
    above = np.zeros((rows, width), np.float32)
    best, where = np.zeros(rows, np.float32), np.zeros(rows, np.int64)
    open_ = np.arange(width) < lengths[:, None]
    for i in range(items.shape[1]):
        same = (passages == items[:, i, None]) & open_ & (i < sizes)[:, None]
        corner = np.zeros_like(above)
        corner[:, 1:] = above[:, :-1]
        now = np.maximum(corner + np.where(same, np.float32(MATCH), np.float32(MISMATCH)), above + np.float32(GAP))
        now = np.maximum.accumulate(np.maximum(now, 0) + slope, axis=1) - slope
        end = now.argmax(axis=1)
        top = now[np.arange(rows), end]
        better = top > best + 1e-6
        best[better], where[better] = top[better], end[better]
        above = now
    return best, where


def _padded(rows: list[np.ndarray], flip: bool = False) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    out = np.zeros((len(rows), int(sizes.max(initial=1))), np.uint64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r[::-1] if flip else r
    return out, sizes


def _align_rows(threshold: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("packed")]
            text = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("words")]
            # An item word matches once at most, so its words in the passage bound the score.
            bound = [least(len(x), threshold) for x in item]
            able = [i for i in range(len(item)) if np.isin(item[i], text[i]).sum() >= bound[i] - 1e-6]
            order = sorted(able, key=lambda i: (len(text[i]), len(item[i])))
            keep, score, start, stop = [], [], [], []
            at = 0
            while at < len(order):
                to = at + 1
                while to < len(order) and (to + 1 - at) * len(text[order[to]]) <= CELLS // 16:
                    to += 1
                mine = order[at:to]
                a, sizes = _padded([item[i] for i in mine])
                best, end = align(a, sizes, *_padded([text[i] for i in mine]))
                near = best / np.maximum(sizes, 1)
                good = [k for k in range(len(mine)) if near[k] >= threshold or best[k] >= QUOTE]
                if good:  # the same alignment from its end gives where it starts
                    a, sizes = _padded([item[mine[k]] for k in good], flip=True)
                    b, lengths = _padded([text[mine[k]][: end[k] + 1] for k in good], flip=True)
                    _, back = align(a, sizes, b, lengths)
                    for k, covered in zip(good, back):
                        if near[k] < threshold and best[k] < QUOTE_IDENTITY * (int(covered) + 1):
                            continue
                        keep.append(mine[k])
                        score.append(float(near[k]))
                        stop.append(int(end[k]) + 1)
                        start.append(int(end[k]) - int(covered))
                at = to
            first = batch.column("first").to_numpy(zero_copy_only=False)[keep] if keep else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array(keep, pa.int64())),
                    batch.column("row").take(pa.array(keep, pa.int64())),
                    batch.column("seeds").take(pa.array(keep, pa.int64())),
                    pa.array(score, pa.float64()),
                    pa.array(first + np.array(start, np.int64)),
                    pa.array(first + np.array(stop, np.int64)),
                ],
                names=["doc", "row", "seeds", "similarity", "first_word", "end_word"],
            )

    return work


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and test item whose best alignment scores ``similarity`` or more.

    The score is taken over the item's words. An alignment of a lower share counts too if it
    scores ``QUOTE`` or more and ``QUOTE_IDENTITY`` of the document's words that it covers: a long
    quote of part of a longer item. ``key`` and ``item`` may have any type that can be grouped.

    Columns: ``key``, ``item``, seeds (different seeds in the passage), similarity (alignment
    score over the item's words: 1 for a copy), first_word and end_word (the aligned words of the
    document, from 0, the end exclusive). Rows with equal keys count as one document, whose best
    alignment is given, the earliest of equals; equal item ids likewise; null keys and ids are
    values of their own. Null texts and items of fewer than ``N`` words match nothing. Other
    columns are ignored; an empty table on either side gives no rows.
    """
    named = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    item_kind = named.schema["item"].dataType.simpleString()
    named = named.mapInArrow(
        _word_rows, f"item {item_kind}, packed binary, words array<long>, grams array<long>"
    ).withColumn("row", F.xxhash64("packed"))
    named = materialise(named, "benchmark")
    items = materialise(named.drop("item").dropDuplicates(["row"]), "benchmark-texts")
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    inner = items.select(F.col("row").alias("item"), "words", "grams")
    seed, share = seeds(inner, texts, similarity)
    spread = docs.sparkSession.sparkContext.broadcast
    marks, far = spread(set_of(seed.select("gram"))), spread(reach_of(seed))
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    doc_kind = rows.schema["doc"].dataType.simpleString()
    found = materialise(rows.mapInArrow(_passages(marks, far), f"doc {doc_kind}, {PASSAGE}"), "passages")
    marks.unpersist()
    far.unpersist()
    passage = found.withColumn("passage", F.xxhash64("doc", "first", "words")).dropDuplicates(["passage"])
    class_of, members = seed_classes(seed)
    pairs = candidates(
        passage.select("passage", F.explode("hits").alias("gram")),
        class_of,
        members,
        passage.select("passage", F.explode("each").alias("word")),
        needed_words(items, share, similarity),
    )
    pairs = pairs.join(passage.select("passage", "doc", "first", "words"), "passage")
    pairs = pairs.join(items.select("row", "packed"), "row")
    # Batches of about as many rows for every task, however the joins dealt them.
    aligned = pairs.select("doc", "row", "seeds", "first", "words", "packed").mapInArrow(
        _align_rows(similarity),
        f"doc {doc_kind}, row long, seeds long, similarity double, first_word long, end_word long",
    )
    aligned = aligned.join(named.select("row", "item").distinct(), "row")
    best = aligned.groupBy("doc", "item").agg(
        F.max(F.struct("similarity", (-F.col("first_word")).alias("early"), "end_word", "seeds")).alias("b")
    )
    return best.select(
        F.col("doc").alias(key),
        F.col("item").alias(item),
        F.col("b.seeds").alias("seeds"),
        F.round("b.similarity", 6).alias("similarity"),
        (-F.col("b.early")).alias("first_word"),
        F.col("b.end_word").alias("end_word"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without those that ``leaks`` finds in the benchmark.

    Documents are told apart by a hash of their text, so ids may be missing or repeated.
    """
    name = fresh(docs, "text_hash")
    keyed = docs.withColumn(name, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    found = materialise(leaks(keyed, benchmark, name, text, **options).select(name).distinct(), "leaks")
    return keyed.join(found, name, "left_anti").select(*docs.columns)
