"""Spelling variants: words one edit apart, by a dictionary of trie-node pairs.

The words' prefixes are the nodes of a forward trie and their suffixes those of a reversed one;
both tries are numbered. Cutting a word at a position gives the pair (prefix node, suffix node),
and leaving out the letter there gives the pair of the nodes around it. Two words that share a
left-out pair differ by a replaced letter, and a word whose cut pair is another's left-out pair
lacks one letter of it. So joins of integer pairs give exactly the words at one edit.

A trie is numbered in blocks of words that follow each other in order. A node belongs to the first
block that has it, so nodes on the border of two blocks must get one number in both: from its last
word backwards a block numbers the nodes, so those of its last word are 0, 1, ... by depth, and later
blocks know them by owner and depth alone. Of each block only two lengths reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.llm.terms import vectors
from grainmill.llm.text import slices
from grainmill.session import materialise

MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2
RATIO = 10  # a form is so many times as frequent
SPARE = 31  # one of so many runs loses a letter
SLICE = 8 << 20  # bytes of text whose words are counted at once
BLOCK_WORDS = 100_000  # words that are numbered in one task, about
BLOCK_CHARS = 4_000_000
_BLOCK = 1 << 40  # numbers of a block's nodes

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to ASCII letters or to U+00C0 to U+00FF, all of which begin with C3."""
    lead = data == 0xC3
    member = _LETTER[data] | lead
    member[1:] |= lead[:-1]
    return member


def _word_counts(keys: list[str], texts: pa.Array, spare: int, min_length: int) -> pa.RecordBatch:
    terms, row, code, count = vectors(texts, letters)
    lengths = pc.utf8_length(terms.cast(pa.large_string())).to_numpy(zero_copy_only=False)
    long = lengths[code] >= min_length if len(code) else np.zeros(0, bool)
    row, code, count = row[long], code[long], count[long]
    words = terms.to_pylist()
    seeds = np.array([crc32(f"{k}:".encode()) for k in keys], np.int64)[row].tolist()
    hashes = np.fromiter(map(crc32, map(words.__getitem__, code.tolist()), seeds), np.int64, len(code))
    cut = hashes % spare == 0
    total = np.bincount(code[~cut], count[~cut], len(words)).astype(np.int64)
    shorter: Counter[str] = Counter()
    for c, h, n in zip(code[cut].tolist(), hashes[cut].tolist(), count[cut].tolist()):
        word = words[c].decode()
        at = h % len(word)
        if len(word) > min_length:
            shorter[word[:at] + word[at + 1 :]] += n
    used = np.flatnonzero(total)
    whole = terms.take(pa.array(used)).cast(pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([whole, pa.array(list(shorter), pa.string())]),
            pa.array(np.concatenate([total[used], np.fromiter(shorter.values(), np.int64, len(shorter))])),
        ],
        ["word", "n"],
    )


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    spare: int = SPARE,
) -> DataFrame:
    """(word, n) of the words of ``min_length`` code points that occur ``min_count`` times or more.

    Words are runs of letters with A-Z in lower case. Of a run whose checksum with its document's
    key is divisible by ``spare`` the letter at checksum modulo length is left out. Null texts have
    no words, a null key is the empty text. Counts are added up within slices of documents first,
    so a word that most documents hold is one row of each slice.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = batch.column("key").to_pylist(), 0
            for texts in slices(batch.column("text"), SLICE):
                yield _word_counts(keys[at : at + len(texts)], texts, spare, min_length)
                at += len(texts)

    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(key).cast("string"), empty).alias("key"),
        F.coalesce(F.col(text).cast("string"), empty).alias("text"),
    )
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def owners(edges: list[tuple[int, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """Per block the (greatest depth, owner) runs of the nodes that it has from earlier blocks.

    ``edges`` lists, in the order of blocks, the block, what its first word has in common with the
    last word before it (-1 for the first block), and with its own last word.
    """
    out, path = {}, []

    def upto(runs: list[tuple[int, int]], depth: int) -> list[tuple[int, int]]:
        kept = [r for r in runs if r[0] < depth]
        return kept + [(depth, runs[len(kept)][1])] if len(kept) < len(runs) and depth >= 0 else kept

    for block, before, within in edges:
        out[block] = upto(path, before)
        path = [*upto(out[block], within), (1 << 62, block)]
    return out


def number_block(words: list[str], block: int, inherited: list[tuple[int, int]]) -> list[list[int]]:
    """The nodes of every prefix of the words, the empty one first; ``words`` are sorted and differ."""
    out, after, nodes, fresh = [], "", [], block * _BLOCK
    for word in reversed(words):
        shared = common(word, after) + 1 if nodes else 0
        new = len(word) + 1 - shared
        nodes = [*nodes[:shared], *range(fresh, fresh + new)]
        fresh, after = fresh + new, word
        out.append(nodes)
    out.reverse()
    owned = [owner * _BLOCK + i for (start, owner), stop in _runs(inherited) for i in range(start, stop)]
    before = words[0] if words else ""
    left = len(owned)
    for word, nodes in zip(words, out):
        left = min(left, common(before, word) + 1)
        nodes[:left] = owned[:left]
        before = word
    return out


def _runs(inherited: list[tuple[int, int]]) -> Iterator[tuple[tuple[int, int], int]]:
    start = 0
    for depth, owner in inherited:
        yield (start, owner), depth + 1
        start = depth + 1


def number_trie(words: DataFrame, block_words: int = BLOCK_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, place, nodes) of distinct ``word``: the numbers of its prefixes, the empty one first.

    ``place`` rises with the word. Two words have a number in common exactly where they have the prefix in common.
    """
    size = words.agg(F.count("*").alias("n"), F.sum(F.length("word")).alias("chars")).first()
    parts = max(1, math.ceil(size["n"] / block_words), math.ceil((size["chars"] or 0) / block_chars))
    blocks = words.select("word").repartitionByRange(parts, "word").withColumn("block", F.spark_partition_id())
    blocks = materialise(blocks, "trie-blocks")

    @F.arrow_udf("int")
    def shared(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([-1 if x is None or y is None else common(x, y) for x, y in pairs], pa.int32())

    ends = blocks.groupBy("block").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    # One row of a block: so many words fewer than the dictionary has.
    before = F.lag("last").over(Window.orderBy("block"))
    ends = ends.select("block", "first", "last", before.alias("before"))
    edges = ends.select("block", shared("before", "first"), shared("first", "last")).orderBy("block").collect()
    known = owners([tuple(r) for r in edges])

    def number(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        ordered = sorted(table.column("word").to_pylist())
        nodes = number_block(ordered, block, known[block])
        ends = np.zeros(len(nodes) + 1, np.int32)
        np.cumsum([len(x) for x in nodes], out=ends[1:])
        flat = np.fromiter((i for x in nodes for i in x), np.int64, int(ends[-1]))
        place = np.arange(len(ordered), dtype=np.int64) + block * _BLOCK
        return pa.table(
            {
                "word": pa.array(ordered, pa.string()),
                "place": pa.array(place),
                "nodes": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            }
        )

    return blocks.groupBy("block").applyInArrow(number, "word string, place long, nodes array<long>")


def _pair(prefix: Column, suffix: Column, *more: Column) -> Column:
    return F.struct(prefix.alias("p"), suffix.alias("s"), *more)


def dictionary(words: DataFrame, **options) -> DataFrame:
    """``words`` with ``place``, ``nodes`` of the prefixes and ``turned``: nodes of the suffixes, the shortest first."""
    back = number_trie(words.select(F.reverse("word").alias("word")), **options)
    back = back.select(F.reverse("word").alias("word"), F.col("nodes").alias("turned"))
    return words.join(number_trie(words, **options), "word").join(back, "word")


def neighbours(rows: DataFrame) -> DataFrame:
    """(place, n, other, other_n): every ordered pair of words at one edit, once; ``rows`` is a stored ``dictionary``.

    A pair of nodes is shared by at most as many words as the alphabet has letters.
    """
    length, chars = F.length("word"), F.split("word", "")
    # Leaving out any letter of a run of equal ones gives the same word: only the first counts.
    once = lambda i: (i == 0) | (F.get(chars, i) != F.get(chars, i - 1))
    left_out = F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: _pair(F.get("nodes", i), F.get("turned", length - 1 - i), once(i).alias("once")),
    )
    cut = F.transform(F.sequence(F.lit(0), length), lambda i: _pair(F.get("nodes", i), F.get("turned", length - i)))
    skips = rows.select("place", "n", F.explode(left_out).alias("x")).select("place", "n", "x.*")
    cuts = rows.select(F.col("place").alias("other"), F.col("n").alias("other_n"), F.explode(cut).alias("x"))
    others = skips.select(F.col("place").alias("other"), F.col("n").alias("other_n"), "p", "s")
    columns = ["place", "n", "other", "other_n"]
    replaced = skips.join(others, ["p", "s"]).where("place <> other").select(*columns)
    longer = skips.where("once").join(cuts.select("other", "other_n", "x.*"), ["p", "s"]).select(*columns)
    shorter = longer.select(*[F.col(a).alias(b) for a, b in zip(columns[2:] + columns[:2], columns)])
    return replaced.unionByName(longer).unionByName(shorter)


def roots(forms: DataFrame) -> DataFrame:
    """(place, root) of (place, form): the end of each chain of forms.

    Forms grow by a factor at each step, so chains are short; each round doubles what is followed.
    """
    now = materialise(forms.select("place", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("place").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left")
        step = materialise(step.select("place", "root", "next"), "spelling-roots")
        now = step.select("place", F.coalesce("next", "root").alias("root"))
        if step.where("next IS NOT NULL").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; ``word`` differs).

    n_near: the words at exactly one inserted, deleted or replaced code point. form: the most
    frequent of them, of equals the first in code-point order, if it has at least ``ratio`` times
    the word's n; else null. root: where following forms from the word ends; the word itself if it
    has no form. Null and empty words are left out; no rows give no rows; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than the word, or chains need not end")
    words = materialise(words.where("word <> ''").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    places = materialise(dictionary(words, **options), "spelling-places")
    near = neighbours(places)
    best = near.groupBy("place").agg(
        F.first("n").alias("n"),
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"),
    )
    best = materialise(best.select("place", "n", "n_near", "best.form", (-F.col("best.less")).alias("form_n")), "spelling-near")
    chosen = best.where(F.col("form_n") >= ratio * F.col("n"))
    named = chosen.join(roots(chosen), "place")
    for column in ("form", "root"):
        named = named.join(places.select(F.col("place").alias(column), F.col("word").alias(f"{column}_word")), column)
    named = named.select("place", "form_word", "root_word", "form_n")
    out = places.select("word", "n", "place").join(best.select("place", "n_near"), "place", "left").join(named, "place", "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
