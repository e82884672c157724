"""An interpolated modified Kneser-Ney language model of word pairs, counted in Spark.

Tokens are lower-cased words and one end per text. Tasks count the pairs of their texts as sorted
64-bit hashes and send them out by ranges of the first word's hash, then of the pair's; a range's
task adds them up and stores sorted arrays. Pairs of a first word that is very frequent are spread
over all ranges.
A second exchange, of what is known of single words, gives each word's count, the words it was
seen after, and what follows it. Scoring tasks map the arrays into memory and find their texts'
pairs by binary search.

Pairs, not longer sequences: of the test documents' different triples 86 in 100 are seen once, so
they would take several times the disk space of pairs, which is three times the input already.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from grainmill.llm.text import flat, mixed, slices, word_hashes
from grainmill.session import scratch_path

BUCKET_BYTES = 16 << 20  # of text for each range of hashes
FIRST_BITS = 12  # of a range's number at most that the first word decides
RUN_TOKENS = 3 << 20  # tokens counted together in a task
SCORE_BYTES = 2 << 20  # of text looked up together
END, BEGIN = (int(x) for x in mixed(np.arange(1, 3, dtype=np.uint64)))  # stand for no word
COUNTS = ("count", "after", "total", "n1", "n2", "n3")  # of a word: itself, words before it, pairs it begins


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int  # there are 2**bits ranges
    first_bits: int
    hot: tuple[int, ...]  # first words whose pairs are spread, 8 << first_bits at most
    tokens: int
    words: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pairs: int
    word_kinds: tuple[int, int, int]  # words seen after one, two, more other words


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' tokens, and where each row's begin."""
    hashes, at = word_hashes(data, offsets)
    return np.insert(hashes, at[1:], np.uint64(END)), at + np.arange(len(at))


def pairs_of(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.empty_like(tokens)
    first[1:] = tokens[:-1]
    first[at[:-1]] = BEGIN
    return first, tokens


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) ^ second)


def route(first: np.ndarray, pair: np.ndarray, hot: np.ndarray, first_bits: int = FIRST_BITS) -> np.ndarray:
    """What decides the range that holds a pair: ``first_bits`` of its first word, then the pair.

    Where the first word is hot the pair decides alone. A word is hot above a share of all
    tokens that does not fall with the ranges, so the hot words do not grow with the corpus: the
    pairs of any other word are dealt over all ranges that share its leading bits.
    """
    low = np.uint64((1 << (64 - first_bits)) - 1)
    mostly = (first & ~low) | (pair & low)
    if not len(hot):
        return mostly
    place = np.minimum(np.searchsorted(hot, first), len(hot) - 1)
    return np.where(hot[place] == first, pair, mostly)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their rows of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first, axis=0) if len(keys) else values


def _token_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first, second) of all pairs of a task, in runs of about ``RUN_TOKENS``."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch.column(0)):
            held.append(pairs_of(*tokens_of(*flat(part))))
            size += len(held[-1][0])
            if size >= RUN_TOKENS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _frequent(share: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, _ in _token_runs(batches):
            words, n = np.unique(first, return_counts=True)
            words, n = words[n >= share * len(first)], n[n >= share * len(first)]
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return count


def _count_pairs(bits: int, hot: np.ndarray, first_bits: int):
    """A row for each range: its pairs by first word, whose hash comes once, with how many follow."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second in _token_runs(batches):
            pair = pair_hash(first, second)
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            one = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            n = np.diff(np.append(one, len(pair)))
            first, second, pair = first[order[one]], second[order[one]], pair[one]
            bucket = _bucket(route(first, pair, hot, first_bits), bits)
            order = np.argsort(first, kind="stable")
            order = order[np.argsort(bucket[order], kind="stable")]
            yield from _blobs("pair", bucket[order], first=first[order], second=second[order], n=n[order])

    return count


def _values(n: int, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros((n, len(COUNTS)), np.int64)
    for name, column in columns.items():
        out[:, COUNTS.index(name)] = column
    return out


BLOB = "kind string, bucket long, a binary, b binary, c binary"


def _blobs(kind: str, bucket: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket's slice of the columns; ``bucket`` is sorted."""
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for lo, hi in zip(edges, np.append(edges[1:], len(bucket))):
        part = {k: v[lo:hi] for k, v in columns.items()}
        if kind == "pair":
            new = np.flatnonzero(np.concatenate([[True], part["first"][1:] != part["first"][:-1]]))
            run = np.diff(np.append(new, hi - lo)).astype(np.uint32)
            heads = np.stack([part["first"][new], run.astype(np.uint64)])
            row = [heads.tobytes(), part["second"].tobytes(), part["n"].astype(np.uint32).tobytes()]
        else:
            used = np.flatnonzero(part["values"].any(axis=0)).astype(np.uint8)
            row = [part["words"].tobytes(), part["values"][:, used].astype("<u8").tobytes(), used.tobytes()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([kind]),
                pa.array([int(bucket[lo])], pa.int64()),
                *[pa.array([x], pa.binary()) for x in row],
            ],
            names=["kind", "bucket", "a", "b", "c"],
        )


def _store(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array so that a task that runs again replaces the same file with the same bytes."""
    files, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with files.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(array).data)
    files.move(draft, path)


def _open(folder: str, name: str, kind: str) -> np.ndarray:
    """An array file: mapped into memory where the folder is a mounted one, else read."""
    files, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    info = files.get_file_info(path)
    if info.type != fs.FileType.File or not info.size:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as data:
        return np.frombuffer(data.read(), kind)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest unsigned type that holds them; its width is seen from the file's size."""
    most = int(values.max(initial=0))
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most < 256 ** int(t[2])))


def _table(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(
        batches,
        pa.schema([("kind", pa.string()), ("bucket", pa.int64()), *[(k, pa.binary()) for k in ("a", "b", "c")]]),
    )


def _pair_range(folder: str, bits: int):
    """Add up one range's pairs, store them, and send out what they say of their words."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        first, second, n = [], [], []
        for a, b, c in zip(*(rows.column(k) for k in ("a", "b", "c"))):
            heads = np.frombuffer(a.as_py(), np.uint64).reshape(2, -1)
            first.append(np.repeat(heads[0], heads[1].astype(np.int64)))
            second.append(np.frombuffer(b.as_py(), np.uint64))
            n.append(np.frombuffer(c.as_py(), np.uint32).astype(np.int64))
        first, second, n = (np.concatenate(x) for x in (first, second, n))
        pair = pair_hash(first, second)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        one = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        n = np.add.reduceat(n[order], one)
        first, second, pair = first[order[one]], second[order[one]], pair[one]
        name = f"{key[0].as_py():08d}"
        _store(folder, f"pair-{name}.hash", pair)
        _store(folder, f"pair-{name}.count", _narrow(n))
        kinds = [n == i for i in (1, 2, 3, 4)]
        begun = _values(len(n), total=n, n1=kinds[0], n2=kinds[1], n3=n > 2)
        ended = _values(len(n), count=n, after=1)
        words, values = _added(np.concatenate([first, second]), np.concatenate([begun, ended]))
        said = np.array([len(n), *[k.sum() for k in kinds]], "<i8").tobytes()
        told = pa.RecordBatch.from_arrays(
            [pa.array(["pairs"]), pa.array([key[0].as_py()], pa.int64()), *[pa.array([x], pa.binary()) for x in (said, b"", b"")]],
            names=["kind", "bucket", "a", "b", "c"],
        )
        return _table([told, *_blobs("word", _bucket(words, bits), words=words, values=values)])

    return work


SAID = ("pairs", "p1", "p2", "p3", "p4", "tokens", "words", "k1", "k2", "k3", "k4", "more")


def _word_range(folder: str):
    """Add up what is known of one range's words and store it; pass on the counts of pairs."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        said = dict.fromkeys(SAID, 0)
        if key[0].as_py() == "pairs":
            for a in rows.column("a"):
                for k, v in zip(SAID, np.frombuffer(a.as_py(), "<i8")):
                    said[k] += int(v)
        else:
            words, values = [], []
            for a, b, c in zip(*(rows.column(k) for k in ("a", "b", "c"))):
                words.append(np.frombuffer(a.as_py(), np.uint64))
                used = np.frombuffer(c.as_py(), np.uint8)
                full = np.zeros((len(words[-1]), len(COUNTS)), np.int64)
                full[:, used] = np.frombuffer(b.as_py(), "<u8").reshape(-1, len(used))
                values.append(full)
            words, values = _added(np.concatenate(words), np.concatenate(values))
            name = f"{key[1].as_py():08d}"
            _store(folder, f"word-{name}.hash", words)
            _store(folder, f"word-{name}.counts", _narrow(values))
            count, after = values[:, 0], values[:, 1]
            said |= {"tokens": int(count.sum()), "words": int((count > 0).sum()), "more": int((after > 2).sum())}
            said |= {f"k{i}": int((after == i).sum()) for i in (1, 2, 3, 4)}
        return pa.table({k: pa.array([v], pa.int64()) for k, v in said.items()})

    return work


def discounts(n: tuple[int, ...]) -> tuple[float, float, float]:
    """What is taken from counts 1, 2 and more, from how many keys have counts 1 to 4.

    Where one of these is missing, or a discount would not lie between 0 and its count, as in
    very small corpora: 1/2, 1 and 3/2.
    """
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        made = tuple(i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3))
        if all(0 <= d <= i for i, d in zip((1, 2, 3), made)):
            return made
    return (0.5, 1.0, 1.5)


def train(
    docs: DataFrame, text: str = "text", bucket_bytes: int = BUCKET_BYTES, first_bits: int = FIRST_BITS
) -> Model:
    """Count and store a model of all texts; null ones count as empty, which still have an end.

    The number of ranges follows the size of the texts. To the driver come that size, sums over
    the ranges, and the most frequent words, at most eight for each range and ``8 << first_bits``
    in a corpus of any size. A word that makes up a quarter of the share of all tokens that one
    value of the leading bits has is among them: it has half of that share in enough of the
    tasks' runs.
    """
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, size / bucket_bytes)))))
    most = 8 << min(bits, first_bits)
    found = texts.mapInArrow(_frequent(1 / most), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "word").limit(most).collect()
    hot = np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    folder = scratch_path(docs.sparkSession, "kn-model")
    pairs = texts.mapInArrow(_count_pairs(bits, hot, first_bits), BLOB)
    words = pairs.groupBy("bucket").applyInArrow(_pair_range(folder, bits), BLOB)
    said = words.groupBy("kind", "bucket").applyInArrow(_word_range(folder), ", ".join(f"{k} long" for k in SAID))
    n = said.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in SAID]).first()
    return Model(
        folder,
        bits,
        first_bits,
        tuple(int(h) for h in hot),
        n["tokens"],
        n["words"],
        discounts((n["p1"], n["p2"], n["p3"], n["p4"])),
        discounts((n["k1"], n["k2"], n["k3"], n["k4"])),
        n["pairs"],
        (n["k1"], n["k2"], n["more"]),
    )


class Arrays:
    """A worker's view of a stored model."""

    def __init__(self, model: Model):
        self.model, self.hot = model, np.array(model.hot, np.uint64)
        self.open = lru_cache(maxsize=1024)(lambda name, kind: _open(model.folder, name, kind))

    def find(self, what: str, values: str, keys: np.ndarray, routes: np.ndarray, width: int) -> np.ndarray:
        """The stored numbers (``width`` of them) of each key; zeros where it is not stored."""
        out = np.zeros((len(keys), width), np.int64)
        order = np.argsort(routes, kind="stable")
        bucket = _bucket(routes[order], self.model.bits)
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
        for lo, hi in zip(edges, np.append(edges[1:], len(bucket))):
            name = f"{what}-{int(bucket[lo]):08d}"
            stored = self.open(f"{name}.hash", "<u8")
            if not len(stored):
                continue
            numbers = self.open(f"{name}.{values}", "<u1")
            numbers = numbers.view(f"<u{len(numbers) // (len(stored) * width)}").reshape(len(stored), width)
            mine = order[lo:hi]
            mine = mine[np.argsort(keys[mine])]
            place = np.minimum(np.searchsorted(stored, keys[mine]), len(stored) - 1)
            known = stored[place] == keys[mine]
            out[mine[known]] = numbers[place[known]]
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """Per row: tokens, tokens seen in training, log10 probability by the model and by the base rule."""
        m = self.model
        tokens, at = tokens_of(data, offsets)
        first, second = pairs_of(tokens, at)
        words, where = np.unique(np.concatenate([first, second]), return_inverse=True)
        known = self.find("word", "counts", words, words, len(COUNTS))
        before, own = known[where[: len(first)]], known[where[len(first) :]]
        pair, back = np.unique(pair_hash(first, second), return_inverse=True)
        one = np.empty(len(pair), np.int64)
        one[back] = np.arange(len(back))
        n = self.find("pair", "count", pair, route(first[one], pair, self.hot, m.first_bits), 1)[back, 0]

        less = np.array([0.0, *m.word_discounts])
        after = own[:, COUNTS.index("after")]
        spare = sum(d * k for d, k in zip(m.word_discounts, m.word_kinds))
        uniform = 1.0 / (m.words + 1)
        alone = (after - less[np.minimum(after, 3)] + spare * uniform) / m.pairs if m.pairs else np.full(len(n), uniform)
        total = before[:, COUNTS.index("total")]
        less = np.array([0.0, *m.pair_discounts])
        spare = before[:, 3:] @ np.array(m.pair_discounts)
        seen = np.maximum(total, 1)
        p = np.where(total > 0, (n - less[np.minimum(n, 3)]) / seen + spare / seen * alone, alone)
        count = own[:, 0]
        base = np.log10((count + 1) / (m.tokens + (m.words + 1)))
        rows = at[:-1]
        return {
            "n_tokens": np.diff(at),
            "n_known": np.add.reduceat((count > 0).astype(np.int64), rows),
            "base_score": np.add.reduceat(base, rows),
            "score": np.add.reduceat(np.log10(p), rows),
        }


def score(text: Column, model: Model) -> Column:
    """Struct of n_tokens, n_known, base_score, score of a text; null ones are empty: one end.

    Scores are log10 probabilities of the whole text, so 10 ** (-score / n_tokens) is its
    perplexity. Words never seen share the probability of one unseen word.
    """

    @F.arrow_udf("struct<n_tokens:long,n_known:long,base_score:double,score:double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        arrays = Arrays(model)
        for batch in batches:
            parts = [arrays.score(*flat(part)) for part in slices(batch, SCORE_BYTES)]
            if not parts:
                yield pa.array([], pa.struct([(k, pa.int64()) for k in ("n_tokens", "n_known")] + [(k, pa.float64()) for k in ("base_score", "score")]))
                continue
            columns = {k: pa.array(np.concatenate([p[k] for p in parts])) for k in parts[0]}
            yield pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

    return scored(text)
