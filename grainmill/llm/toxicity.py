"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of those of its hash and of the hashes of its first four, five and
six bytes, so that endings and punctuation do not hide a known stem. Filters of several widths
slide over the words, the largest answer of each in the whole text is kept, and a last layer
adds them up. Only the text is looked at.

All labelled rows are learnt from. They are stored in pieces of a bounded number of documents. In a round each
piece is gone through from the same net, in a task of its own, and the nets that come out are averaged; a single
piece needs no average and is fitted in one round. Cuts and scale come from all calibrating documents.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from grainmill.llm.text import _LOWER, _WEIGHT, _power, flat, mixed, slices, word_spans
from grainmill.session import materialise

PIECE = 8_000  # labelled documents that one task goes through between two averages, about
BUCKETS = 1 << 20  # of embeddings
STEMS = (4, 5, 6)
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
MIN_DOCS = 3  # features of fewer training documents keep a zero embedding
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.05, 1e-4
BETWEEN = 2  # epochs that a piece goes through between two averages
HOLD = 5  # one in so many documents calibrates
AT = 0.7  # score at which a text counts as toxic
MIN_TOXIC = 10  # calibrating documents of a language that give it a threshold of its own


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding buckets (words x 4; 0 for none) and where each row's words begin.

    Every row ends with a place without features, so none is empty. Bytes are taken in parts
    that end with a word.
    """
    starts, ends = word_spans(data, offsets)
    out = np.zeros((len(starts), 1 + len(STEMS)), np.int32)
    at, step = 0, 1 << 17
    while at < len(starts):
        begin = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, begin + step, "right")))
        part = _LOWER[data[begin : int(ends[to - 1])]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_WEIGHT[part] * _power("up", len(part)), out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        down = _power("down", len(part))[s]
        for k, stem in enumerate((0, *STEMS)):
            stop = np.minimum(e, s + stem) if stem else e
            bucket = mixed((sums[stop] - sums[s]) * down + np.uint64(stem)) % np.uint64(BUCKETS - 1) + np.uint64(1)
            out[at:to, k] = np.where(e - s >= stem, bucket, 0)
        at = to
    before = np.searchsorted(starts, offsets)
    return np.insert(out, before[1:], 0, axis=0), before + np.arange(len(before))


@dataclass
class Net:
    """rows: the row of ``embed`` for each bucket, 0 for none (a row of zeros)."""

    rows: np.ndarray
    embed: np.ndarray
    filters: list[np.ndarray]  # by width: (width, SIZE, FILTERS)
    shifts: list[np.ndarray]
    last: np.ndarray
    bias: float
    scale: float = 1.0
    middle: float = 0.0

    def responses(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The summed embeddings, and each filter's answer at each word."""
        vectors = self.embed[words[:, 0]]
        for k in range(1, words.shape[1]):
            vectors = vectors + self.embed[words[:, k]]
        n = len(vectors)
        left = np.repeat(at[1:], np.diff(at)) - np.arange(n)  # words up to the row's end
        answers = []
        for width, filters, shift in zip(WIDTHS, self.filters, self.shifts):
            answer = vectors @ filters[0] + shift
            for j in range(1, width):
                ahead = np.zeros_like(vectors)
                ahead[: n - j] = vectors[j:]
                ahead[left <= j] = 0
                answer += ahead @ filters[j]
            answers.append(answer)
        return vectors, np.concatenate(answers, axis=1)

    def logits(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        _, answers = self.responses(self.rows[words], at)
        top = np.maximum(np.maximum.reduceat(answers, at[:-1], axis=0), 0)
        return top @ self.last + self.bias

    def scores(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.scored(self.logits(words, at))

    def scored(self, logits: np.ndarray) -> np.ndarray:
        z = self.scale * (logits - self.middle) + np.log(AT / (1 - AT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def packed(self) -> bytes:
        used = np.flatnonzero(self.rows).astype(np.int32)
        out = io.BytesIO()
        np.savez(
            out, used=used, row=self.rows[used], embed=self.embed, last=self.last,
            numbers=np.array([self.bias, self.scale, self.middle]),
            **{f"filter{i}": f for i, f in enumerate(self.filters)},
            **{f"shift{i}": s for i, s in enumerate(self.shifts)},
        )
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Net:
        x = np.load(io.BytesIO(data))
        rows = np.zeros(BUCKETS, np.int32)
        rows[x["used"]] = x["row"]
        filters, shifts = ([x[f"{k}{i}"] for i in range(len(WIDTHS))] for k in ("filter", "shift"))
        return cls(rows, x["embed"], filters, shifts, x["last"], *map(float, x["numbers"]))


def begun(feature: np.ndarray, seed: int = 7) -> tuple[Net, dict, np.random.Generator]:
    """The net before any training with embeddings for these buckets, its sums of squared slopes, and what orders texts."""
    rng = np.random.default_rng(seed)
    rows = np.zeros(BUCKETS, np.int32)
    rows[feature] = np.arange(1, len(feature) + 1)
    net = Net(
        rows,
        rng.normal(0, 0.01, (len(feature) + 1, SIZE)).astype(np.float32),
        [rng.normal(0, (2 / (w * SIZE)) ** 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        -1.0,
    )
    net.embed[0] = 0
    squares = {"embed": np.full(len(net.embed), 1e-6, np.float32), "last": np.full_like(net.last, 1e-6), "bias": 1e-6}
    squares |= {("f", i): np.full_like(f, 1e-6) for i, f in enumerate(net.filters)}
    squares |= {("s", i): np.full_like(s, 1e-6) for i, s in enumerate(net.shifts)}
    return net, squares, rng


def run_epoch(net: Net, squares: dict, inner: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> None:
    """Go once through texts, given as rows of ``embed``, in this order; changes the net and its squares."""

    def step(key, value, slope):
        squares[key] = squares[key] + slope * slope
        return value - RATE * slope / np.sqrt(squares[key])

    for lo in range(0, len(order), BATCH):
        mine = order[lo : lo + BATCH]
        words = np.concatenate([inner[i] for i in mine])
        at = np.concatenate([[0], np.cumsum([len(inner[i]) for i in mine])])
        vectors, answers = net.responses(words, at)
        top = np.maximum.reduceat(answers, at[:-1], axis=0)
        doc = np.repeat(np.arange(len(mine)), np.diff(at))
        place = np.where(answers == top[doc], np.arange(len(words))[:, None], len(words))
        place = np.minimum.reduceat(place, at[:-1], axis=0)  # the first word with the largest answer
        z = np.maximum(top, 0) @ net.last + net.bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[mine]) / len(mine)
        open_ = np.where(top > 0, error[:, None] * net.last, 0.0).astype(np.float32)  # slope at each answer
        net.last = step("last", net.last, np.maximum(top, 0).T @ error + DECAY * net.last).astype(np.float32)
        net.bias = float(step("bias", net.bias, error.sum()))
        slopes = np.zeros_like(vectors)
        for i, width in enumerate(WIDTHS):
            mask = slice(i * FILTERS, (i + 1) * FILTERS)
            d, p = open_[:, mask], place[:, mask]
            change = np.zeros_like(net.filters[i])
            for j in range(width):
                q = p + j
                inside = q < at[1:][:, None]
                q = np.minimum(q, len(words) - 1)
                seen = np.where(inside[..., None], vectors[q], 0)  # (docs, FILTERS, SIZE)
                change[j] = np.einsum("df,dfs->sf", d, seen)
                back = np.where(inside, d, 0)[..., None] * net.filters[i][j].T
                np.add.at(slopes, q.ravel(), back.reshape(-1, SIZE))
            net.filters[i] = step(("f", i), net.filters[i], change + DECAY * net.filters[i])
            net.shifts[i] = step(("s", i), net.shifts[i], d.sum(axis=0))
        hit = np.flatnonzero(slopes.any(axis=1))
        flatrow, slope = words[hit].ravel(), np.repeat(slopes[hit], words.shape[1], axis=0)
        one, where = np.unique(flatrow, return_inverse=True)
        total = np.zeros((len(one), SIZE), np.float32)
        np.add.at(total, where, slope)
        total[one == 0] = 0
        total += DECAY * net.embed[one]
        squares["embed"][one] += (total**2).sum(axis=1)
        net.embed[one] -= RATE * total / np.sqrt(squares["embed"][one])[:, None]


def _seen(text: np.ndarray) -> np.ndarray:
    """The buckets of a text, each once."""
    return np.unique(text[text > 0])


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Net:
    """A net for texts given as ``features`` of one row each."""
    found = [_seen(t) for t in texts]
    feature, docs = np.unique(np.concatenate([np.zeros(0, np.int32), *found]), return_counts=True)
    net, squares, rng = begun(feature[docs >= MIN_DOCS], seed)
    inner = [net.rows[t] for t in texts]
    for _ in range(EPOCHS if len(texts) else 0):
        run_epoch(net, squares, inner, labels, rng.permutation(len(texts)))
    return net


def _words(texts: pd.Series) -> list[np.ndarray]:
    """The ``features`` of each text."""
    out = []
    for part in slices(pa.array(texts, pa.string())):
        found, at = features(*flat(part))
        out += [found[a:b] for a, b in zip(at, at[1:])]
    return out


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    docs = np.zeros(BUCKETS, np.int64)
    for pdf in batches:
        for words in _words(pdf["text"]):
            docs[_seen(words)] += 1
    bucket = np.flatnonzero(docs)
    yield pd.DataFrame({"bucket": bucket, "docs": docs[bucket]})


def _gathered(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """Each piece's number, part, texts and labels; a piece of over ``most`` texts, by equal keys, comes in parts."""

    def sorted_by_pick() -> tuple[int, int, list[np.ndarray], np.ndarray]:
        order = sorted(range(len(kept)), key=lambda i: (kept[i][0], kept[i][1].tobytes()))
        return now, part, [kept[i][1] for i in order], np.array([kept[i][2] for i in order], np.float64)

    now, part, kept = -1, 0, []
    for pdf in batches:
        for piece, pick, words, label in zip(pdf["piece"], pdf["pick"], _words(pdf["text"]), pdf["label"]):
            if kept and (piece != now or len(kept) == most):
                yield sorted_by_pick()
                kept = []
                part += 1
            if piece != now:
                now, part = piece, 0
            kept.append((pick, words, label))
    if kept:
        yield sorted_by_pick()


def _dense(net: Net, squares: dict) -> np.ndarray:
    """All that every text changes, in one array: the layers after the embeddings, and their squares."""
    layers = [*net.filters, *net.shifts, net.last, np.array([net.bias])]
    keys = [*(("f", i) for i in range(len(WIDTHS))), *(("s", i) for i in range(len(WIDTHS))), "last", "bias"]
    return np.concatenate([np.ravel(x).astype(np.float64) for x in [*layers, *(squares[k] for k in keys)]])


def _with_dense(net: Net, squares: dict, values: np.ndarray) -> tuple[Net, dict]:
    """The net and squares with what ``_dense`` gave."""
    shapes = [*(f.shape for f in net.filters), *(s.shape for s in net.shifts), net.last.shape, ()]
    ends = np.cumsum([int(np.prod(shape)) for shape in shapes * 2])
    every = [x.reshape(shape) for x, shape in zip(np.split(values, ends[:-1]), shapes * 2)]
    n, half = len(WIDTHS), len(shapes)
    layers, sums = ([x.astype(np.float32) for x in part] for part in (every[:half], every[half:]))
    net = replace(net, filters=layers[:n], shifts=layers[n : 2 * n], last=layers[2 * n], bias=float(every[half - 1]))
    squares = {"embed": squares["embed"], "last": sums[2 * n], "bias": float(every[-1])}
    squares |= {("f", i): f for i, f in enumerate(sums[:n])} | {("s", i): s for i, s in enumerate(sums[n : 2 * n])}
    return net, squares


def _round(start: Broadcast, epochs: range, pieces: int, most: int, block: int):
    """Each piece's net after these epochs: a row for the layers (block -1) and one for each block of embeddings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net, squares, state = start.value
        for piece, part, texts, labels in _gathered(batches, most):
            bits = np.random.PCG64()
            bits.state = state
            number = piece + part * pieces
            rng = np.random.Generator(bits.jumped(number) if number else bits)
            mine = replace(net, embed=net.embed.copy(), filters=[*net.filters], shifts=[*net.shifts])
            own = squares | {"embed": squares["embed"].copy()}
            inner = [net.rows[t] for t in texts]
            for epoch in range(epochs.stop):
                order = rng.permutation(len(inner))
                if epoch in epochs:
                    run_epoch(mine, own, inner, labels, order)
            moved = np.flatnonzero((mine.embed != net.embed).any(axis=1) | (own["embed"] != squares["embed"]))
            out = [(-1, number, len(inner), b"", _dense(mine, own).tobytes())]
            for some in np.split(moved, np.flatnonzero(np.diff(moved // block)) + 1):
                if len(some):
                    values = np.column_stack([mine.embed[some], own["embed"][some]])
                    out.append((int(some[0] // block), number, 1, some.astype(np.int32).tobytes(), values.tobytes()))
            yield pd.DataFrame(out, columns=["block", "number", "weight", "rows", "values"])

    return run


def _averaged(block: int):
    """Layers are averaged by the pieces' texts; an embedding over the pieces that changed it."""

    def average(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        if (of := int(pdf["block"].iloc[0])) < 0:
            every = np.stack([np.frombuffer(v, np.float64) for v in pdf["values"]])
            weight = pdf["weight"].to_numpy(np.float64)
            mean, rows = (every * (weight / weight.sum())[:, None]).sum(axis=0), b""
        else:
            total, times = np.zeros((block, SIZE + 1)), np.zeros(block)
            for rows, values in zip(pdf["rows"], pdf["values"]):
                where = np.frombuffer(rows, np.int32) - of * block
                total[where] += np.frombuffer(values, np.float32).reshape(-1, SIZE + 1)
                times[where] += 1
            where = np.flatnonzero(times)
            mean = (total[where] / times[where][:, None]).astype(np.float32)
            rows = (where + of * block).astype(np.int32).tobytes()
        return pd.DataFrame({"block": [of], "rows": [rows], "values": [mean.tobytes()]})

    return average


def fit_pieces(train: DataFrame, pieces: int, most: int, seed: int = 7) -> Net:
    """A net for the rows of ``train`` (piece, pick, text, label); the rows of a piece lie together."""
    context = train.sparkSession.sparkContext
    counts = train.select("text").mapInPandas(_document_counts, "bucket int, docs long")
    kept = counts.groupBy("bucket").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS)
    # One number for each embedding, of which there are at most ``BUCKETS``.
    net, squares, rng = begun(np.sort(kept.select("bucket").toPandas()["bucket"].to_numpy(np.int64)), seed)
    state, step = rng.bit_generator.state, EPOCHS if pieces == 1 else BETWEEN
    block = min(1 << 14, max(64, (1 << 20) // pieces))  # so that a block's rows of all pieces take some 40 MB
    for first in range(0, EPOCHS, step):
        start = context.broadcast((net, squares, state))
        run = _round(start, range(first, first + step), pieces, most, block)
        moved = train.select("piece", "pick", "text", "label").mapInPandas(
            run, "block int, number long, weight long, rows binary, values binary"
        )
        made = moved.groupBy("block").applyInPandas(_averaged(block), "block int, rows binary, values binary").collect()
        start.destroy(blocking=True)  # else each round's net stays on the disks
        if not made:
            break
        net, squares = replace(net, embed=net.embed.copy()), squares | {"embed": squares["embed"].copy()}
        for r in (r for r in made if r["block"] >= 0):
            rows, values = np.frombuffer(r["rows"], np.int32), np.frombuffer(r["values"], np.float32).reshape(-1, SIZE + 1)
            net.embed[rows], squares["embed"][rows] = values[:, :SIZE], values[:, SIZE]
        net, squares = _with_dense(net, squares, np.frombuffer(next(r["values"] for r in made if r["block"] < 0)))
    return net


def best_cuts(scored: DataFrame) -> DataFrame:
    """For each ``lang`` of (lang, value, label) rows the value above which calling a text toxic gives the best F1.

    ``cut`` is the middle of the best gap, the upper of equals; ``n`` counts the rows and ``hits`` those of label 1.
    Equal values are counted first; the others are dealt by ranges of the value, whose sums stand before each range.
    """
    spark = scored.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = scored.groupBy("lang", "value").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    dealt = one.repartitionByRange(parts, "lang", F.col("value").desc()).withColumn("part", F.spark_partition_id())
    dealt = materialise(dealt, "toxicity-cuts")
    of_part = dealt.groupBy("lang", "part").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("value").alias("top")
    )
    parts_of, all_of = Window.partitionBy("lang").orderBy("part"), Window.partitionBy("lang")
    of_part = of_part.select(
        "lang",
        "part",
        (F.sum("n").over(parts_of) - F.col("n")).alias("n_before"),
        (F.sum("hits").over(parts_of) - F.col("hits")).alias("hits_before"),
        F.sum("n").over(all_of).alias("all_n"),
        F.sum("hits").over(all_of).alias("all_hits"),
        F.lead("top").over(parts_of).alias("top_after"),
    )
    down = Window.partitionBy("lang", "part").orderBy(F.col("value").desc())
    hits = F.sum("hits").over(down) + F.col("hits_before")
    f1 = 2.0 * hits / (F.sum("n").over(down) + F.col("n_before") + F.col("all_hits"))
    below = F.coalesce(F.lead("value").over(down), F.col("top_after"))
    cuts = dealt.join(F.broadcast(of_part), ["lang", "part"]).select(
        "lang", "all_n", "all_hits", F.struct(f1.alias("f1"), "value", below.alias("below")).alias("at")
    )
    best = cuts.groupBy("lang").agg(F.max("at").alias("at"), F.max("all_n").alias("n"), F.max("all_hits").alias("hits"))
    middle = F.coalesce((F.col("at.value") + F.col("at.below")) / 2, (F.col("at.value") - F.lit(1)).cast("double"))
    return best.select("lang", "n", "hits", middle.alias("cut"))


def calibrate(net: Net, held: DataFrame) -> dict[str, float]:
    """Set the middle so that the best cut scores ``AT``, and the scale by logistic fit around it; a threshold by language.

    ``held``: (lang, text, label) rows.
    """

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                texts = _words(pdf["text"])
                z = net.logits(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
                yield pd.DataFrame({"lang": pdf["lang"], "label": pdf["label"], "value": z.astype(np.float32)})

    held = held.select("lang", "text", "label").mapInPandas(answers, "lang string, label int, value float")
    held = materialise(held, "toxicity-held")
    whole = best_cuts(held.withColumn("lang", F.lit(""))).first()
    if whole and 0 < whole["hits"] < whole["n"]:
        net.middle, net.scale, b = whole["cut"], 1.0, float(np.log(AT / (1 - AT)))
        x, label = F.col("value") - F.lit(net.middle).cast("float"), F.col("label")
        for _ in range(50):  # Newton steps for the slope, kept off infinity by a prior
            z = (F.lit(net.scale).cast("float") * x).cast("double") + F.lit(b)
            p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
            g, h = held.agg(F.sum(x * (p - label)), F.sum(x * x * p * (1 - p))).first()
            before = net.scale
            net.scale = float(np.clip(before - (g + 0.1 * (before - 1)) / (h + 0.1), 0.1, 10))
            if abs(net.scale - before) < 1e-10 * before:
                break

    @F.pandas_udf("double")
    def scores(z: pd.Series) -> pd.Series:
        return pd.Series(net.scored(z.to_numpy(np.float32)))

    cuts = best_cuts(held.withColumn("value", scores("value")))
    cuts = cuts.where((F.col("hits") >= MIN_TOXIC) & (F.col("hits") < F.col("n")))
    return {r["lang"]: r["cut"] for r in cuts.collect()}


def train(
    rows: DataFrame, text: str, label: str, key: str, lang: str, piece: int = PIECE, labels: DataFrame | None = None
) -> tuple[bytes, dict[str, float]]:
    """The packed net and each language's threshold, from all labelled rows with their whole texts.

    A hash of ``key`` sets one row in ``HOLD`` aside for calibration. The others are dealt into pieces of about
    ``piece`` rows by a hash of key and text, so none grows with the input. Rows without a label are left out.
    Without rows of both labels, the net says little and all thresholds are ``AT``.

    With ``labels``, a table of ``key`` and ``label``, the result is that of ``rows`` joined with it by ``key``,
    but texts are shuffled once: they go to their pieces, and there the labels meet them.
    """
    if labels is None:
        rows = rows.where(F.col(label).isNotNull())
        n = rows.count()
    else:
        labels = labels.where(F.col(label).isNotNull()).select(key, label)
        n = rows.select(key).join(labels, key).count()
    pieces = max(1, ceil(n / piece))
    home = F.pmod(F.xxhash64(F.lit("piece"), F.col(key), F.col(text)), F.lit(pieces)).cast("int")
    if labels is None:
        dealt = rows.select(home.alias("piece"), key, text, lang, label).repartitionById(pieces, F.col("piece"))
    else:
        texts = rows.select(home.alias("piece"), key, text, lang)
        marks = texts.select("piece", key).distinct().join(labels, key)
        dealt, marks = (x.repartitionById(pieces, F.col("piece")) for x in (texts, marks))
        dealt = dealt.join(marks, ["piece", key])
    known = dealt.select(
        "piece",
        F.pmod(F.xxhash64(F.lit("toxicity"), F.col(key)), F.lit(1 << 30)).alias("pick"),
        (F.col(label) > 0).cast("int").alias("label"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # A file for each piece, in an order of its own. Texts are stored: their features take more than twice the bytes.
    stored = materialise(known.sortWithinPartitions("piece", "pick", "text", "label", "lang"), "toxicity")
    held = F.col("pick") % HOLD == 0
    net = fit_pieces(stored.where(~held), pieces, 2 * piece)
    thresholds = calibrate(net, stored.where(held))
    return net.packed(), thresholds


def score(text: Column, net: bytes) -> Column:
    """Between 0 and 1, higher for texts likelier labelled toxic; null and empty texts get one too.

    The net's size is bounded by its buckets, so it travels with the tasks.
    """

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Net.unpacked(net)
        for batch in batches:
            parts = [model.scores(*features(*flat(part))) for part in slices(batch)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]).astype(np.float64))

    return scored(text)


def flagged(lang: Column, value: Column, thresholds: dict[str, float]) -> Column:
    """Whether a score reaches its language's threshold; ``AT`` for languages without one."""
    cut = F.lit(AT)
    for name, threshold in sorted(thresholds.items()):
        cut = F.when(lang == name, threshold).otherwise(cut)
    return value >= cut
