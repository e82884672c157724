"""Secret scans: three stated patterns, and random strings told from identifiers by Markov models.

Character models of ordinary identifiers and of random strings are trained from labelled samples;
random strings have one model for each alphabet they may be drawn from, since one for all of them
would call a string of few kinds of characters unlikely. A run of identifier characters is a secret
if the largest log-likelihood ratio says so.
Everything is DataFrame expressions on one row at a time; the only shuffle is of the samples'
character pairs, and the only thing collected is the table of pair weights, whose size is fixed.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grainmill.llm.text import fresh

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the same matches as [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
RUN = r"[A-Za-z0-9+/_=-]+"
MIN_RUN = 10  # characters of a run that the models look at; what they miss and find falsely is in the README
LONG_RUN = RUN[:-1] + f"{{{MIN_RUN},}}"  # the same matches as RUN of MIN_RUN or more
MIN_SAMPLE = 6  # characters of a labelled sample
SAMPLE_DOCS = 20_000  # documents whose runs are the labelled samples, about
MADE = 2_000  # random strings made for each alphabet of RANDOM
RANDOM = {
    "hex": "0123456789abcdef",
    "lower": string.ascii_lowercase + string.digits,
    "upper": string.ascii_uppercase + string.digits,
    "letters": string.ascii_letters,
    "alphanumeric": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
}
MODELS = ("ordinary", "found", *RANDOM)
PRIOR = 5.0
THRESHOLD = 12.0  # log-likelihood ratio of a secret, natural logarithm


def located(text: Column, pattern: str, keep, group: int = 0) -> Column:
    """Array of (start, end) of the pattern's matches that ``keep`` (of match and group) accepts.

    Matches are leftmost and do not overlap. Their places are sums of the lengths of matches and
    of the text between them, in code points.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        found = F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end")))
        wanted = x["hit"].isNotNull() & keep(x["hit"], x["value"])
        return F.struct(F.coalesce(end, start).alias("at"), F.when(wanted, found).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def _when(text: Column, test: str, spans: Column) -> Column:
    return F.when(text.rlike(test), spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def base_spans(text: Column) -> dict[str, Column]:
    """(start, end) arrays of the base kinds; a first, plainer test spares most texts the search."""
    return {
        "assign": _when(text, ASSIGN, located(text, ASSIGN, lambda hit, v: F.length(v) >= 6, 2)),
        "access": _when(text, r"AKIA[A-Z0-9]{16}", located(text, ACCESS, lambda hit, v: F.length(hit) >= 20)),
        "hex": _when(text, r"[0-9a-f]{24}", located(text, HEX, lambda hit, v: F.length(hit) >= 24)),
    }


def made_strings(spark: SparkSession, n: int = MADE) -> DataFrame:
    """(label, word): ``n`` random strings of each alphabet of ``RANDOM``, labelled by their place in ``MODELS``.

    Each letter is picked by four hex digits of a digest, so a rerun makes the same strings.
    """
    digest = F.sha2(F.concat_ws("-", "alphabet", "id"), 512)
    place = lambda i: F.conv(digest.substr(4 * i + 1, F.lit(4)), 16, 10).cast("int")
    letter = lambda i: F.col("alphabet").substr(F.pmod(place(i), F.length("alphabet")) + 1, F.lit(1))
    word = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")
    alphabets = F.array(*[F.struct(F.lit(MODELS.index(k)).alias("label"), F.lit(v).alias("alphabet")) for k, v in RANDOM.items()])
    rows = spark.range(n).select("id", F.explode(alphabets).alias("a")).select("id", "a.*")
    return rows.select("label", word.alias("word"))


def labelled_samples(docs: DataFrame, text: str) -> DataFrame:
    """(label, word) rows: 0 for ordinary identifiers, else the place in ``MODELS`` of a random string's model.

    Runs within texts are labelled by the base patterns: what they find is random (``found``), other runs
    of ``MIN_SAMPLE`` or more letters, digits and joiners are ordinary. About ``SAMPLE_DOCS`` documents
    at most are looked at, chosen by a hash of their text, equal texts once. Random strings of each alphabet are
    added, to ``found`` too, so that there is something to learn from where the sample holds no secret.
    """
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    value = F.coalesce(F.col(text), F.lit(""))
    chosen = docs.where(F.pmod(F.xxhash64(value), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select(
        value.alias("text")
    )
    chosen = chosen.distinct()
    assigned = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    # The assignments are taken out before runs are looked at, so that none is labelled twice.
    rest = F.regexp_replace("text", ASSIGN, " ")
    runs = F.regexp_extract_all(rest, F.lit(RUN), F.lit(0))
    rows = chosen.select(
        F.explode(
            F.concat(
                F.transform(assigned, lambda w: F.struct(F.lit(1).alias("label"), w.alias("word"))),
                F.transform(
                    F.filter(runs, lambda w: F.length(w) >= MIN_SAMPLE),
                    lambda w: F.struct(w.rlike("^(AKIA[A-Z0-9]{16,}|[0-9a-f]{24,})$").cast("int").alias("label"), w.alias("word")),
                ),
            )
        ).alias("r")
    ).select("r.*")
    made = made_strings(docs.sparkSession)
    return rows.where(F.length("word") >= MIN_SAMPLE).unionByName(made).unionByName(made.withColumn("label", F.lit(1)))


def pair_weights(docs: DataFrame, text: str = "text") -> list[list[float]]:
    """For each model of ``MODELS`` after the first, the log-likelihood ratio of its random strings to
    ordinary identifiers for every character pair of ``ALPHABET``, row by row.

    Each model gives a character's probability after the one before it: its share of what came
    after that one, with ``PRIOR`` counts dealt out by how often characters come anywhere. So a
    character that a model has hardly seen is as unlikely after one that it has never seen.
    """
    n = len(ALPHABET)
    chars = labelled_samples(docs, text).select("label", F.split("word", "").alias("c"))
    ahead = F.zip_with("c", F.slice("c", F.lit(2), F.size("c")), lambda x, y: F.concat(x, y))
    pairs = chars.select("label", F.explode(ahead).alias("pair"))
    # At most n^2 rows for each model.
    counts = pairs.groupBy("label", "pair").count().where("pair IS NOT NULL").collect()
    table = {(label, pair): c for label, pair, c in counts}
    models = []
    for label in range(len(MODELS)):
        rows = [[table.get((label, a + b), 0) for b in ALPHABET] for a in ALPHABET]
        alone = [sum(row[j] for row in rows) + 0.5 for j in range(n)]
        share = [x / sum(alone) for x in alone]
        models.append([[math.log((c + PRIOR * p) / (sum(row) + PRIOR)) for c, p in zip(row, share)] for row in rows])
    ordinary = models[0]
    return [[p - q for ps, qs in zip(random, ordinary) for p, q in zip(ps, qs)] for random in models[1:]]


def log_ratio(word: Column, weights: list[list[float]]) -> Column:
    """The largest sum of one model's pair weights along a word of ``ALPHABET``'s characters."""
    # Each table is one constant: written as text, it is one value on its way to the planner.
    tables = [F.split(F.lit(",".join(map(repr, w))), ",").cast("array<double>") for w in weights]
    alphabet, n = F.lit(ALPHABET), len(ALPHABET)
    places = F.transform(F.split(word, ""), lambda c: F.instr(alphabet, c) - 1)

    def step(acc: Column, at: Column) -> Column:
        pair = acc["last"] * n + at
        more = [F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(t, pair)) for t in tables]
        sums = [(acc[f"sum_{k}"] + m).alias(f"sum_{k}") for k, m in enumerate(more)]
        return F.struct(at.alias("last"), *sums)

    start = F.struct(F.lit(-1).alias("last"), *[F.lit(0.0).alias(f"sum_{k}") for k in range(len(tables))])
    best = lambda acc: F.array_max(F.array(*[acc[f"sum_{k}"] for k in range(len(tables))]))
    return F.aggregate(places, start, step, best)


def _tagged(kind: str, spans: Column) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))
    )


def render(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def scan(docs: DataFrame, text: str = "text", weights: list[list[float]] | None = None) -> DataFrame:
    """``docs`` with arrays of (start, rank, end): ``base_spans`` and ``secret_spans``, by start and kind.

    Ranks number ``KINDS``; places count code points, the end exclusive. ``secret_spans`` holds
    the base spans and those the models add: runs of ``MIN_RUN`` or more characters that some model of
    random strings puts above ``THRESHOLD`` and that touch no base span. Null and empty texts have no
    spans; equal rows get equal spans; columns of the two names are replaced, all others stay.
    ``weights`` default to a training on ``docs``.
    """
    weights = pair_weights(docs, text) if weights is None else weights
    value = F.coalesce(F.col(text), F.lit(""))
    own = {k: fresh(docs, f"secret_{k}") for k in KINDS}
    found = docs.withColumns({own[k]: s for k, s in base_spans(value).items()})
    base = [_tagged(k, F.col(own[k])) for k in KINDS[:3]]
    found = found.withColumn("base_spans", F.array_sort(F.concat(*base)))
    likely = located(value, LONG_RUN, lambda hit, v: log_ratio(hit, weights) >= THRESHOLD)
    found = found.withColumn(own["markov"], _when(value, RUN[:-1] + f"{{{MIN_RUN}}}", likely))
    clear = F.filter(
        F.col(own["markov"]),
        lambda s: ~F.exists(F.col("base_spans"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    every = F.array_sort(F.concat(F.col("base_spans"), _tagged("markov", clear)))
    return found.withColumn("secret_spans", every).drop(*own.values())


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``; spans sorted by start."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        out = F.when(s["start"] >= acc["at"], F.array_append(acc["out"], before)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    tail = lambda acc: F.array_join(
        F.array_append(acc["out"], text.substr(acc["at"] + 1, F.length(text) - acc["at"])), ""
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, tail)).otherwise(text)
