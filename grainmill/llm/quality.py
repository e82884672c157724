"""Quality rules: documents far from their language's and source's robust centre are rejected.

Each document gives a vector of transformed statistics. For every language and source a
minimum-covariance-determinant estimate is made by concentration steps: the share ``h`` of the
documents nearest to the centre gives the next mean and covariance, until no determinant falls any
more. Several stated starts go side by side, and the least determinant is kept. The covariance is
scaled so that the median squared distance is that of a normal sample, and documents beyond a
squared Mahalanobis distance of ``CUT`` are rejected.

Everything is DataFrame expressions. Groups of any size meet in partial sums and mergeable
quantile sketches only. Rows meet their group's estimate by group and piece: each row has one of
``PIECES`` numbers, so a group that holds most rows is spread over as many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from grainmill.llm.text import fresh
from grainmill.session import fits_broadcast, materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
H = 0.75  # share of a group that its estimate is made from
STEPS = 10  # concentration steps at most; a determinant that no longer falls ends them sooner
PIECES = 16  # into which the rows of every group are cut where they meet its estimate
MIN_GROUP = 100  # a source with fewer documents shares an estimate with other small ones
MEDIAN_CHI2 = 4.3515  # of five degrees of freedom
CUT = 27.0  # squared distance; a normal sample passes it six times in 100,000
ACCURACY = 5_000  # of quantiles: an error of one in so many ranks

# Least spread of each statistic, added to the covariance: differences of this size are never odd.
FLOORS = {"word_length": 0.06, "symbols": 0.05, "capitals": 0.05, "dup_lines": 0.08, "repeats": 0.12}
STATS = list(FLOORS)
PIECE = "quality_piece"
EVERY = "every"  # the group of rows that only the estimate over the whole table can judge
FACTOR = [f"w_{i}_{j}" for i in range(len(STATS)) for j in range(i + 1)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# White space and symbols as the rules define them.
BLANK = r"[ \\t-\\r]+"
SYMBOLS = r"[#*$%&|<>]"


def let(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it by ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeated_words(words: str) -> str:
    """SQL for the number of words that lie in three-word windows found twice or more.

    Windows are compared by 64-bit hashes. Only where some hash comes twice are windows sorted
    with their places; each place then covers its three words up to the next place.
    """
    hashes = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    ordered = "array_sort(transform(h, (x, i) -> struct(x, i)))"
    places = (
        "array_sort(transform(filter(s, (x, i) -> (i > 0 AND s[greatest(i - 1, 0)].x = x.x)"
        " OR (i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].x = x.x)), x -> x.i))"
    )
    covered = (
        "aggregate(p, struct(0L AS n, -3 AS last),"
        " (acc, i) -> struct(acc.n + least(3, i - acc.last) AS n, i AS last), acc -> acc.n)"
    )
    twice = f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {let(ordered, 's', let(places, 'p', covered))} END"
    return f"CASE WHEN size({words}) < 3 THEN 0L ELSE {let(hashes, 'h', twice)} END"


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and the five transformed statistics.

    Null and empty texts have no words and fail. New columns replace old ones of their names.
    """
    words, lines, body = (fresh(docs, n) for n in ("words", "lines", "body"))
    trimmed = F.expr(rf"btrim({body}, ' \t\n\x0b\f\r')".replace("\\x0b", "\x0b").replace("\\f", "\f"))
    cut = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    cut = cut.withColumns(
        {
            words: F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+")),
            lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t-\r]")),
        }
    )
    counted = cut.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": F.expr(repeated_words(words)),
            "stat_capitals": (F.length(body) - F.length(F.regexp_replace(body, r"\p{Lu}", ""))).cast("double"),
        }
    ).drop(words, lines, body)
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            "stat_word_length": F.log(chars / n),
            "stat_symbols": F.sqrt(F.col("n_symbols") / chars),
            "stat_capitals": F.sqrt(F.col("stat_capitals") / chars),
            "stat_dup_lines": F.sqrt(F.col("n_dup_lines") / n),
            "stat_repeats": F.sqrt(F.col("n_repeat_words") / n),
        }
    )


def _meet(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` (with a piece number) joined with ``table``, whose size the planner knows.

    Under the planner's broadcast limit no row is moved; beyond it the table's rows are repeated for
    each piece, so that the rows of a hot group go to as many tasks.
    """
    if fits_broadcast(table):
        return rows.join(table, keys, how)
    pieces = F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))
    return rows.join(table.withColumn(PIECE, pieces), [*keys, PIECE], how)


def _grouped(stats: DataFrame, group: str) -> DataFrame:
    """``stats`` with the ``group`` whose estimate holds for each row: its language and source,
    the small sources of its language together, all small languages together, or every row."""
    sizes = stats.where(~F.col("base_failed")).groupBy("g_lang", "g_source").count()
    small = F.col("count") < MIN_GROUP
    sizes = sizes.withColumn("own", F.when(small, None).otherwise(F.to_json(F.struct("g_lang", "g_source"))))
    pool = sizes.where("own IS NULL").groupBy("g_lang").agg((F.sum("count") < MIN_GROUP).alias("few"), F.sum("count").alias("pooled"))
    left = pool.where("few").agg((F.sum("pooled") < MIN_GROUP).alias("b")).first()["b"]
    rest = F.lit(EVERY if left else "all")
    named = sizes.join(pool, "g_lang", "left").select(
        "g_lang",
        "g_source",
        F.coalesce("own", F.when(F.col("few"), rest).otherwise(F.to_json(F.struct("g_lang")))).alias(group),
    )
    named = materialise(named, "quality-groups")
    return _meet(stats, named, ["g_lang", "g_source"], "left").drop("g_lang", "g_source")


def _x(name: str) -> Column:
    return F.col(f"stat_{name}")


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance of each group, with the floors, as its centre, inverse factor and determinant.

    Sums are of differences from ``c_*``, a point near the centre, so that little cancels.
    """
    diff = {a: _x(a) - F.col(f"c_{a}") for a in STATS}
    pairs = [(a, b) for i, a in enumerate(STATS) for b in STATS[: i + 1]]
    made = rows.groupBy(*keys).agg(
        *[F.first(f"c_{a}").alias(f"c_{a}") for a in STATS],
        *[F.avg(diff[a]).alias(f"m_{a}") for a in STATS],
        *[F.avg(diff[a] * diff[b]).alias(f"v_{a}_{b}") for a, b in pairs],
    )
    made = made.withColumns(
        {
            f"v_{a}_{b}": F.col(f"v_{a}_{b}")
            - F.col(f"m_{a}") * F.col(f"m_{b}")
            + (FLOORS[a] ** 2 if a == b else 0.0)
            for a, b in pairs
        }
    )
    made = made.withColumns({f"c_{a}": F.col(f"c_{a}") + F.col(f"m_{a}") for a in STATS})
    made = _inverse_factor(made)
    return made.select(*keys, *[f"c_{a}" for a in STATS], *FACTOR, _log_determinant().alias("log_det"))


def _log_determinant() -> Column:
    return -2.0 * total([F.log(f"w_{i}_{i}") for i in range(len(STATS))])


def total(parts: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, parts, F.lit(0.0))


def _inverse_factor(rows: DataFrame) -> DataFrame:
    """``rows`` with w_i_j so that W V W' = 1, W lower triangular: the inverse of V's Cholesky factor.

    Row i of W comes from the rows before it: r = V[i] W' gives the pivot, and W[i] = (e_i - r W) / pivot.
    Each row is a step of its own, so that no expression holds copies of the ones before.
    """
    for i, a in enumerate(STATS):
        v = [F.col(f"v_{a}_{b}") for b in STATS[: i + 1]]
        rows = rows.withColumns(
            {f"r_{k}": total([F.col(f"w_{k}_{j}") * v[j] for j in range(k + 1)]) for k in range(i)}
        )
        rest = v[i] - total([F.col(f"r_{k}") * F.col(f"r_{k}") for k in range(i)])
        rows = rows.withColumn("pivot", F.sqrt(F.greatest(rest, F.lit(FLOORS[a] ** 2 / 4))))
        below = {
            f"w_{i}_{j}": -total([F.col(f"r_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)]) / F.col("pivot")
            for j in range(i)
        }
        rows = rows.withColumns(below | {f"w_{i}_{i}": 1.0 / F.col("pivot")})
    return rows


def squared_distance() -> Column:
    diff = [_x(a) - F.col(f"c_{a}") for a in STATS]
    return total(
        [F.pow(total([F.col(f"w_{i}_{j}") * diff[j] for j in range(i + 1)]), 2.0) for i in range(len(STATS))]
    )


def _nearest(used: DataFrame, table: DataFrame, group: str, keys: list[str], distance: Column) -> DataFrame:
    """The rows of each group at most as far as the share ``H`` of them, with the columns of ``table``, which
    has a row for each of ``keys``. Its columns go along with the edges, so that rows meet one table a pass."""
    own = [F.first(c).alias(c) for c in table.columns if c not in keys]
    edge = _meet(used, table, [group]).groupBy(*keys).agg(F.percentile_approx(distance, H, ACCURACY).alias("edge"), *own)
    return _meet(used, materialise(edge, "quality-edge"), [group]).where(distance <= F.col("edge"))


def _starts(used: DataFrame, group: str) -> DataFrame:
    """(group, start, centre, factor, log_det): medians with their median deviations, all rows, and the rows
    near the medians in every statistic."""
    middle = used.groupBy(group).agg(*[F.percentile_approx(f"stat_{a}", 0.5, ACCURACY).alias(f"c_{a}") for a in STATS])
    placed = _meet(used, materialise(middle, "quality-medians"), [group])
    off = [F.percentile_approx(F.abs(_x(a) - F.col(f"c_{a}")), 0.5, ACCURACY).alias(f"d_{a}") for a in STATS]
    spread = placed.groupBy(group).agg(*[F.first(f"c_{a}").alias(f"c_{a}") for a in STATS], *off)
    diagonal = [
        (1.0 / (1.4826 * F.col(f"d_{a}") + FLOORS[a]) if i == j else F.lit(0.0)).alias(f"w_{i}_{j}")
        for i, a in enumerate(STATS)
        for j in range(i + 1)
    ]
    first = spread.select(group, *[f"c_{a}" for a in STATS], *diagonal).withColumn("log_det", _log_determinant())
    first = materialise(first, "quality-start")
    worst = F.greatest(*[F.abs(_x(a) - F.col(f"c_{a}")) * F.col(f"w_{i}_{i}") for i, a in enumerate(STATS)])
    near = _nearest(used, first.drop("log_det"), group, [group], worst)
    starts = [first, _sums(placed, [group]), _sums(near, [group])]
    return reduce(DataFrame.unionByName, [s.withColumn("start", F.lit(i)) for i, s in enumerate(starts)])


def estimates(stats: DataFrame, group: str) -> DataFrame:
    """(group, centre c_*, factor w_*, log_det, scale) of each group of ``stats``, from rows not base_failed.

    A group named ``EVERY`` has the estimate over all rows.
    """
    used = stats.where(~F.col("base_failed") & F.col(group).isNotNull()).select(group, PIECE, *[f"stat_{a}" for a in STATS])
    # Stored, as some twenty passes read it: each would meet the table of groups again, a plan and a broadcast more.
    used = materialise(used, "quality-used")
    if not used.where(F.col(group) == EVERY).isEmpty():
        used = used.where(F.col(group) != EVERY).unionByName(used.withColumn(group, F.lit(EVERY)))
    keys = [group, "start"]
    now, before = materialise(_starts(used, group), "quality-start"), None
    for _ in range(STEPS):
        near = _nearest(used, now.drop("log_det"), group, keys, squared_distance())
        now = materialise(_sums(near, keys), "quality-step")
        # One number reaches the driver: how much the determinants of all groups and starts have left to fall.
        fallen = now.agg(F.sum("log_det"), F.count("*")).first()
        if before is not None and before - (fallen[0] or 0.0) < 1e-9 * fallen[1]:
            break
        before = fallen[0] or 0.0
    best = now.groupBy(group).agg(F.min_by(F.struct(*[c for c in now.columns if c not in keys]), F.struct("log_det", "start")).alias("b"))
    best = materialise(best.select(group, "b.*"), "quality-best")
    scored = _meet(used, best, [group]).withColumn("d2", squared_distance())
    scale = scored.groupBy(group).agg(
        F.count("*").alias("n"), (F.percentile_approx("d2", 0.5, ACCURACY) / MEDIAN_CHI2).alias("scale")
    )
    scale = scale.where(F.col("n") >= MIN_GROUP).drop("n")
    return materialise(best.join(scale, group), "quality-estimates")


def judge(stats: DataFrame, lang: str = "lang", source: str = "source", cut: float = CUT) -> DataFrame:
    """Rows of ``measured`` (stored, as they are read several times) with ``distance`` and ``kept``.

    ``distance`` is the squared Mahalanobis distance, null where the row failed the base rules
    and no estimate covers it. A null language or source is a value of its own. Small sources share
    the estimate of their language's small sources, small languages that of all small ones or, where those
    are few as well, that of the whole table. Fewer than ``MIN_GROUP`` documents in the whole table give no
    estimate worth having: those pass if the base rules do. The scale never shrinks a distance's unit
    below one, so a group of near-equal documents rejects no more than the floors say. Other columns stay,
    whatever their names.
    """
    columns = [c for c in stats.columns if c.lower() not in ("kept", "distance")]
    group = "quality_group"
    keyed = stats.select(
        F.struct(*columns).alias("quality_row"),
        "base_failed",
        *[f"stat_{a}" for a in STATS],
        F.coalesce(lang, F.lit("")).alias("g_lang"),
        F.coalesce(source, F.lit("")).alias("g_source"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PIECES)).cast("int").alias(PIECE),
    )
    keyed = _grouped(keyed, group)
    made = estimates(keyed, group)
    scored = _meet(keyed, made, [group], "left").withColumn(
        "distance", squared_distance() / F.greatest("scale", F.lit(1.0))
    )
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    own = [F.col("quality_row").getField(c).alias(c) for c in columns]
    return scored.select(*own, "distance", kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the base rules and ``judge`` keep, with their columns as they are."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    stats = materialise(measured(packed).drop("text"), "quality-rows")
    kept = judge(stats, cut=cut).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
