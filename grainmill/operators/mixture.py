"""Gaussian mixtures per class, and rows sampled from them.

All fits, of every class and restart, advance together. A step is one pass over the rows: with
q = (1, x, x x') a component's log density is linear in q, so a batch of rows gives the densities of
all components in one product, and the sums that the next step needs (count, sum and products of
each component's share) in another. Tasks send one row of sums per component, added by a plain grouping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import lgamma, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from grainmill.functions.hashing import hashed_normal, hashed_uniform
from grainmill.operators.sampling import draw_class
from grainmill.session import materialise, spread

FLOOR = 1e-6  # least eigenvalue of a covariance, in units of its class's variances
CELLS = 1 << 16  # densities held at once


@dataclass(frozen=True)
class Component:
    """One Gaussian of one class: a handful of numbers."""

    label: object
    weight: float
    mean: tuple[float, ...]
    factor: tuple[tuple[float, ...], ...]  # lower triangular, factor * factor' = covariance


def _factor(covariance: np.ndarray) -> tuple[tuple[float, ...], ...]:
    """Cholesky factor; the diagonal is lifted a little when it is singular."""
    size = len(covariance)
    lift = 1e-6 * max(float(np.trace(covariance)) / size, 1e-12)
    for _ in range(12):
        try:
            return tuple(map(tuple, np.linalg.cholesky(covariance).tolist()))
        except np.linalg.LinAlgError:
            covariance = covariance + lift * np.eye(size)
            lift *= 10
    raise ValueError("covariance is not positive definite")


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of log gamma for positive numbers: recurrence, then its asymptotic series."""
    x, out = np.array(x, float), np.zeros(np.shape(x))
    while (small := x < 10).any():
        out = out - np.where(small, 1 / x, 0.0)
        x = np.where(small, x + 1, x)
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


log_gamma = np.vectorize(lgamma, otypes=[float])


def _quadratic(weights: np.ndarray, precisions: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Coefficients over (1, x, x_i x_j for i <= j) of weight - (x - m)' P (x - m) / 2, per component."""
    size = means.shape[-1]
    i, j = np.triu_indices(size)
    linear = np.einsum("kij,kj->ki", precisions, means)
    constant = weights - 0.5 * np.einsum("ki,ki->k", linear, means)
    return np.column_stack([constant, linear, -np.where(i == j, 0.5, 1.0) * precisions[:, i, j]])


def _unpacked(sums: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and full products of packed statistics."""
    i, j = np.triu_indices(size)
    products = np.zeros((len(sums), size, size))
    products[:, i, j] = products[:, j, i] = sums[:, 1 + size :]
    return sums[:, 0], sums[:, 1 : 1 + size], products


def _floored(covariance: np.ndarray) -> np.ndarray:
    """The covariances with no eigenvalue under ``FLOOR``: the best ones under that condition."""
    values, vectors = np.linalg.eigh(covariance)
    return np.einsum("kij,kj,klj->kil", vectors, np.maximum(values, FLOOR), vectors)


class Likelihood:
    """One fit by plain expectation maximisation: weights, means and covariances of the components."""

    def __init__(self, means: np.ndarray):
        count, size = means.shape
        self.weights, self.means = np.full(count, 1 / count), means
        self.covariances = np.broadcast_to(np.eye(size), (count, size, size))

    def coefficients(self) -> np.ndarray:
        with np.errstate(divide="ignore"):  # a component that no row belongs to has weight 0
            logs = np.log(self.weights)
        _, determinant = np.linalg.slogdet(self.covariances)
        logs = logs - 0.5 * (determinant + self.means.shape[1] * log(2 * pi))
        return _quadratic(logs, np.linalg.inv(self.covariances), self.means)

    def bound(self, likelihood: float) -> float:
        return likelihood

    def update(self, sums: np.ndarray) -> None:
        n, first, second = _unpacked(sums, self.means.shape[1])
        self.weights, some = n / n.sum(), n > 1e-9
        share = np.where(some, n, 1.0)[:, None]
        means = first / share
        spread_ = second / share[..., None] - np.einsum("ki,kj->kij", means, means)
        self.means = np.where(some[:, None], means, self.means)
        self.covariances = np.where(some[:, None, None], _floored(spread_), self.covariances)


class Bayesian:
    """One fit by variational updates, which leaves weights of components that are not needed near 0.

    Weights have a Dirichlet prior or, for ``process``, sticks broken off one after the other; means
    and precisions a Gaussian-Wishart prior at the class's mean and variances (Bishop 2006, 10.2;
    Blei and Jordan 2006).
    """

    def __init__(self, means: np.ndarray, concentration: float, process: bool, rows: float):
        count, size = means.shape
        self.concentration, self.process, self.size = concentration, process, size
        self.prior_mean, self.prior_beta, self.prior_nu = np.zeros(size), 1.0, float(size)
        self.prior_scale = np.eye(size)  # inverse of the prior's W
        # As if each component had an equal share of the rows, around its start.
        n = np.full(count, rows / count)
        sums = np.concatenate([[1.0], np.zeros(size), np.eye(size)[np.triu_indices(size)]])
        packed = n[:, None] * np.broadcast_to(sums, (count, len(sums)))
        i, j = np.triu_indices(size)
        packed = packed.copy()
        packed[:, 1 : 1 + size] = n[:, None] * means
        packed[:, 1 + size :] += n[:, None] * means[:, i] * means[:, j]
        self.update(packed)

    def update(self, sums: np.ndarray) -> None:
        n, first, second = _unpacked(sums, self.size)
        if self.process:
            later = np.cumsum(n[::-1])[::-1] - n
            self.sticks = np.column_stack([1 + n, self.concentration + later])
        else:
            self.sticks = (self.concentration + n)[None, :]
        self.beta, self.nu = self.prior_beta + n, self.prior_nu + n
        self.mean = (self.prior_beta * self.prior_mean + first) / self.beta[:, None]
        outer = np.einsum("k,ki,kj->kij", self.beta, self.mean, self.mean)
        prior = self.prior_scale + self.prior_beta * np.outer(self.prior_mean, self.prior_mean)
        self.scale = prior + second - outer  # inverse of W

    def _log_weights(self) -> np.ndarray:
        logs = digamma(self.sticks) - digamma(self.sticks.sum(axis=1, keepdims=True))
        if not self.process:
            return logs[0]
        return logs[:, 0] + np.concatenate([[0.0], np.cumsum(logs[:-1, 1])])

    def _log_precision(self) -> np.ndarray:
        """Expected log determinant of each precision."""
        halves = (self.nu[:, None] - np.arange(self.size)) / 2
        return digamma(halves).sum(axis=1) + self.size * log(2) - np.linalg.slogdet(self.scale)[1]

    def coefficients(self) -> np.ndarray:
        logs = self._log_weights() + 0.5 * (self._log_precision() - self.size * log(2 * pi) - self.size / self.beta)
        return _quadratic(logs, self.nu[:, None, None] * np.linalg.inv(self.scale), self.mean)

    def bound(self, likelihood: float) -> float:
        """The lower bound on the evidence, where ``likelihood`` sums the rows' log densities under
        ``coefficients``: less what the factors of weights and Gaussians diverge from their priors."""
        prior = np.array([1.0, self.concentration]) if self.process else np.full(self.sticks.shape[1], self.concentration)
        whole = self.sticks.sum(axis=1)
        apart = (
            (log_gamma(whole) - log_gamma(self.sticks).sum(axis=1)).sum()
            - len(self.sticks) * (lgamma(prior.sum()) - log_gamma(prior).sum())
            + ((self.sticks - prior) * (digamma(self.sticks) - digamma(whole)[:, None])).sum()
        )

        def partition(nu, log_scale):  # log of the Wishart density's constant, W's inverse given
            halves = (np.asarray(nu)[..., None] - np.arange(self.size)) / 2
            return np.asarray(nu) * (log_scale - self.size * log(2)) / 2 - log_gamma(halves).sum(axis=-1)

        logs, w = self._log_precision(), np.linalg.inv(self.scale)
        own = partition(self.nu, np.linalg.slogdet(self.scale)[1]) - partition(self.prior_nu, np.linalg.slogdet(self.prior_scale)[1])
        trace = np.einsum("ij,kji->k", self.prior_scale, w)
        wishart = own + 0.5 * (self.nu - self.prior_nu) * logs - 0.5 * self.nu * self.size + 0.5 * self.nu * trace
        off = self.mean - self.prior_mean
        ratio = self.prior_beta / self.beta
        gauss = 0.5 * (
            self.size * (ratio - 1 - np.log(ratio)) + self.prior_beta * self.nu * np.einsum("ki,kij,kj->k", off, w, off)
        )
        return likelihood - apart - float(wishart.sum()) - float(gauss.sum())

    @property
    def means(self) -> np.ndarray:
        return self.mean

    @property
    def weights(self) -> np.ndarray:
        share = self.sticks / self.sticks.sum(axis=1, keepdims=True)
        if not self.process:
            return share[0]
        out = share[:, 0] * np.concatenate([[1.0], np.cumprod(share[:-1, 1])])
        return out / out.sum()

    @property
    def covariances(self) -> np.ndarray:
        return self.scale / self.nu[:, None, None]


def _step(rows: DataFrame, size: int, coefficients: dict[int, np.ndarray]) -> DataFrame:
    """One pass: (class, fit, component, sums, likelihood) of all fits, from rows (class, x).

    ``coefficients`` holds for each class an array of fits by components by terms. Rows lie along the last
    axis of all tables, and so few are taken at once that a processor's cache holds their densities.
    """
    i, j = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {c: np.zeros(x.shape) for c, x in coefficients.items()}
        found = {c: np.zeros(x.shape[:2]) for c, x in coefficients.items()}
        # Components first, so that a fit's greatest and summed densities are taken table by table.
        terms = {c: np.ascontiguousarray(x.transpose(1, 0, 2)) for c, x in coefficients.items()}
        for batch in batches:
            classes = batch.column("class").to_numpy()
            values = np.stack([batch.column(1 + k).to_numpy() for k in range(size)])
            for c, theta in terms.items():
                own = values[:, classes == c]
                parts, fits, width = theta.shape
                few = max(64, CELLS // (parts * fits))
                for at in range(0, own.shape[1], few):
                    x = own[:, at : at + few]
                    q = np.concatenate([np.ones((1, x.shape[1])), x, x[i] * x[j]])
                    shares = (theta.reshape(-1, width) @ q).reshape(parts, fits, -1)
                    top = shares.max(axis=0)
                    shares -= top
                    np.exp(shares, out=shares)
                    whole = shares.sum(axis=0)
                    shares /= whole
                    added = (shares.reshape(parts * fits, -1) @ q.T).reshape(theta.shape)
                    total[c] += added.transpose(1, 0, 2)
                    found[c][:, 0] += (top + np.log(whole)).sum(axis=1)
        for c, table in total.items():
            fits, parts, terms = table.shape
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(fits * parts, c, np.int32)),
                    pa.array(np.repeat(np.arange(fits, dtype=np.int32), parts)),
                    pa.array(np.tile(np.arange(parts, dtype=np.int32), fits)),
                    *[pa.array(np.ascontiguousarray(table[:, :, t].ravel())) for t in range(terms)],
                    pa.array(found[c].ravel()),
                ],
                [*keys, *names, "likelihood"],
            )

    keys = ["class", "fit", "component"]
    names = [f"s{t}" for t in range(1 + size + len(i))]
    kinds = ", ".join([f"{k} int" for k in keys] + [f"{n} double" for n in (*names, "likelihood")])
    flat = rows.select("class", *[F.get("x", F.lit(k)).alias(f"x{k}") for k in range(size)])  # plain columns go over faster
    added = flat.mapInArrow(sums, kinds).groupBy(*keys)
    return added.agg(*[F.sum(n).alias(n) for n in (*names, "likelihood")])


def advance(rows: DataFrame, size: int, fits: dict[int, list]) -> dict[int, list[float]]:
    """Move every fit of every class one step; the bound that each had before it.

    What reaches the driver is one row for each component of each fit.
    """
    coefficients = {c: np.stack([f.coefficients() for f in own]) for c, own in fits.items()}
    sums = {c: np.zeros(x.shape) for c, x in coefficients.items()}
    found = {c: [0.0] * len(own) for c, own in fits.items()}
    for row in _step(rows, size, coefficients).collect():
        c, fit, part, *values, likelihood = row
        sums[c][fit, part] = values
        found[c][fit] += likelihood
    bounds = {c: [f.bound(x) for f, x in zip(own, found[c])] for c, own in fits.items()}
    for c, own in fits.items():
        for fit, table in zip(own, sums[c]):
            fit.update(table)
    return bounds


def _starts(rows: DataFrame, number: int, seed: int) -> dict[int, np.ndarray]:
    """``number`` rows of each class at most, the first different ones by a hash of their values.

    Each task sends its first ones only, and of equal rows one.
    """

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[int, list]] = {}
        for batch in batches:
            classes, order = batch.column("class").to_numpy(), batch.column("order").to_numpy()
            for c in np.unique(classes):
                own = np.flatnonzero(classes == c)
                values, first = np.unique(order[own], return_index=True)
                found = zip(values[:number].tolist(), batch.column("x").take(pa.array(own[first[:number]])).to_pylist())
                kept[int(c)] = dict(sorted((kept.get(int(c), {}) | dict(found)).items())[:number])
        out = [(c, o, x) for c, own in kept.items() for o, x in own.items()]
        columns = list(zip(*out)) or [[], [], []]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], ["class", "order", "x"])

    ordered = rows.withColumn("order", F.xxhash64(F.lit(seed), "x")).mapInArrow(smallest, "class int, order long, x array<double>")
    different = ordered.groupBy("class", "order").agg(F.first("x").alias("x"))
    ranked = different.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy("order")))
    out: dict[int, list] = {}
    for row in ranked.where(F.col("rank") <= number).orderBy("class", "order").collect():
        out.setdefault(row["class"], []).append(row["x"])
    return {c: np.array(own) for c, own in out.items()}


def fit_mixtures(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    classes: Sequence,
    components: int = 10,
    iterations: int = 20,
    restarts: int = 10,
    seed: int = 0,
    prior: str | None = None,
    concentration: float | None = None,
    trace: list | None = None,
) -> list[Component]:
    """Fit one full-covariance mixture per class; of several restarts the best is kept.

    ``prior``: None for expectation maximisation; ``dirichlet`` or ``process`` for a Bayesian mixture
    whose weights have that prior of ``concentration`` (by default 1 / components), which empties
    components that are not needed. Rows with a missing feature are left out; a class without rows has no
    components. ``iterations`` passes over the rows serve all classes and restarts. ``trace`` takes, for
    each pass, the bounds of the fits by class: the likelihood, or the bound on the evidence.
    """
    if prior not in (None, "dirichlet", "process"):
        raise ValueError(f"no prior is called {prior!r}")
    number = F.coalesce(*[F.when(F.col(label) == F.lit(c), i) for i, c in enumerate(classes)])
    values = F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features])
    known = df.select(number.cast("int").alias("class"), values.alias("x"))
    known = known.where(F.col("class").isNotNull() & ~F.exists("x", lambda v: v.isNull()))
    raw = materialise(spread(known), "mixture")
    size = len(features)
    # Each class is fitted in units of its own deviations.
    spread_of = [F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(size)]
    spread_of += [F.stddev_pop(F.get("x", F.lit(i))).alias(f"d{i}") for i in range(size)]
    centre, unit, rows_of = {}, {}, {}
    for row in raw.groupBy("class").agg(F.count("*").alias("n"), *spread_of).collect():
        centre[row["class"]] = np.array([row[f"m{i}"] for i in range(size)])
        unit[row["class"]] = np.array([row[f"d{i}"] or 1.0 for i in range(size)])
        rows_of[row["class"]] = row["n"]
    present = sorted(centre)
    if not present:
        return []

    def in_units(i: int):
        def by_class(table: dict[int, np.ndarray]):
            return F.get(F.array(*[F.lit(float(table[c][i]) if c in table else 0.0) for c in range(len(classes))]), F.col("class"))

        return (F.get("x", F.lit(i)) - by_class(centre)) / by_class(unit)

    scaled = raw.select("class", F.array(*[in_units(i) for i in range(size)]).alias("x"))
    starts = _starts(scaled, components * restarts, seed)
    fits: dict[int, list] = {}
    for c in present:
        points = np.resize(starts[c], (restarts, components, size))  # repeated where there are too few
        if prior is None:
            fits[c] = [Likelihood(p) for p in points]
        else:
            strength = 1 / components if concentration is None else concentration
            fits[c] = [Bayesian(p, strength, prior == "process", rows_of[c]) for p in points]
    best = {c: 0 for c in present}
    for _ in range(iterations):
        bounds = advance(scaled, size, fits)
        best = {c: int(np.argmax(bounds[c])) for c in present}
        if trace is not None:
            trace.append(bounds)
    fitted = []
    for c in present:
        fit = fits[c][best[c]]
        for weight, mean, covariance in zip(fit.weights, fit.means, fit.covariances):
            fitted.append(
                Component(
                    classes[c],
                    float(weight),
                    tuple((centre[c] + unit[c] * mean).tolist()),
                    _factor(covariance * np.outer(unit[c], unit[c])),
                )
            )
    return fitted


def moments(spark: SparkSession, components: Sequence[Component], features: Sequence[str]) -> DataFrame:
    """Mean of each feature and covariance of each pair, as each class's mixture has them.

    After any step of expectation maximisation these are the data's own.
    """
    rows = []
    for label in dict.fromkeys(c.label for c in components):
        own = [c for c in components if c.label == label]
        weights, means = np.array([c.weight for c in own]), np.array([c.mean for c in own])
        factors = np.array([c.factor for c in own])
        mean = weights @ means
        second = np.einsum("c,cik,cjk->ij", weights, factors, factors) + np.einsum("c,ci,cj->ij", weights, means, means)
        spread_ = second - np.outer(mean, mean)
        rows += [(label, f, None, float(m)) for f, m in zip(features, mean)]
        rows += [(label, features[i], features[j], float(spread_[i, j])) for i in range(len(features)) for j in range(i + 1)]
    return spark.createDataFrame(rows, "target int, feature string, other string, value double")


def request_classes(
    spark: SparkSession,
    classes: Sequence,
    n: int,
    balanced: bool = True,
    seed: int = 0,
    weights: Sequence[float] | None = None,
) -> DataFrame:
    """(sequence, target) rows to be filled in: ``n`` of every class, or ``n`` drawn.

    Classes are drawn evenly or by ``weights``; one class alone is a list of one.
    """
    balanced = balanced and weights is None
    if balanced:
        choice = F.element_at(F.array(*[F.lit(c) for c in classes]), F.pmod("sequence", F.lit(len(classes))).cast("int") + 1)
        return spark.range(n * len(classes)).toDF("sequence").withColumn("target", choice)
    return draw_class(
        spark.range(n).toDF("sequence"), classes, list(weights or [1.0] * len(classes)), ["sequence"], seed, "target"
    )


def sample_mixtures(
    rows: DataFrame,
    components: Sequence[Component],
    label: str,
    features: Sequence[str],
    keys: Sequence[str],
    seed: int,
    uniform: Callable[[Sequence[str], int], Column] = hashed_uniform,
) -> DataFrame:
    """Generate one observation per input row, from the mixture of the row's class.

    Rows carry a class and a key; every draw is a hash of the key (``uniform`` of it and a seed), so
    rows are made on the executors and are the same when a task is repeated.
    """
    by_class: dict = {}
    for number, c in enumerate(components):
        by_class.setdefault(c.label, []).append((number, c.weight))
    tests = []
    for cls, parts in by_class.items():
        total, running = sum(weight for _, weight in parts), 0.0
        here = F.col(label) == F.lit(cls)
        for number, weight in parts[:-1]:
            running += weight
            tests.append(F.when(here & (F.col("_u") < F.lit(running / total)), number))
        tests.append(F.when(here, parts[-1][0]))
    # All parameters are two constant arrays, looked up by component number.
    width = len(features)
    means = F.array(*[F.lit(v) for c in components for v in c.mean])
    factors = F.array(*[F.lit(v) for c in components for row in c.factor for v in row])
    normals = [hashed_normal(keys, seed + 10 + 2 * i, uniform).alias(f"_z{i}") for i in range(width)]
    drawn = (
        rows.withColumn("_u", uniform(keys, seed))
        .withColumn("_part", F.coalesce(*tests))
        .filter(F.col("_part").isNotNull())
        .select("*", *normals)
    )
    values = []
    for i, name in enumerate(features):
        value = F.get(means, F.col("_part") * width + i)
        for j in range(i + 1):
            place = F.col("_part") * (width * width) + (i * width + j)
            value = value + F.get(factors, place) * F.col(f"_z{j}")
        values.append(value.alias(name))
    kept = [c for c in rows.columns if c not in set(features)]
    return drawn.select(*values, *kept)
