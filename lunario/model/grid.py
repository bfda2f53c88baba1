"""Grid search over selector size, expansion degree and penalty.

Scaling and selection are learned once per fold, on its training rows only. After
that the search reads one narrow staged table, the few selected columns, and
every pass over it serves all folds at once:

- Expansions of up to ``NORMAL_SOLVER_LIMIT`` terms are fitted from cross-products. One pass adds
  up the products of all terms in blocks, keyed by pairs of blocks; each fit is a
  centred solve of a part of them, for every penalty and selector size.
- Wider ones are fitted in a Krylov space: a step multiplies the cross-products by one
  vector, without forming them, and the same space gives the fit of every penalty. Steps
  end when the fits have settled in the measure that r2 is made of; fits that do not settle
  are refused.
- One pass scores all parameter sets on the held-out rows.

Terms are worked out inside the tasks, so nothing of the expansion's width is ever
stored per row. The driver receives sums, cross-products of at most ``NORMAL_SOLVER_LIMIT`` terms
and, for wider expansions, one vector of their width per step and fold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import FULL
from lunario.model.estimators import MutualInfoSelector
from lunario.session import stage_table

#: Widest expansion that is fitted from its cross-products.
NORMAL_SOLVER_LIMIT = 1024
#: Terms per block of cross-products.
BLOCK = 512
#: Numbers of one batch of expanded rows.
BATCH = 1 << 22
#: Steps of a wide fit, and steps after which it is looked at again.
MAX_STEPS, LOOK = 1000, 10
#: Share of the label's variance that a look may still add to a settled fit.
SETTLED = 1e-10
#: Tasks' sums are added up in groups first.
GROUPS = 64

# The published search space.
PARAM_GRID = {
    "selector__k": [3, 4, 5, 6, 7, 10],
    "model__alpha": [1, 0.5, 0.2, 0.1, 0.05, 0.02, 0.01],
    "poly__degree": [1, 2, 3, 5, 7],
}


def expansion_width(k: int, degree: int) -> int:
    """Monomials of degree 1..degree in k variables."""
    return comb(k + degree, degree) - 1


class Terms:
    """Monomials of the expansions (k, degree) in ``families``; each is its parent times one variable."""

    def __init__(self, families: list[tuple[int, int]]):
        degrees = range(1, max(degree for _, degree in families) + 1)
        reach = {d: max(k for k, degree in families if degree >= d) for d in degrees}
        names = [term for d, k in reach.items() for term in combinations_with_replacement(range(k), d)]
        place = {term: i for i, term in enumerate(names)}
        self.variables = max(reach.values())
        self.last = np.array([term[-1] for term in names])
        self.degree = np.array([len(term) for term in names])
        self.parent = np.array([place.get(term[:-1], -1) for term in names])

    def __len__(self) -> int:
        return len(self.last)

    def of(self, k: int, degree: int) -> np.ndarray:
        """Places of the terms of one expansion; the last variable of a term is its largest."""
        return np.flatnonzero((self.last < k) & (self.degree <= degree))

    def expand(self, z: np.ndarray) -> np.ndarray:
        """(terms, rows) of the variables (rows, variables)."""
        columns = np.ascontiguousarray(z.T)
        out = np.empty((len(self), len(z)))
        for d in range(1, int(self.degree.max()) + 1):
            these = np.flatnonzero(self.degree == d)
            factor = columns[self.last[these]]
            out[these] = factor if d == 1 else out[self.parent[these]] * factor
        return out


@dataclass(frozen=True)
class Fold:
    """What one fold has learned from its training rows: the best columns, and how to scale them."""

    held: int
    columns: list[str]
    means: np.ndarray
    deviations: np.ndarray


#: Sums by key that a batch of one fold adds: (fold, variables, label, whether held out) -> {key: array}.
Work = Callable[[Fold, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[str, np.ndarray]]]


def _sums(narrow: DataFrame, folds: list[Fold], rows: int, work: Work) -> dict[str, np.ndarray]:
    """One pass over the narrow table: what ``work`` gives for batches of ``rows``, added up by key."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for frame in frames:
            for begin in range(0, len(frame), rows):
                some = frame.iloc[begin : begin + rows]
                fold, label = some["__fold"].to_numpy(), some["__label"].to_numpy()
                for one in folds:
                    z = (some[one.columns].to_numpy() - one.means) / one.deviations
                    for key, value in work(one, z, label, fold == one.held):
                        totals[key] = totals[key] + value if key in totals else value
        if totals:
            yield pd.DataFrame({"key": totals.keys(), "value": [v.tobytes() for v in totals.values()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(frame["value"].iloc[0]) // 8)
        for value in frame["value"]:
            total += np.frombuffer(value)
        return pd.DataFrame({"key": frame["key"].iloc[:1], "value": [total.tobytes()]})

    schema_ = "key string, value binary"
    parts = narrow.mapInPandas(task, schema_).withColumn("g", F.spark_partition_id() % GROUPS)
    grouped = parts.groupBy("key", "g").applyInPandas(add, schema_)
    added = grouped.groupBy("key").applyInPandas(add, schema_)
    return {r["key"]: np.frombuffer(r["value"]) for r in added.collect()}


def _learned(train: DataFrame, fold: str, features: list[str], label: str, k: int) -> list[Fold]:
    """Scaling of every fold from one grouped pass, and the ``k`` best columns of each fold."""
    moments = []
    for i, c in enumerate(features):
        x = F.col(f"`{c}`").cast("double")
        moments += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    rows = train.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), *moments).orderBy(fold).collect()
    n = np.array([r["n"] for r in rows], dtype=float)
    means = np.array([[r[f"m{i}"] for i in range(len(features))] for r in rows])
    spreads = np.array([[r[f"v{i}"] for i in range(len(features))] for r in rows])
    learned = []
    for i, r in enumerate(rows):
        kept = np.arange(len(rows)) != i
        share = (n[kept] / n[kept].sum())[:, None]
        mean = (share * means[kept]).sum(axis=0)
        spread = (share * (spreads[kept] + (means[kept] - mean) ** 2)).sum(axis=0)
        selector = MutualInfoSelector(inputCols=list(features), labelCol=label, k=k)
        model = selector.fit(train.where(F.col(fold) != r[fold]))
        ranking = model.getOrDefault(model.ranking)
        places = [features.index(c) for c in ranking]
        deviations = np.sqrt(spread[places])
        deviations[deviations == 0] = 1.0
        learned.append(Fold(r[fold], ranking, mean[places], deviations))
    return learned


def _cross_products(narrow: DataFrame, folds: list[Fold], terms: Terms) -> Callable[[Fold, np.ndarray], np.ndarray]:
    """Cross-products of chosen terms, the label and 1 over a fold's training rows, from one pass."""
    size = len(terms) + 2
    edges = list(range(0, size, BLOCK)) + [size]
    pairs = [(i, j) for i in range(len(edges) - 1) for j in range(i, len(edges) - 1)]

    def work(fold, z, label, held):
        rows = np.vstack([terms.expand(z[~held, : terms.variables]), label[~held], np.ones((~held).sum())])
        for i, j in pairs:
            block = rows[edges[i] : edges[i + 1]] @ rows[edges[j] : edges[j + 1]].T
            yield f"{fold.held}:{i}:{j}", block

    sums = _sums(narrow, folds, max(16, BATCH // size), work)

    def chosen(fold: Fold, places: np.ndarray) -> np.ndarray:
        places = np.append(places, [size - 2, size - 1])
        out = np.empty((len(places), len(places)))
        of = np.searchsorted(edges, places, side="right") - 1
        for i, j in pairs:
            a, b = np.flatnonzero(of == i), np.flatnonzero(of == j)
            block = sums[f"{fold.held}:{i}:{j}"].reshape(edges[i + 1] - edges[i], -1)
            part = block[np.ix_(places[a] - edges[i], places[b] - edges[j])]
            out[np.ix_(a, b)], out[np.ix_(b, a)] = part, part.T
        return out

    return chosen


def _solved(products: np.ndarray, alphas: list[float]) -> Iterator[tuple[np.ndarray, float]]:
    """Weights and intercept of the ridge fit of each penalty."""
    n, sums, label_sum = products[-1, -1], products[-1, :-2], products[-1, -2]
    gram = products[:-2, :-2] - np.outer(sums, sums) / n
    moment = products[:-2, -2] - sums * label_sum / n
    for alpha in alphas:
        weights = np.linalg.solve(gram + alpha * np.eye(len(gram)), moment)
        yield weights, (label_sum - sums @ weights) / n


class _Krylov:
    """One fit in a growing orthonormal basis; its small matrix gives the fit of every penalty."""

    def __init__(self, n: float, sums: np.ndarray, moment: np.ndarray, label_sum: float, label_squares: float):
        self.n, self.mean, self.label_mean = n, sums / n, label_sum / n
        self.spread = label_squares - label_sum**2 / n
        start = moment - sums * label_sum / n
        self.size = float(np.linalg.norm(start))
        self.basis = [start / self.size] if self.size else []
        self.diagonal: list[float] = []
        self.beside: list[float] = []
        self.found: list[np.ndarray] = []
        self.done = not self.size

    def step(self, product: np.ndarray) -> None:
        """Takes in the product of the centred cross-products with the last basis vector."""
        last = self.basis[-1]
        self.diagonal.append(float(last @ product))
        kept = np.array(self.basis)
        for _ in range(2):  # twice is enough for an orthogonal rest
            product = product - kept.T @ (kept @ product)
        rest = float(np.linalg.norm(product))
        if rest <= 1e-13 * max(self.diagonal[0], 1e-300) or len(self.basis) == len(last):
            self.done = True
            return
        self.beside.append(rest)
        self.basis.append(product / rest)

    def small(self, alphas: list[float]) -> list[np.ndarray]:
        m = len(self.diagonal)
        matrix = np.diag(self.diagonal) + np.diag(self.beside[: m - 1], 1) + np.diag(self.beside[: m - 1], -1)
        first = np.zeros(m)
        first[0] = self.size
        return [np.linalg.solve(matrix + alpha * np.eye(m), first) for alpha in alphas]

    def look(self, alphas: list[float]) -> None:
        """Settled once the variance explained, an error of the fit in its own norm, stays."""
        found = [self.size * y[0] / self.spread for y in self.small(alphas)]
        if self.found and max(np.subtract(found, self.found)) <= SETTLED:
            self.done = True
        self.found = found

    def fits(self, alphas: list[float]) -> Iterator[tuple[np.ndarray, float]]:
        for alpha in range(len(alphas)):
            weights = np.zeros(len(self.mean))
            if self.size:
                y = self.small(alphas)[alpha]
                weights = np.array(self.basis[: len(y)]).T @ y
            yield weights, self.label_mean - float(self.mean @ weights)


def _wide_fits(
    narrow: DataFrame, folds: list[Fold], family: tuple[int, int], alphas: list[float]
) -> dict[int, list[tuple[np.ndarray, float]]]:
    """Fits of one wide expansion by fold: every step is one pass for the folds not yet settled."""
    terms = Terms([family])
    rows = max(16, BATCH // len(terms))

    def start(fold, z, label, held):
        some, y = terms.expand(z[~held, : terms.variables]), label[~held]
        ends = [float(len(y)), y.sum(), (y * y).sum()]
        yield str(fold.held), np.concatenate([some.sum(axis=1), some @ y, ends])

    width = len(terms)
    sums = _sums(narrow, folds, rows, start)
    fits = {}
    for fold in folds:
        found = sums[str(fold.held)]
        n, total, squares = found[-3:]
        fits[fold.held] = _Krylov(n, found[:width], found[width : 2 * width], total, squares)
    for number in range(1, MAX_STEPS + 1):
        open_ = [f for f in folds if not fits[f.held].done]
        if not open_:
            break
        vectors = {f.held: (fits[f.held].basis[-1], fits[f.held].mean) for f in open_}

        def step(fold, z, label, held, vectors=vectors):
            vector, mean = vectors[fold.held]
            some = terms.expand(z[~held, : terms.variables])
            seen = vector @ some - mean @ vector
            yield str(fold.held), some @ seen - mean * seen.sum()

        products = _sums(narrow, open_, rows, step)
        for fold in open_:
            fits[fold.held].step(products[str(fold.held)])
            if number % LOOK == 0:
                fits[fold.held].look(alphas)
    unsettled = [held for held, fit in fits.items() if not fit.done]
    if unsettled:
        raise RuntimeError(f"{width} terms: the fit did not settle in {MAX_STEPS} steps")
    return {held: list(fit.fits(alphas)) for held, fit in fits.items()}


def _scores(
    narrow: DataFrame, folds: list[Fold], terms: Terms, weights: dict[int, np.ndarray], constants: dict[int, np.ndarray]
) -> np.ndarray:
    """Mean r2 over the folds of each fit; ``weights`` has one column per fit."""

    def work(fold, z, label, held):
        y = label[held]
        error = y[:, None] - terms.expand(z[held, : terms.variables]).T @ weights[fold.held] - constants[fold.held]
        yield str(fold.held), np.concatenate([(error * error).sum(axis=0), [len(y), y.sum(), (y * y).sum()]])

    sums = _sums(narrow, folds, max(16, BATCH // len(terms)), work)
    r2 = []
    for found in sums.values():
        n, total, squares = found[-3:]
        r2.append(1.0 - found[:-3] / (squares - total**2 / n))
    return np.mean(r2, axis=0)


def grid_search(
    train: DataFrame,
    fold: str = "fold",
    grid: dict[str, list] = PARAM_GRID,
    features: list[str] = FULL.features,
    label: str = schema.TARGET,
) -> DataFrame:
    """One row per parameter set: grid position, parameters, mean r2 over the folds."""
    sizes, degrees, alphas = grid["selector__k"], grid["poly__degree"], [float(a) for a in grid["model__alpha"]]
    folds = _learned(train, fold, list(features), label, max(sizes))
    columns = list(dict.fromkeys(c for f in folds for c in f.columns))
    narrow = stage_table(
        train.select(
            F.col(fold).alias("__fold"),
            F.col(label).cast("double").alias("__label"),
            *[F.col(f"`{c}`").cast("double").alias(c) for c in columns],
        ),
        "grid-columns",
    )
    most = min(len(f.columns) for f in folds)
    families = sorted({(min(k, most), d) for k in sizes for d in degrees})
    wide = [f for f in families if expansion_width(*f) > NORMAL_SOLVER_LIMIT]
    small = [f for f in families if f not in wide]
    scores: dict[tuple[int, int, float], float] = {}

    if small:
        terms = Terms(small)
        products = _cross_products(narrow, folds, terms)
        fits = [(family, alpha) for family in small for alpha in alphas]
        weights = {f.held: np.zeros((len(terms), len(fits))) for f in folds}
        constants = {f.held: np.zeros(len(fits)) for f in folds}
        for one in folds:
            for i, family in enumerate(small):
                places = terms.of(*family)
                for j, (w, c) in enumerate(_solved(products(one, places), alphas), i * len(alphas)):
                    weights[one.held][places, j], constants[one.held][j] = w, c
        r2 = _scores(narrow, folds, terms, weights, constants)
        scores |= {(*family, alpha): r2[i] for i, (family, alpha) in enumerate(fits)}
    for family in wide:
        found = _wide_fits(narrow, folds, family, alphas)
        weights = {held: np.stack([w for w, _ in fit], axis=1) for held, fit in found.items()}
        constants = {held: np.array([c for _, c in fit]) for held, fit in found.items()}
        r2 = _scores(narrow, folds, Terms([family]), weights, constants)
        scores |= {(*family, alpha): r2[i] for i, alpha in enumerate(alphas)}

    sets = [(a, d, k) for a in grid["model__alpha"] for d in degrees for k in sizes]
    table = [
        (i, float(a), int(d), int(k), float(scores[min(k, most), d, float(a)]))
        for i, (a, d, k) in enumerate(sets)
    ]
    return train.sparkSession.createDataFrame(
        table,
        "grid_position int, model__alpha double, poly__degree int, selector__k int, mean_r2 double",
    )


def best_parameters(scores: DataFrame) -> dict:
    """Parameters of the best mean r2; of equal scores the earlier grid position wins."""
    row = scores.orderBy(F.col("mean_r2").desc(), "grid_position").first()
    return {name: row[name] for name in ("selector__k", "poly__degree", "model__alpha")}
