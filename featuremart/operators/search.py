"""Hyper-parameter search: proposals from the trials so far, and many fits in one pass over the rows."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Generator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.operators import metrics
from featuremart.operators.folds import FoldTable, fold_table
from featuremart.operators.modelling import LOGREG_SEARCH, TUNING_FOLDS, TUNING_TRIALS, Search, draw_parameters, with_class_weights
from featuremart.operators.passes import few_tasks, summed, vectors
from featuremart.operators.prep import Preprocessor
from featuremart.session import materialise

# --- fixed values: solvers of the logistic search; "liblinear" also penalises the intercept ---
SOLVERS = ("lbfgs", "liblinear", "saga")
SOLVER_SEARCH = LOGREG_SEARCH | {"solver": (SOLVERS, None, "choice")}
#: Random trials before the first proposal, share of trials that count as good, candidates a proposal is chosen from.
STARTUP, GOOD, CANDIDATES = 5, 0.25, 24

Space = Mapping[str, tuple]
Trial = tuple[Mapping[str, float], float]


def _inner(value: float, scale: str) -> float:
    return math.log(value) if scale == "log" else float(value)


class _Density:
    """Mixture of normals around the values of some trials and one as wide as the range, cut to the range."""

    def __init__(self, values: Sequence[float], low: float, high: float) -> None:
        self.low, self.high = low, high
        centres = sorted([*values, (low + high) / 2])
        near = [max(b - a, c - b) for a, b, c in zip([low, *centres], centres, [*centres[1:], high])]
        least = (high - low) / min(100, 1 + len(centres))
        self.parts = [(c, min(high - low, max(n, least))) for c, n in zip(centres, near, strict=True)]
        self.parts[centres.index((low + high) / 2)] = ((low + high) / 2, high - low)

    def draw(self, rng: random.Random) -> float:
        centre, width = rng.choice(self.parts)
        while True:
            value = rng.gauss(centre, width)
            if self.low <= value <= self.high:
                return value

    def log(self, x: float) -> float:
        def inside(c: float, w: float) -> float:
            return (math.erf((self.high - c) / w / math.sqrt(2)) - math.erf((self.low - c) / w / math.sqrt(2))) / 2

        return math.log(sum(math.exp(-((x - c) / w) ** 2 / 2) / w / inside(c, w) for c, w in self.parts) + 1e-300)


def propose(space: Space, trials: Sequence[Trial], count: int, seed: int = fixed.SEED) -> list[dict[str, float]]:
    """``count`` draws to try next, from finished trials (draw, value; larger is better).

    For every parameter the density of its values in good trials is held against that in
    the others; of candidates drawn from the good ones that with the largest ratio is
    proposed.  Draws of one batch count as bad for those after them, so that they differ.
    Before STARTUP trials draws are random.  The same trials and seed give the same draws.
    """
    if len(trials) < STARTUP:
        return draw_parameters(space, len(trials) + count, seed)[len(trials):]
    ranked = sorted(range(len(trials)), key=lambda i: (-trials[i][1], i))
    good = [trials[i][0] for i in ranked[:max(1, math.ceil(GOOD * len(trials)))]]
    bad = [trials[i][0] for i in ranked[len(good):]]
    rng = random.Random(f"{seed}:{len(trials)}")
    out: list[dict[str, float]] = []
    for _ in range(count):
        draw = {}
        for name, (low, high, scale) in space.items():
            if scale == "choice":
                weight = {v: (1 + sum(t[name] == v for t in good)) / (len(good) + len(low))
                          / ((1 + sum(t[name] == v for t in bad)) / (len(bad) + len(low))) for v in low}
                tried = rng.choices(low, [1 + sum(t[name] == v for t in good) for v in low], k=CANDIDATES)
                draw[name] = max(tried, key=weight.__getitem__)
                continue
            ends = _inner(low, scale), _inner(high, scale)
            likely, other = (_Density([_inner(t[name], scale) for t in some], *ends) for some in (good, bad))
            tried = [likely.draw(rng) for _ in range(CANDIDATES)]
            value = max(tried, key=lambda x: likely.log(x) - other.log(x))
            value = math.exp(value) if scale == "log" else value
            draw[name] = round(value) if scale == "int" else min(max(value, low), high)
        out.append(draw)
        bad = [*bad, draw]
    return out


def search(evaluate: Callable[[list[dict]], Sequence[float]], space: Space, trials: int = TUNING_TRIALS, batch: int = 5,
           seed: int = fixed.SEED) -> list[Trial]:
    """All trials in order: ``evaluate`` gives the values of a batch of draws, the next batch follows from them."""
    done: list[Trial] = []
    while len(done) < trials:
        wanted = min(batch, trials - len(done))
        draws = propose(space, done, wanted if len(done) >= STARTUP else min(wanted, STARTUP - len(done)), seed)
        done += zip(draws, evaluate(draws), strict=True)
    return done


# --- many logistic fits at once ----------------------------------------------------
@dataclass(frozen=True)
class Fit:
    """A logistic fit on the rows of ``group``; ``penalty`` on half the squared coefficients, mean loss."""

    group: int
    penalty: float
    limit: int = 1_000
    penalise_intercept: bool = False


def minimise(size: int, tolerance: float, limit: int, memory: int = 10, inverse: np.ndarray | None = None) -> Generator:
    """Limited-memory BFGS as a coroutine: yields points, is sent their value and gradient, returns the least.

    ``inverse`` is an estimate of the inverse second derivatives, by which steps are scaled.
    """
    point = np.zeros(size)
    value, slope = yield point
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(limit):
        if np.abs(slope).max() <= tolerance:
            break
        way, factors = slope.copy(), []
        for s, y in reversed(steps):
            factors.append((s @ way) / (s @ y))
            way -= factors[-1] * y
        if inverse is not None:
            way = inverse @ way
        elif steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(factors), strict=True):
            way += (a - (y @ way) / (s @ y)) * s
        down = slope @ way
        length = 1.0 if steps or inverse is not None else min(1.0, 1.0 / np.abs(slope).max())
        for _ in range(40):
            new_value, new_slope = yield point - length * way
            if new_value <= value - 1e-4 * length * down + 1e-15 * abs(value):
                break
            length /= 2
        else:
            break  # no further decrease in this precision
        moved, turned = -length * way, new_slope - slope
        if moved @ turned > 1e-300:
            steps = [*steps[-memory + 1:], (moved, turned)]
        gain = value - new_value
        point, value, slope = point + moved, new_value, new_slope
        if gain <= 1e-16 * max(1.0, abs(value)):
            break
    return point


def fit_many(rows: DataFrame, fits: Sequence[Fit], tolerance: float = 1e-10) -> list[np.ndarray]:
    """Coefficients, and the intercept last, of all fits; every iteration of all of them reads ``rows`` once.

    ``rows`` are (group, features array<double>, label, weight).  A group without rows
    gives an empty array.  Losses are weighted means, as of the single fits.
    """
    known = {r["group"]: (r["size"], r["weight"]) for r in rows.groupBy("group").agg(
        F.max(F.size("features")).alias("size"), F.sum("weight").alias("weight")).collect()}
    few = few_tasks(rows)
    return _solve(fits, known, lambda points: summed(rows, _losses(points), few), tolerance)


def _solve(
    fits: Sequence[Fit], known: Mapping[int, tuple[int, float]],
    evaluate: Callable[[Mapping[int, tuple[int, np.ndarray]]], Mapping[int, np.ndarray]], tolerance: float,
    inverse: Callable[[Fit], np.ndarray] | None = None,
) -> list[np.ndarray]:
    """All fits side by side; ``known`` are the number of features and total weight of each group with rows.

    ``evaluate`` sums the losses and slopes of points (group, coefficients) in one pass.
    """
    results: list[np.ndarray] = [np.empty(0) for _ in fits]
    running, points = {}, {}
    for i, fit in enumerate(fits):
        if fit.group in known:
            running[i] = minimise(known[fit.group][0] + 1, tolerance, fit.limit, inverse=inverse(fit) if inverse else None)
            points[i] = next(running[i])
    while points:
        sums = evaluate({i: (fits[i].group, p) for i, p in points.items()})
        for i in list(points):
            fit, size = fits[i], known[fits[i].group][1]
            penalised = points[i].copy()
            if not fit.penalise_intercept:
                penalised[-1] = 0.0
            value = sums[i][0] / size + fit.penalty / 2 * float(penalised @ penalised)
            try:
                points[i] = running[i].send((value, sums[i][1:] / size + fit.penalty * penalised))
            except StopIteration as end:
                results[i] = end.value
                del points[i], running[i]
    return results


def fit_folds(table: FoldTable, fits: Sequence[Fit], tolerance: float) -> list[np.ndarray]:
    """The same for groups that are targets of ``table``: folds, and all rows last; steps are scaled by curvature."""
    few = few_tasks(table.rows)
    # class weights add up to the number of rows
    known = {t: (m.shape[1] - 1, float(n)) for t, (m, n) in enumerate(zip(table.maps, table.totals, strict=True)) if n}

    def inverse(fit: Fit) -> np.ndarray:
        penalty = np.full(known[fit.group][0] + 1, fit.penalty)
        if not fit.penalise_intercept:
            penalty[-1] = 0.0
        return table.curvature(fit.group, penalty)

    return _solve(fits, known, lambda points: table.losses(points, few), tolerance, inverse)


def _losses(points: Mapping[int, tuple[int, np.ndarray]]):
    by_group: dict[int, list[int]] = {}
    for i, (group, _) in points.items():
        by_group.setdefault(group, []).append(i)
    matrices = {g: np.stack([points[i][1] for i in ids], axis=1) for g, ids in by_group.items()}

    def partial(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        groups = np.asarray(batch.column("group"))
        for group, ids in by_group.items():
            part = batch.filter(pa.array(groups == group))
            if not part.num_rows:
                continue
            x, (w, y) = vectors(part.column("features")), (np.asarray(part.column(c), dtype=np.float64) for c in ("weight", "label"))
            z = x @ matrices[group][:-1] + matrices[group][-1]
            loss = w @ (np.logaddexp(0, z) - y[:, None] * z)
            error = w[:, None] * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y[:, None])
            slopes = np.vstack([x.T @ error, error.sum(axis=0)])
            for k, i in enumerate(ids):
                out[i] = np.r_[loss[k], slopes[:, k]]
        return out

    return partial


@dataclass
class LinearModel:
    """Fitted coefficients; ``transform`` adds the probabilities of both classes to rows with a features vector."""

    coefficients: list[float]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array("features"), F.array(*[F.lit(c) for c in self.coefficients]), lambda x, c: x * c)
        margin = F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b)
        one = 1 / (1 + F.exp(-margin))
        return df.withColumn("probability", array_to_vector(F.array(1 - one, one)))


@dataclass
class FoldMatrix:
    """Rows to fit on and held-out rows of every fold, prepared by statistics of the fold's own training rows."""

    train: DataFrame
    held: DataFrame
    sizes: dict[int, int]

    def held_out(self, models: Mapping[int, Sequence[tuple[int, np.ndarray]]]) -> DataFrame:
        """``group, draw, label, default_proba`` of the held-out rows of each group by its models (draw, coefficients)."""

        def run(batches):
            for batch in batches:
                groups = np.asarray(batch.column("group"))
                for group, found in models.items():
                    part = batch.filter(pa.array(groups == group))
                    if not part.num_rows:
                        continue
                    x, label = vectors(part.column("features")), part.column("label")
                    for i, values in found:
                        z = x @ values[:-1] + values[-1]
                        yield pa.RecordBatch.from_pydict({
                            "group": part.column("group"), "draw": pa.array([i] * len(z), pa.int32()), "label": label,
                            "default_proba": pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))})

        return self.held.mapInArrow(run, "group int, draw int, label int, default_proba double")


def fold_matrix(steps: Preprocessor, df: DataFrame, label: str = "label", fold: str = "fold",
                folds: int = TUNING_FOLDS) -> FoldMatrix:
    """Both written once: (group, features, label, weight) and (group, features, label)."""
    parts, held = [], []
    for k in range(folds):
        train = df.filter(F.col(fold) != k)
        fitted = replace(steps).fit(train)
        ready = with_class_weights(fitted.assemble(train, [label]), label)
        values = [F.lit(k).alias("group"), vector_to_array("features").alias("features"), F.col(label).cast("int").alias("label")]
        parts.append(ready.select(*values, F.col("weight").cast("double")))
        held.append(fitted.assemble(df.filter(F.col(fold) == k), [label]).select(*values))
    train, unseen = parts[0], held[0]
    for p, h in zip(parts[1:], held[1:], strict=True):
        train, unseen = train.union(p), unseen.union(h)
    train = materialise(train, "folds")
    return FoldMatrix(train, materialise(unseen, "held-out"),
                      {r["group"]: r["count"] for r in train.groupBy("group").count().collect()})


def fits_of(draw: Mapping, groups: Mapping[int, int]) -> list[Fit]:
    """One fit of a draw (C, maxIter and solver) for every group, whose number of rows is given."""
    return [Fit(g, 1.0 / (draw["C"] * n), int(draw["maxIter"]), draw.get("solver") == "liblinear") for g, n in sorted(groups.items())]


def held_out_auc(matrix: FoldMatrix | FoldTable, draws: Sequence[Mapping], tolerance: float = 1e-5) -> list[float]:
    """Mean AUC of each draw over the folds; a pass over the training rows is an iteration of all fits."""
    fits = [(i, fit) for i, draw in enumerate(draws) for fit in fits_of(draw, matrix.sizes)]
    wanted = [fit for _, fit in fits]
    solved = fit_folds(matrix, wanted, tolerance) if isinstance(matrix, FoldTable) else fit_many(matrix.train, wanted, tolerance)
    by_group: dict[int, list[tuple[int, np.ndarray]]] = {}
    for (i, fit), values in zip(fits, solved, strict=True):
        by_group.setdefault(fit.group, []).append((i, values))
    scored = matrix.held_out(by_group)
    found = metrics.roc_auc(scored, groups=["group", "draw"]).collect()
    totals = [0.0] * len(draws)
    for row in sorted(found, key=lambda r: (r["draw"], r["group"])):
        totals[row["draw"]] += row["auc_roc"] or 0.0
    return [t / len(matrix.sizes) for t in totals]


def tune_logistic(steps: Preprocessor, df: DataFrame, space: Space = SOLVER_SEARCH, trials: int = TUNING_TRIALS,
                  batch: int = 5, label: str = "label", fold: str = "fold", folds: int = TUNING_FOLDS,
                  seed: int = fixed.SEED) -> Search:
    """Sequential search of the logistic learner over given folds, refitted on all rows.

    The folds' rows are prepared and written once; every iteration of all fits of a batch
    of draws is one pass over them.
    """
    table = fold_table(steps, df, label, fold, folds)
    matrix = fold_matrix(steps, df, label, fold, folds) if table is None else table
    done = search(lambda draws: held_out_auc(matrix, draws), space, trials, batch, seed)
    best = dict(max(done, key=lambda t: t[1])[0])
    if table is None:
        fitted = replace(steps).fit(df)
        rows = materialise(with_class_weights(fitted.assemble(df, [label]), label).select(
            F.lit(0).alias("group"), vector_to_array("features").alias("features"), F.col(label).cast("int").alias("label"),
            F.col("weight").cast("double")), "features")
        values = fit_many(rows, fits_of(best, {0: rows.count()}), 1e-7)[0]
    else:
        fitted = table.steps[-1]
        values = fit_folds(table, fits_of(best, {folds: table.totals[-1]}), 1e-7)[0]
    return Search([dict(d) for d, _ in done], [v for _, v in done], best, fitted,
                  LinearModel([float(v) for v in values[:-1]], float(values[-1])))
