"""The rows of a cross-validation, stored once for all folds, and logistic fits of all folds in shared passes.

What a fold's own preprocessing does to a row is affine in a few values that don't
depend on the fold: numbers less their overall median, flags of missing numbers, of
categories and of tokens.  So one table of these serves every fold: a fold's coefficients
are mapped to it before a pass, and slopes are mapped back after it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.operators.passes import few_tasks, summed
from featuremart.operators.prep import Preprocessor, filled_number, fit_without, split_tokens
from featuremart.session import materialise

#: Columns up to which rows are multiplied as dense matrices; wider vocabularies stay with sparse vectors.
WIDEST = 400


def fold_slot(fold: str, folds: int) -> Column:
    """Number of the fold a row is held out of; ``folds`` for a row that every fold is fitted on, one more for NULL."""
    held = [F.when(F.col(fold) == k, k) for k in range(folds)]
    return F.coalesce(*held, F.when(F.col(fold).isNotNull(), folds), F.lit(folds + 1))


@dataclass(frozen=True)
class Layout:
    """Columns of the stored table: numbers, codes of categories (from 1, 0 if missing), flags of tokens."""

    centres: np.ndarray
    flagged: list[int]  # numbers whose missing values the folds fill differently
    sizes: list[int]  # categories of each column
    tokens: int

    @property
    def width(self) -> int:
        return len(self.centres) + len(self.flagged) + sum(n + 1 for n in self.sizes) + self.tokens + 1

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        """Numbers less their centres, flags of missing ones, of each category (missing first) and token, and 1."""
        out = np.zeros((self.width, batch.num_rows))
        for i, centre in enumerate(self.centres):
            np.subtract(batch.column(f"n{i}").to_numpy(zero_copy_only=False), centre, out=out[i])
        at, numbers = len(self.centres), out[:len(self.centres)]
        missing = np.isnan(numbers)
        for i in self.flagged:
            out[at] = missing[i]
            at += 1
        numbers[missing] = 0.0
        rows = np.arange(batch.num_rows)
        for i, n in enumerate(self.sizes):
            out[at + batch.column(f"c{i}").to_numpy(zero_copy_only=False), rows] = 1.0
            at += n + 1
        for i in range(self.tokens):
            out[at] = batch.column(f"t{i}").to_numpy(zero_copy_only=False)
            at += 1
        out[at] = 1.0
        return out.T


@dataclass
class FoldTable:
    """``rows`` of all folds, and per target (each fold, then all rows) the fitted steps and how they map to the table.

    ``maps`` turn a target's coefficients, intercept last, into those of the table's
    columns; ``weights`` are those of both classes by target, slot and label.
    """

    rows: DataFrame
    layout: Layout
    steps: list[Preprocessor]
    maps: list[np.ndarray]
    weights: np.ndarray
    totals: list[int]
    products: np.ndarray

    @property
    def sizes(self) -> dict[int, int]:
        """Training rows of each fold that has any."""
        return {k: n for k, n in enumerate(self.totals[:-1]) if n}

    def curvature(self, target: int, penalty: np.ndarray) -> np.ndarray:
        """Inverse of the loss's second derivatives where all coefficients are 0, by which steps are scaled.

        Products of columns are those of all rows by label: near enough for a fold.
        """
        both = np.tensordot(self.weights[target].max(axis=0), self.products, 1) / max(self.totals[-1], 1)
        curved = self.maps[target].T @ both @ self.maps[target] / 4 + np.diag(penalty)
        values, axes = np.linalg.eigh((curved + curved.T) / 2)
        return (axes / np.maximum(values, 1e-9 * max(values.max(), 1e-9))) @ axes.T

    def losses(self, points: Mapping[int, tuple[int, np.ndarray]], few: bool) -> dict[int, np.ndarray]:
        """Sum of the losses and of their slopes for each point (target, coefficients), in one pass."""
        ids = list(points)
        layout, weights = self.layout, self.weights[[points[i][0] for i in ids]].reshape(len(ids), -1).T
        values = np.stack([self.maps[t] @ p for t, p in points.values()], axis=1)

        def partial(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
            x, y = layout.matrix(batch), np.asarray(batch.column("label"), dtype=np.int64)
            w = weights[2 * np.asarray(batch.column("slot"), dtype=np.int64) + y]
            z = x @ values
            t = np.exp(-np.abs(z))
            loss = (w * (np.maximum(z, 0) + np.log1p(t) - y[:, None] * z)).sum(axis=0)
            slopes = x.T @ (w * (np.where(z >= 0, 1.0, t) / (1 + t) - y[:, None]))
            return {i: np.r_[loss[k], slopes[:, k]] for k, i in enumerate(ids)}

        found = summed(self.rows, partial, few)
        return {i: np.r_[found[i][0], self.maps[t].T @ found[i][1:]] for i, (t, _) in points.items()}

    def held_out(self, models: Mapping[int, Sequence[tuple[int, np.ndarray]]]) -> DataFrame:
        """``group, draw, label, default_proba`` of the rows each fold holds out, by its models (draw, coefficients)."""
        layout = self.layout
        values = {k: ([i for i, _ in found], np.stack([self.maps[k] @ v for _, v in found], axis=1)) for k, found in models.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, slots = layout.matrix(batch), np.asarray(batch.column("slot"))
                y = np.asarray(batch.column("label"), dtype=np.int32)
                for k, (draws, coefficients) in values.items():
                    own = slots == k
                    n = int(own.sum())
                    if not n:
                        continue
                    z = x[own] @ coefficients
                    yield pa.RecordBatch.from_pydict({
                        "group": pa.array(np.full(n * len(draws), k, np.int32)),
                        "draw": pa.array(np.repeat(np.array(draws, np.int32), n)),
                        "label": pa.array(np.tile(y[own], len(draws))),
                        "default_proba": pa.array((1 / (1 + np.exp(-np.clip(z, -700, 700)))).ravel(order="F"))})

        return self.rows.mapInArrow(run, "group int, draw int, label int, default_proba double")


def fold_table(steps: Preprocessor, df: DataFrame, label: str, fold: str, folds: int) -> FoldTable | None:
    """The rows prepared for all folds; None if there are more than WIDEST columns.

    Statistics of all folds come from the same few passes, each from its own training
    rows; the last target has all rows.
    """
    slotted = df.select("*", fold_slot(fold, folds).alias("_slot"))
    fitted, known = fit_without(steps, slotted, "_slot", folds)
    every = fitted[-1]
    vocabularies = [every.categories_[c] for c in steps.categorical]
    tokens = [(c, v) for c in steps.multi_value for v in every.tokens_[c]]
    layout = Layout(
        np.array([every.medians_.get(c, 0.0) for c in steps.numeric], dtype=float),
        [i for i, c in enumerate(steps.numeric) if len({f.medians_.get(c) for f in fitted}) > 1],
        [len(v) for v in vocabularies], len(tokens))
    if layout.width > WIDEST:
        return None
    items = [split_tokens(c, steps.separator).alias(f"_items{i}") for i, c in enumerate(steps.multi_value)]
    place = {c: f"_items{i}" for i, c in enumerate(steps.multi_value)}
    rows = materialise(slotted.select("*", *items).select(
        F.col("_slot").alias("slot"), F.coalesce(F.col(label).cast("int"), F.lit(-1)).alias("label"),
        *[filled_number(c, F.lit(None).cast("double")).alias(f"n{i}") for i, c in enumerate(steps.numeric)],
        *[F.coalesce(F.array_position(F.array(*[F.lit(v) for v in vocabulary]), F.col(c)) if vocabulary else F.lit(None),
                     F.lit(0)).cast("int").alias(f"c{i}")
          for i, (c, vocabulary) in enumerate(zip(steps.categorical, vocabularies, strict=True))],
        *[F.array_contains(place[c], v).cast("int").alias(f"t{i}") for i, (c, v) in enumerate(tokens)]), "folds")

    wide, numbers = layout.width, len(steps.numeric)

    def partial(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        x, slots, y = layout.matrix(batch), np.asarray(batch.column("slot")), np.asarray(batch.column("label"))
        out = {}
        for s in np.unique(slots):
            own = slots == s
            values = x[own, :numbers]
            out[int(s)] = np.r_[np.sum(y[own] == 0), np.sum(y[own] == 1), np.sum(own), values.sum(axis=0), (values ** 2).sum(axis=0)]
        for v in (0, 1):
            some = x[y == v]
            out[-1 - v] = (some.T @ some).ravel()
        return out

    found = summed(rows, partial, few_tasks(rows))
    counts = np.array([found.get(s, np.zeros(3 + 2 * numbers)) for s in range(folds + 2)])
    if counts[:, 2].sum() != counts[:, :2].sum():
        raise ValueError("labels must be 0 or 1")
    maps, weights, totals = [], [], []
    for t, own in enumerate(fitted):
        used = np.array([t == folds or (s != t and s <= folds) for s in range(folds + 2)])
        sums = counts[used].sum(axis=0)
        n = sums[2]
        own.moments_ = {}
        for i, c in enumerate(steps.numeric):
            if not n or c not in own.medians_:
                continue
            # missing values are filled with the own median; all of it as distances from the centre
            shift = own.medians_[c] - layout.centres[i]
            missing = n - known[t][c]
            mean = (sums[3 + i] + missing * shift) / n
            square = (sums[3 + numbers + i] + missing * shift * shift) / n
            own.moments_[c] = (float(layout.centres[i] + mean), float(np.sqrt(max(square - mean * mean, 0.0))))
        if n and len(own.medians_) < numbers:
            raise ValueError(f"no values to fit on: {sorted(set(steps.numeric) - set(own.medians_))}")
        classes = 2.0 if sums[0] and sums[1] else 1.0
        weights.append([[n / (classes * sums[v]) if u and sums[v] else 0.0 for v in (0, 1)] for u in used])
        totals.append(int(n))
        maps.append(_map_of(own, layout, vocabularies, tokens) if n else np.zeros((wide, 1)))
    products = np.array([found.get(-1 - v, np.zeros(wide * wide)).reshape(wide, wide) for v in (0, 1)])
    return FoldTable(rows, layout, fitted, maps, np.array(weights), totals, products)


def _map_of(steps: Preprocessor, layout: Layout, vocabularies: Sequence[Sequence[str]], tokens: Sequence[tuple[str, str]]) -> np.ndarray:
    """Table columns by features (in the order of ``feature_names``) and intercept."""
    features = [*[(c, None) for c in steps.numeric], *[(c, v) for c in steps.categorical for v in steps.categories_[c]],
                *[(c, v) for c in steps.multi_value for v in steps.tokens_[c]]]
    places = {f: i for i, f in enumerate(features)}
    out = np.zeros((layout.width, len(features) + 1))
    for i, c in enumerate(steps.numeric):
        mean, std = steps.moments_[c]
        std = std if std > 0 else 1.0
        out[i, i], out[-1, i] = 1 / std, (layout.centres[i] - mean) / std
    at = len(steps.numeric)
    for i in layout.flagged:
        c = steps.numeric[i]
        out[at, i] = (steps.medians_[c] - layout.centres[i]) * out[i, i]
        at += 1
    for c, vocabulary in zip(steps.categorical, vocabularies, strict=True):
        for v in [steps.modes_.get(c), *vocabulary]:
            if (c, v) in places:
                out[at, places[c, v]] = 1.0
            at += 1
    for token in tokens:
        if token in places:
            out[at, places[token]] = 1.0
        at += 1
    out[at, -1] = 1.0
    return out
