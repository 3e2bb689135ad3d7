"""Regularised boosting against a search over every value of every feature, row by row."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featuremart.operators import boosting, modelling, prep
from featuremart.operators.boosting import Settings


def sample(seed, n=300, features=4, values=12):
    rng = random.Random(seed)
    x = np.array([[rng.randint(0, values) / 3 for _ in range(features)] for _ in range(n)])
    y = np.array([int(a[0] + (a[1] > 2) * 2 - a[2] / 2 + rng.gauss(0, 1) > 2.5) for a in x], float)
    return x, y, np.array([rng.choice([0.5, 1.0, 2.0]) for _ in range(n)])


def frame(spark, x, y, w):
    rows = [(a.tolist(), int(b), float(c)) for a, b, c in zip(x, y, w, strict=True)]
    return spark.createDataFrame(rows, "x array<double>, label int, weight double").repartition(4).select(
        array_to_vector("x").alias("features"), "label", "weight")


def soft(g, alpha):
    return np.sign(g) * max(abs(g) - alpha, 0)


def naive(x, y, w, s, columns=None):
    """Margins by trees that try every cut between neighbouring values."""
    margin = np.zeros(len(x))
    for _ in range(s.n_estimators):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        move = np.zeros(len(x))

        def worth(rows):
            return soft(g[rows].sum(), s.reg_alpha) ** 2 / (h[rows].sum() + s.reg_lambda)

        def grow(rows, depth):
            best = (1e-9, None)
            if depth < s.max_depth:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[:, f])[:-1]:
                        left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                        if min(h[left].sum(), h[right].sum()) < max(s.min_child_weight, 1e-12):
                            continue
                        gain = (worth(left) + worth(right) - worth(rows)) / 2 - s.gamma
                        if gain > best[0] + 1e-12:
                            best = (gain, (left, right))
            if best[1] is None:
                move[rows] = -s.learning_rate * soft(g[rows].sum(), s.reg_alpha) / (h[rows].sum() + s.reg_lambda)
            else:
                for side in best[1]:
                    grow(side, depth + 1)

        grow(np.arange(len(x)), 0)
        margin = margin + move
    return margin


@pytest.mark.parametrize("s", [
    Settings(n_estimators=1, max_depth=3),
    Settings(n_estimators=3, max_depth=3, reg_alpha=0.8, reg_lambda=2.0, gamma=0.2, min_child_weight=4),
    Settings(n_estimators=10, max_depth=2, learning_rate=0.2, reg_alpha=0.1),
    Settings(n_estimators=2, max_depth=2, gamma=1e6),
])
def test_trees_equal_a_search_over_every_cut(spark, s):
    x, y, w = sample(1)
    model = boosting.fit_boosted(frame(spark, x, y, w), s)
    assert np.allclose(model.margins(x), naive(x, y, w, s), atol=1e-9)


def test_margins_written_on_the_way_change_nothing(spark, monkeypatch):
    x, y, w = sample(2)
    rows, s = frame(spark, x, y, w), Settings(n_estimators=7, max_depth=2)
    whole = boosting.fit_boosted(rows, s).margins(x)
    monkeypatch.setattr(boosting, "WRITTEN_EVERY", 2)
    assert np.allclose(boosting.fit_boosted(rows, s).margins(x), whole, atol=1e-9)


def test_penalties_shrink_leaves_and_samples_repeat(spark):
    x, y, w = sample(3)
    rows = frame(spark, x, y, w)
    plain, heavy = (boosting.fit_boosted(rows, Settings(n_estimators=3, max_depth=3, reg_alpha=a, reg_lambda=b))
                    for a, b in ((0.0, 1.0), (5.0, 50.0)))
    assert np.abs(heavy.margins(x)).max() < np.abs(plain.margins(x)).max() / 2
    s = Settings(n_estimators=4, max_depth=3, subsample=0.7, colsample_bytree=0.5)
    a, b = (boosting.fit_boosted(r, s).margins(x) for r in (rows, rows.repartition(2)))
    assert np.allclose(a, b) and not np.allclose(a, boosting.fit_boosted(rows, Settings(n_estimators=4, max_depth=3)).margins(x))
    used = [{f for f in t.feature if f >= 0} for t in boosting.fit_boosted(rows, s).trees]
    assert all(len(u) <= 2 for u in used)


def test_a_constant_feature_one_class_and_no_rows(spark):
    x, y, w = sample(4, n=60)
    x[:, 1] = 7.0
    model = boosting.fit_boosted(frame(spark, x, y, w), Settings(n_estimators=2, max_depth=2))
    assert all(1 not in t.feature for t in model.trees)
    ones = boosting.fit_boosted(frame(spark, x, np.ones(60), w), Settings(n_estimators=5))
    assert (ones.margins(x) > 0).all()
    nothing = frame(spark, x, y, w).limit(0)
    assert boosting.fit_boosted(nothing).trees == []


def test_many_values_are_cut_evenly(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2_000, 2))
    y = (x[:, 0] + rng.normal(0, 0.3, 2_000) > 0.5).astype(float)
    rows = frame(spark, x, y, np.ones(2_000))
    model = boosting.fit_boosted(rows, Settings(n_estimators=5, max_depth=2, bins=16))
    assert all(8 <= len(e) <= 16 for e in model.edges)
    scored = model.transform(rows).collect()
    assert np.mean([(r["probability"] > 0.5) == (r["label"] == 1) for r in scored]) > 0.85


def test_trees_are_tuned_over_folds(spark):
    rows = spark.range(240).select(
        (F.col("id") % 60).cast("double").alias("n"), (F.col("id") % 7).cast("double").alias("m"),
        ((F.col("id") % 60 > 20) & (F.col("id") % 60 < 40)).cast("int").alias("label"), (F.col("id") % 2).cast("int").alias("fold"))
    draws = modelling.draw_parameters(boosting.BOOSTED_SEARCH | {"n_estimators": (2, 3, "int"), "colsample_bytree": (1.0, 1.0, "linear")}, 2)
    found = modelling.tune(boosting.boosted_trial, prep.Preprocessor(["n", "m"], []), rows, draws, folds=2)
    assert found.best in draws and max(found.mean_auc) > 0.9
    assert modelling.score_rows(found.model, found.steps, rows, ["label"]).where("default_proba BETWEEN 0 AND 1").count() == 240
