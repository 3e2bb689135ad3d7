"""Sequential proposals against random draws, and many fits in one pass against single fits."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featuremart.operators import modelling, prep, search

SPACE = {"C": (1e-2, 1e2, "log"), "depth": (1, 9, "int"), "share": (0.0, 1.0, "linear"),
         "solver": (("a", "b", "c"), None, "choice")}


def value(draw):
    """A smooth peak inside the ranges, lower under the wrong choice."""
    return (1 - (math.log10(draw["C"]) - 0.7) ** 2 / 8 - (draw["depth"] - 6) ** 2 / 80 - (draw["share"] - 0.3) ** 2
            - 0.1 * (draw["solver"] != "b"))


def test_proposals_beat_random_draws_of_the_same_number():
    wins, gains = 0, []
    for seed in range(12):
        done = search.search(lambda draws: [value(d) for d in draws], SPACE, 40, 5, seed)
        drawn = modelling.draw_parameters(SPACE, 40, seed)
        ours, theirs = max(v for _, v in done), max(map(value, drawn))
        wins += ours >= theirs
        gains.append(ours - theirs)
    assert wins >= 9 and np.mean(gains) > 0


def test_proposals_repeat_and_stay_inside():
    runs = [search.search(lambda draws: [value(d) for d in draws], SPACE, 23, 4, 3) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 23
    assert [d for d, _ in runs[0][:5]] == modelling.draw_parameters(SPACE, 5, 3)
    for draw, _ in runs[0]:
        assert 1e-2 <= draw["C"] <= 1e2 and draw["depth"] in range(1, 10) and 0 <= draw["share"] <= 1
        assert draw["solver"] in "abc"


def test_proposals_of_equal_trials():
    """Ties, one value everywhere and ends of the ranges."""
    trials = [({"C": 1e-2, "depth": 1, "share": 0.0, "solver": "a"}, 0.5)] * 9
    assert len(search.propose(SPACE, trials, 3)) == 3
    batch = search.propose(SPACE, [(d, value(d)) for d in modelling.draw_parameters(SPACE, 20)], 6)
    assert len({d["C"] for d in batch}) == 6


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(1)
    rows = []
    for group in (0, 1, 4):
        for i in range(150):
            x = [rng.gauss(0, 1) for _ in range(3 + group)]
            label = int(x[0] - 0.5 * x[1] + rng.gauss(0, 1) > 0.4)
            rows.append((group, x, label, rng.choice([0.5, 1.0, 2.0])))
    return spark.createDataFrame(rows, "group int, features array<double>, label int, weight double").repartition(5).cache()


FITS = [search.Fit(g, penalty) for g in (0, 1, 4) for penalty in (1e-3, 0.05, 1.0)]


def test_fits_equal_those_of_the_single_learner(groups):
    for fit, found in zip(FITS, search.fit_many(groups, FITS), strict=True):
        rows = groups.where(F.col("group") == fit.group).select(array_to_vector("features").alias("features"), "label", "weight")
        single = modelling.logistic_regression(regParam=fit.penalty, maxIter=500, tol=1e-14).fit(rows)
        assert np.allclose(found[:-1], single.coefficients.toArray(), atol=1e-6)
        assert found[-1] == pytest.approx(single.intercept, abs=1e-6)


def test_all_fits_share_their_passes(groups, monkeypatch):
    passes = []
    real = search.summed
    monkeypatch.setattr(search, "summed", lambda *a: passes.append(1) or real(*a))
    alone = []
    for fit in FITS[:3]:
        passes.clear()
        search.fit_many(groups, [fit])
        alone.append(len(passes))
    passes.clear()
    search.fit_many(groups, FITS[:3])
    assert len(passes) <= max(alone) + 3 < sum(alone)


def test_a_penalised_intercept_and_a_group_without_rows(groups):
    found = search.fit_many(groups, [search.Fit(0, 0.5, penalise_intercept=True), search.Fit(9, 0.5)])
    assert len(found[1]) == 0
    data = groups.where("group = 0").collect()
    x = np.array([[*r.features, 1.0] for r in data])
    y, w = (np.array([r[c] for r in data], float) for c in ("label", "weight"))
    slope = x.T @ (w * (1 / (1 + np.exp(-x @ found[0])) - y)) / w.sum() + 0.5 * found[0]
    assert np.abs(slope).max() < 1e-8


def test_sums_of_many_tasks_are_added_before_the_driver(groups):
    partial = search._losses({0: (1, np.ones(5)), 3: (4, np.zeros(8))})
    one, two = (search.summed(groups.repartition(70), partial, few) for few in (True, False))
    assert set(one) == set(two) == {0, 3}
    assert all(np.allclose(one[k], two[k]) for k in one)


def test_limits_end_a_fit(groups):
    few = search.fit_many(groups, [search.Fit(0, 1e-3, 1)])[0]
    many = search.fit_many(groups, [search.Fit(0, 1e-3, 100)])[0]
    assert np.abs(few - many).max() > 1e-3


def test_the_search_over_folds(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame(
        [(rng.gauss(0, 1), rng.choice(["p", "q", None]), rng.random() < 0.1, i % 3) for i in range(400)],
        "n double, c string, odd boolean, fold int").withColumn(
        "label", (F.col("n") + F.when(F.col("c") == "p", 1.0).otherwise(0.0) > F.when(F.col("odd"), -9.0).otherwise(0.3)).cast("int"))
    steps = prep.Preprocessor(["n"], ["c"])
    found = search.tune_logistic(steps, rows, trials=7, batch=2, folds=3)
    assert len(found.draws) == 7 and found.mean_auc[found.draws.index(found.best)] == max(found.mean_auc) > 0.7
    draws = found.draws[:2]  # the same values as by one learner after the other
    slow = modelling.tune(lambda d, n: modelling.logistic_regression(maxIter=500, tol=1e-12, **modelling.penalty(d["C"], n)),
                          steps, rows, [d for d in draws if d["solver"] != "liblinear"], folds=3)
    fast = [v for d, v in zip(draws, found.mean_auc) if d["solver"] != "liblinear"]
    assert np.allclose(fast, slow.mean_auc, atol=1e-3)
    scored = modelling.score_rows(found.model, found.steps, rows, ["label"])
    assert scored.where("default_proba NOT BETWEEN 0 AND 1").count() == 0
    assert scored.where("label = 1").agg(F.avg("default_proba")).first()[0] > scored.where("label = 0").agg(F.avg("default_proba")).first()[0]
