"""One stored table serves all folds: statistics, fits and scores equal those of each fold on its own."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featuremart.operators import folds, metrics, modelling, prep, search

STEPS = prep.Preprocessor(["n", "m", "k"], ["c"], ["items"])


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        n, c = rng.gauss(50_000, 9_000), rng.choice(["p", "q", "r", None])
        label = int((n - 50_000) / 9_000 + (c == "p") + rng.gauss(0, 1) > 0.4)
        fold = None if i % 41 == 0 else 9 if i % 37 == 0 else i % 3
        data.append((n if rng.random() > 0.3 else None, float("nan") if rng.random() < 0.2 else rng.random(), 4.0,
                     "only" if fold == 1 and i % 5 == 0 else c, rng.choice(["x|y", "y", " z |x", None]), fold, label))
    return spark.createDataFrame(data, "n double, m double, k double, c string, items string, fold int, label int").repartition(5).cache()


@pytest.fixture(scope="module")
def table(rows):
    return folds.fold_table(STEPS, rows, "label", "fold", 3)


def test_steps_of_all_folds_equal_those_of_each(rows, table):
    for k, found in enumerate(table.steps):
        own = rows if k == 3 else rows.filter(F.col("fold") != k)
        single = replace(STEPS).fit(own)
        assert found.medians_ == single.medians_ and found.modes_ == single.modes_
        assert found.categories_ == single.categories_ and found.tokens_ == single.tokens_
        assert table.totals[k] == own.count()
        for c, (mean, std) in single.moments_.items():
            assert found.moments_[c] == pytest.approx((mean, std), rel=1e-12, abs=1e-12)


def test_fits_and_scores_equal_those_of_single_folds(rows, table):
    matrix = search.fold_matrix(STEPS, rows, "label", "fold", 3)
    assert table.sizes == matrix.sizes
    draws = [{"C": 0.05, "maxIter": 500}, {"C": 10.0, "maxIter": 500, "solver": "liblinear"}]
    fits = [f for d in draws for f in search.fits_of(d, matrix.sizes)]
    for ours, theirs in zip(search.fit_folds(table, fits, 1e-10), search.fit_many(matrix.train, fits), strict=True):
        assert np.allclose(ours, theirs, atol=1e-6)
    assert search.held_out_auc(table, draws, 1e-8) == pytest.approx(search.held_out_auc(matrix, draws, 1e-8), abs=1e-9)
    assert table.held_out({0: [(0, np.zeros(table.maps[0].shape[1]))]}).count() == rows.filter("fold = 0").count()


def test_a_batch_of_draws_in_all_folds_takes_few_passes(table, monkeypatch):
    """Before, a batch took some forty passes over rows that were stored once a fold."""
    passes = []
    real = folds.summed
    monkeypatch.setattr(folds, "summed", lambda *a: passes.append(1) or real(*a))
    draws = [{"C": c, "maxIter": 500} for c in (0.01, 0.3, 1.0, 20.0, 100.0)]
    assert len(search.held_out_auc(table, draws)) == 5
    assert len(passes) <= 15


def test_draws_of_the_logistic_learner_share_their_passes(rows, table, monkeypatch):
    """Before, each draw was fitted on its own in each fold: here that is not done before the search has ended."""
    passes = []
    real = folds.summed
    monkeypatch.setattr(folds, "summed", lambda *a: passes.append(1) or real(*a))
    alone = []
    single = modelling.logistic_regression
    monkeypatch.setattr(modelling, "logistic_regression", lambda **p: alone.append(1) or single(**p))
    draws = modelling.draw_parameters(modelling.LOGREG_SEARCH, 15)
    found = modelling.tune(modelling.logistic_trial, STEPS, rows, draws, folds=3)
    assert len(passes) <= 20 and len(found.mean_auc) == 15 and len(alone) == 1
    assert found.mean_auc == pytest.approx(search.held_out_auc(table, draws, 1e-6), abs=1e-9)


def test_wide_vocabularies_stay_sparse(rows, monkeypatch):
    monkeypatch.setattr(folds, "WIDEST", 8)
    assert folds.fold_table(STEPS, rows, "label", "fold", 3) is None
    found = search.tune_logistic(STEPS, rows, trials=2, batch=2, folds=3)
    assert len(found.mean_auc) == 2 and len(found.model.coefficients) == len(found.steps.feature_names)


def test_an_empty_column_or_another_label_is_an_error(rows):
    with pytest.raises(ValueError, match="no values"):
        folds.fold_table(STEPS, rows.withColumn("m", F.lit(None).cast("double")), "label", "fold", 3)
    with pytest.raises(ValueError, match="labels"):
        folds.fold_table(STEPS, rows.withColumn("label", F.lit(2)), "label", "fold", 3)


def test_refitted_model_scores_like_the_assembled_rows(rows):
    found = search.tune_logistic(STEPS, rows, trials=3, batch=3, folds=3)
    ready = search.with_class_weights(found.steps.assemble(rows, ["label"])).select(
        F.lit(0).alias("group"), vector_to_array("features").alias("features"), "label", "weight")
    values = search.fit_many(ready, search.fits_of(found.best, {0: 600}))[0]
    assert np.allclose([*found.model.coefficients, found.model.intercept], values, atol=1e-5)
    scored = modelling.score_rows(found.model, found.steps, rows, ["label"])
    assert metrics.roc_auc(scored).first()["auc_roc"] > 0.7
