import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from featuremart.operators import metrics, profiling, registry
from featuremart.sources import tables

RUNS = "run_id string, status string, train_date date, auc_oot double, auc_test double, model_name string, version int, stage string"
DAY, OTHER = date(2024, 1, 1), date(2024, 4, 1)


@pytest.fixture
def runs(spark):
    return spark.createDataFrame([
        ("a", "FINISHED", DAY, 0.80, 0.75, "m", 1, "Production"), ("b", "FINISHED", DAY, 0.90, None, "m", 2, "Staging"),
        ("c", "FAILED", DAY, 0.99, 0.99, "m", 10, "None"), ("d", "FINISHED", OTHER, None, 0.9, "m", 9, "Production"),
        ("e", "FINISHED", OTHER, float("nan"), 0.9, "n", 1, "Staging")], RUNS)


def test_best_run_and_guard(runs):
    assert [r["run_id"] for r in registry.best_run(runs).collect()] == ["b"]
    assert registry.best_run(runs, train_date=OTHER).count() == 0
    outcome = {r["train_date"]: r["outcome"] for r in registry.promotion_decision(runs).collect()}
    assert outcome == {DAY: "guard_failed", OTHER: "no_run"}
    free = {r["train_date"]: r["outcome"] for r in registry.promotion_decision(runs, min_test=None).collect()}
    assert free[DAY] == "promote"


def test_latest_version_is_numeric(runs):
    assert [r["version"] for r in registry.latest_in_stage(runs).collect()] == [9]


@pytest.mark.parametrize("new,current,promote", [
    (0.8, 0.8, False), (0.8 + 5e-7, 0.8, False), (0.8 + 2e-6, 0.8, True), (0.1, None, True), (None, 0.8, False),
    (float("nan"), None, False), (0.2, float("nan"), True)])
def test_champion_challenger(spark, new, current, promote):
    candidates = spark.createDataFrame([("x", "m", new)], "run_id string, model_name string, auc_oot double")
    held = spark.createDataFrame([("m", 1, "Production", current)], "model_name string, version int, stage string, auc_oot double")
    assert registry.champion_challenger(candidates, held).first()["promote"] is promote
    assert registry.champion_challenger(candidates, held.filter("version = 0")).first()["promote"] is (
        new is not None and new == new)


def test_transition(runs):
    chosen = runs.filter("run_id = 'b'")
    got = {r["run_id"]: r for r in registry.transition_stage(runs, chosen, snapshot=["run_id", "auc_oot"]).collect()}
    assert {k: r["stage"] for k, r in got.items()} == {
        "a": "Archived", "b": "Production", "c": "None", "d": "Archived", "e": "Staging"}
    assert got["b"]["description"] == '{"run_id":"b","auc_oot":0.9}' and got["a"]["description"] is None
    kept = registry.transition_stage(runs, chosen, archive_existing=False).filter("stage = 'Production'")
    assert kept.count() == 3


def test_dedupe_runs(spark):
    df = spark.createDataFrame([("v", False, None), ("v", True, datetime(2024, 1, 1)), ("v", True, datetime(2024, 2, 1)),
                                ("w", None, None)], "model_version string, promoted_flag boolean, promoted_at timestamp")
    got = {r["model_version"]: r["promoted_at"] for r in registry.dedupe_runs(df).collect()}
    assert got == {"v": datetime(2024, 2, 1), "w": None}


def months(spark, *numbers):
    return spark.createDataFrame([(date(2023, m, 15),) for m in numbers for _ in range(2)], "d date")


@pytest.mark.parametrize("a,b,anchor,ready", [
    ((1, 2, 3, 4), (1, 2, 3, 4, 5), date(2023, 4, 20), 4), ((1, 3, 4), (1, 2, 3, 4), date(2023, 4, 1), 2),
    ((1, 2, 3), (1, 2, 3), date(2023, 4, 1), 0), ((1, 2, 3, 4), (1, 2, 3, 4), date(2023, 2, 1), 2)])
def test_month_coverage(spark, a, b, anchor, ready):
    row = registry.month_coverage([months(spark, *a), months(spark, *b)], F.lit(anchor), 2).first()
    assert (row["months_ready"], row["enough"]) == (ready, ready >= 2)


def test_run_decision(spark):
    covered = [months(spark, *range(1, 13))]
    model = spark.createDataFrame(
        [("a", "Production", 1, date(2023, 9, 30)), ("a", "Staging", 2, date(2023, 11, 1)),
         ("b", "Production", 9, date(2021, 1, 1))], "model_name string, stage string, version int, train_date date")

    def step(when, registry_rows=model, **options):
        return registry.run_decision(registry_rows, covered, when, "a", minimum=6, **options).first()["next_step"]

    assert step(date(2023, 12, 29)) == "infer"  # two whole months
    assert step(date(2023, 12, 30)) == "train"
    assert step(date(2023, 12, 1), force=True) == "train"
    assert step(date(2023, 12, 1), model.filter("version = 2")) == "train"  # no production model
    assert step(date(2023, 5, 1), force=True) == "infer"  # not enough history
    assert step(date(2023, 12, 1)) == "infer"  # the old version of another model plays no part


def test_decision_before_the_first_run(spark, tmp_path):
    none = tables.read_runs(spark, str(tmp_path / "nothing"))
    assert registry.run_decision(none, [months(spark, *range(1, 13))], date(2023, 12, 1), "a", minimum=6).first()[
        "next_step"] == "train"
    assert registry.latest_in_stage(none).count() == 0 and registry.best_run(none).count() == 0


def test_promotions_keep_older_descriptions(spark):
    rows = [("a", 1, "Production", "r1", "old"), ("a", 2, "Staging", "r2", None), ("b", 1, "Staging", "r3", "note")]
    df = spark.createDataFrame(rows, "model_name string, version int, stage string, run_id string, description string")
    chosen = spark.createDataFrame([("a", 2)], "model_name string, version int")
    again = spark.createDataFrame([("b", 1)], "model_name string, version int")
    got = registry.transition_stage(registry.transition_stage(df, chosen, snapshot=["run_id"]), again, snapshot=["run_id"])
    assert sorted(got.columns) == sorted(df.columns)
    assert {(r.run_id, r.stage, r.description) for r in got.collect()} == {
        ("r1", "Archived", "old"), ("r2", "Production", '{"run_id":"r2"}'), ("r3", "Production", '{"run_id":"r3"}')}


def test_promotion_note_is_nested(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.append_run(spark, [{"model_version": "1", "version": 1, "model_name": "a", "run_id": "r", "stage": "None",
                               "auc_oot": 0.75, "flavor": "logreg"}], path)
    runs = tables.read_runs(spark, path)
    row = registry.promote(runs, runs.select("model_name", "version")).first()
    note = json.loads(row["description"])
    assert row["promoted_flag"] and row["promoted_at"] and note["metrics"]["auc_oot"] == 0.75
    assert note["params"]["flavor"] == "logreg" and note["run_id"] == "r"


def test_versions_are_monitored_apart(spark):
    rows = [(f"c{i}", date(2024, 1, 1), i / 10, v) for i in range(8) for v in ("1", "2")]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, default_proba double, model_version string")
    truth = spark.createDataFrame([(f"c{i}", date(2024, 1, 1), int(i > 4)) for i in range(8)],
                                  "Customer_ID string, snapshot_date date, label int")
    got = metrics.monitor(df, truth).collect()
    assert [(r.model_version, r.sample_size, r.tp + r.tn + r.fp + r.fn, r.auc_roc) for r in got] == [
        ("1", 8, 8, 1.0), ("2", 8, 8, 1.0)]
    pooled = metrics.monitor(df, truth, groups=[]).collect()
    assert [r.sample_size for r in pooled] == [16]


def test_bands(one):
    assert one(metrics.drift_band("x"), 0.05, 0.1, 0.25, 0.2500001, None, type="double") == [
        "stable", "moderate", "moderate", "significant", None]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2.0, "b"), (3, 4.0, "b"), (4, 4.0, None)], "k int, x double, s string")
    assert [tuple(r) for r in profiling.null_profile(df).collect()] == [("x", 1, 0.25), ("s", 1, 0.25), ("k", 0, 0.0)]
    assert [tuple(r) for r in profiling.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert profiling.duplicate_row_count(df, ["k"]).first()[0] == 1
    assert [tuple(r) for r in profiling.value_counts(df, "s", 2).collect()] == [("b", 2), ("a", 1)]
    assert tuple(profiling.describe_text(df, ["s"]).first()) == ("s", 3, 2, "b", 2)
    assert profiling.duplicate_row_count(df.filter("k > 9"), ["k"]).first()[0] == 0
    got = {r["bin"]: r["rows"] for r in profiling.histogram(df, ["x"], 4).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 2}
    flat = {r["bin"]: (r["bin_start"], r["rows"]) for r in profiling.histogram(df.filter("x = 4"), ["x"], 2).collect()}
    assert flat == {0: (3.5, 0), 1: (4.0, 2)}
    rules = {r["rule"]: r["violations"] for r in profiling.rule_violations(df, {"big": F.col("x") > 3, "small": F.col("x") < 0}).collect()}
    assert rules == {"big": 2, "small": 0}


def test_monitoring_tables(spark):
    m = spark.createDataFrame([(date(2024, i, 1), 10 * i, str(i / 10) if i < 4 else "bad") for i in (1, 2, 3, 4)],
                              "month date, sample_size int, accuracy string")
    row = metrics.monitoring_overview(m).first()
    assert row["coverage_months"] == 4 and row["avg_sample_size"] == 25 and row["avg_accuracy"] == pytest.approx(0.2)
    assert not hasattr(row, "avg_auc_roc")
    assert [r["sample_size_rolling"] for r in profiling.rolling_mean(m, "month", ["sample_size"]).orderBy("month").collect()] == [
        10, 15, 20, 30]
    assert [r["sample_size"] for r in profiling.tail_by(m, ["month"], 2).collect()] == [30, 40]
