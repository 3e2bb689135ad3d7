"""Monitoring from stored counts equals a recount of everything, and reads one month."""

import random
from datetime import date

from featuremart.operators import metrics
from featuremart.plans import monitoring
from featuremart.plans.datamart import Datamart
from featuremart.sources import tables

MONTHS = [date(2024, m, 1) for m in range(1, 6)]


def inputs(spark, seed=3, months=MONTHS):
    rng = random.Random(seed)
    rows = [(f"c{i % 40}", m, v, rng.choice([None, round(rng.random(), 2)])) for m in months for v in ("1", "2")
            for i in range(60)]
    predictions = spark.createDataFrame(
        [*rows, ("c1", None, "1", 0.5)], "Customer_ID string, snapshot_date date, model_version string, default_proba double")
    labels = spark.createDataFrame(
        [(f"c{i}", m, rng.choice([0, 1, None])) for m in months for i in range(35)],
        "Customer_ID string, snapshot_date date, label int")
    return predictions, labels


def table(df):
    names = sorted(df.columns)
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()], key=repr)


def test_month_by_month_equals_a_recount(spark, tmp_path):
    path = str(tmp_path / "state")
    predictions, labels = inputs(spark)
    monitoring.update_state(predictions, labels, path, None, MONTHS[2])
    for month in (MONTHS[4], MONTHS[3], date(2024, 4, 17)):  # out of order, and one month twice
        monitoring.update_state(predictions, labels, path, month, month)
    want = table(metrics.monitor(predictions.filter("snapshot_date IS NOT NULL"), labels))
    assert table(monitoring.monitor_state(spark, path)) == want


def test_corrected_months_replace_the_old_ones(spark, tmp_path):
    path = str(tmp_path / "state")
    monitoring.update_state(*inputs(spark), path)
    kept = inputs(spark)[0].filter(f"snapshot_date < '{MONTHS[3]}'")
    fixed_months = inputs(spark, seed=8, months=[MONTHS[3]])
    monitoring.update_state(*fixed_months, path, MONTHS[3], MONTHS[4])  # the last month has no predictions any more
    old_labels = inputs(spark)[1].filter(f"snapshot_date < '{MONTHS[3]}'")
    want = table(metrics.monitor(kept.union(fixed_months[0]).filter("snapshot_date IS NOT NULL"), old_labels.union(fixed_months[1])))
    assert table(monitoring.monitor_state(spark, path)) == want


def test_a_month_reads_its_own_partition_only(spark, tmp_path):
    predictions, labels = inputs(spark)
    folder = str(tmp_path / "predictions")
    predictions.write.partitionBy("snapshot_date").parquet(folder)
    one = monitoring.months_between(spark.read.parquet(folder), MONTHS[1], MONTHS[1])
    assert one.select("snapshot_date").distinct().count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_datamart_counts_one_month_at_a_time(spark, tmp_path):
    mart = Datamart(spark, str(tmp_path))
    predictions, labels = inputs(spark, months=MONTHS[:2])
    tables.write_predictions(predictions.filter("snapshot_date IS NOT NULL"), mart.path("gold", "predictions"))
    tables.write_snapshot(labels, mart.path("gold", "label_store"))
    mart.monitor_month(MONTHS[0])
    assert table(mart.monitor_month(MONTHS[1])) == table(mart.monitor())
