"""The point-in-time step works on the rows that labels take, and gives what the plain join gives."""

import re
from datetime import date

from pyspark.sql import functions as F

from checks.pit_queries import features
from checks.views import Inputs
from featuremart.operators import pit
from featuremart.plans import silver
from tests.test_plans import SMALL, plan

SOURCE = "Customer_ID string, snapshot_date date, v int"
BATCH = "Customer_ID string, label_snapshot_date date"


def test_only_rows_that_a_label_takes_are_made(spark):
    source = spark.createDataFrame([
        ("c", date(2023, 1, 1), -1), ("c", date(2023, 3, 1), 5), ("c", date(2023, 3, 1), 4),
        ("c", date(2023, 7, 1), 6), ("c", date(2023, 9, 1), -1), ("z", date(2023, 1, 1), -1)], SOURCE)
    labels = spark.createDataFrame([("c", date(2023, 9, 1)), ("c", date(2024, 1, 1))], BATCH)

    def make(rows):
        unwanted = F.raise_error(F.lit("made for no label")).cast("int")
        return rows.select("Customer_ID", "snapshot_date", F.when(F.col("v") < 0, unwanted).otherwise(F.col("v")).alias("w"))

    got = pit.as_of_latest(labels, source, 6, ["w"], "seen", make).orderBy("label_snapshot_date").collect()
    assert [(r["w"], r["seen"]) for r in got] == [(4, date(2023, 3, 1)), (6, date(2023, 7, 1))]


def test_no_running_sum_is_carried_over_all_events(spark):
    above_union = plan(features(Inputs(spark, SMALL))).split("- Union")[0]
    assert "last(" in above_union and "sum(" not in above_union


def test_dirty_integers_are_parsed_once(spark):
    raw = Inputs(spark, SMALL).view("financials")
    text = silver.silver_financials(raw).select("Num_of_Loan", "Num_of_Delayed_Payment")
    optimized = text._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_replace\(Num_of_Loan", optimized)) <= 1
    assert optimized.count("regexp_replace(") == 2


def test_labels_with_one_cutoff_and_gaps_agree_with_the_join(spark):
    """Ends of months share a cutoff; some customers have labels without rows, or rows between no cutoffs."""
    day = F.date_add(F.lit(date(2022, 8, 25)), (F.col("id") * 7 % 200).cast("int"))
    source = spark.range(400).select(
        (F.col("id") % 9).cast("string").alias("Customer_ID"), day.alias("snapshot_date"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 13 % 101).cast("int")).alias("v"))
    labels = spark.createDataFrame(
        [(str(c), d) for c in range(12) for i, d in enumerate([
            date(2023, 3, 29), date(2023, 7, 29), date(2023, 7, 30), date(2023, 7, 31), date(2024, 1, 1)]) if (c + i) % 4], BATCH)
    pairs = pit.point_in_time_join(labels, source, 6, ["v"], "seen")
    keys = ["Customer_ID", "label_snapshot_date"]
    means = pairs.groupBy(*keys).agg(F.round(F.avg("v"), 2).alias("v_mean"))
    latest = pit.latest_per_key(pairs, keys, ["seen"])
    for got, want in ((pit.pit_mean_features(labels, source, 6, ["v"]), means),
                      (pit.as_of_latest(labels, source, 6, ["v"], "seen"), latest)):
        rows = sorted(map(repr, map(tuple, got.select(*want.columns).collect())))
        assert rows and rows == sorted(map(repr, map(tuple, want.collect())))
