"""Silver and gold months are written where their rows are read."""

import datetime

from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.plans.datamart import Datamart
from featuremart.sources import tables


def stages_of(spark, job) -> list[int]:
    """Stages of each Spark job that a call starts."""
    context = spark.sparkContext
    context.setJobGroup("aligned", "aligned")
    try:
        job()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    return [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("aligned")]


def test_rows_of_a_dated_table_are_written_without_a_shuffle(spark, tmp_path):
    days = [datetime.date(2024, m, 1) for m in range(1, 7)]
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("Customer_ID"),
        F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % 6 + 1).cast("int")).alias("snapshot_date"),
        *[F.lit("7").alias(c) for c in fixed.CLICK_FEATURES])
    mart = Datamart(spark, str(tmp_path))
    source = tables.write_snapshot(rows, mart.path("bronze", "clickstream"))
    target = mart.path("silver", "clickstream")

    def copy():
        tables.write_snapshot(mart.read("bronze", "clickstream"), target, covered=(None, None), rebalance=False)

    assert set(stages_of(spark, copy)) == {1}
    again = tables.read_table(spark, target)
    assert sorted(map(tuple, again.select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    files = [sum(len(f) for f in tables.partition_files(spark, p, "snapshot_date").values()) for p in (source, target)]
    assert files[1] <= files[0]


def test_a_datamart_asks_for_no_shuffle_of_silver_and_gold(spark, tmp_path, monkeypatch):
    from featuremart.plans import datamart

    asked = {}
    monkeypatch.setattr(datamart.tables, "write_snapshot",
                        lambda df, path, **options: asked.update({path.split("/")[-2:][0]: options.get("rebalance", True)}))
    monkeypatch.setattr(Datamart, "read", lambda self, layer, name, start=None, end=None: spark.range(0))
    for steps in ("SILVER_STEPS", "GOLD_STEPS"):
        monkeypatch.setattr(datamart, steps, {
            k: (lambda df: df) if callable(v) else (v[0], lambda df, *_: df) for k, v in getattr(datamart, steps).items()})
    mart = Datamart(spark, str(tmp_path))
    mart.build_silver()
    mart.build_gold()
    assert asked == {"silver": False, "gold": False}


def test_bronze_months_are_written_without_a_shuffle_or_sort(spark, tmp_path):
    """Before, every text row was shuffled by its month."""
    days = [datetime.date(2024, m, 1) for m in range(1, 7)]
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("Customer_ID"),
        F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % 6 + 1).cast("int")).alias("snapshot_date"))
    rows.repartition(3).write.option("header", True).csv(str(tmp_path / "raw"))
    mart = Datamart(spark, str(tmp_path))
    assert set(stages_of(spark, lambda: mart.build_bronze({"clickstream": str(tmp_path / "raw")}))) == {1}
    assert sorted(map(tuple, mart.read("bronze", "clickstream").select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_more_partitions_than_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "OPEN_FILES", 3)
    rows = spark.range(500).select("id", F.date_add(F.lit(datetime.date(2024, 1, 1)), (F.col("id") % 50).cast("int")).alias("snapshot_date"))
    path = tables.write_snapshot(rows, str(tmp_path / "t"), rebalance=False)
    assert sorted(map(tuple, tables.read_table(spark, path).select("id", "snapshot_date").collect())) == sorted(map(tuple, rows.collect()))
