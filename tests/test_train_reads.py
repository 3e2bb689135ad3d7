"""Training reads the stored table in place; only the splits of it are written."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from featuremart.functions.dates import derive_windows
from featuremart.plans import datamart


def test_training_rows_are_not_copied_before_the_split(spark, monkeypatch):
    rows = spark.range(60).select(
        F.col("id").cast("string").alias("loan_id"), F.col("id").cast("string").alias("Customer_ID"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.add_months(F.lit(date(2000, 1, 1)), (F.col("id") % 12).cast("int")).alias("label_snapshot_date"))
    written = []

    class Stop(Exception):
        pass

    def first_write(df, name="intermediate"):
        written.append((name, {(r["split"], r["n"]) for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}))
        raise Stop

    monkeypatch.setattr(datamart, "materialise", first_write)
    monkeypatch.setattr(datamart.Datamart, "read", lambda *_: rows)
    with pytest.raises(Stop):
        datamart.Datamart(spark, "unused").train(
            derive_windows(date(2001, 1, 1), 9, 2), lambda r: None, lambda n: None, date(2001, 1, 1), "m", "logreg")
    # months 2 to 10 train and test, 11 and 12 out of time
    assert written == [("splits", {("train", 36), ("test", 9), ("oot", 10)})]
