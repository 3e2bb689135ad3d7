import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from featuremart import session
from featuremart.operators.registry import union_snapshots
from featuremart.plans.datamart import Datamart
from featuremart.plans.silver import silver_clickstream
from featuremart.sources import tables
from featuremart.streaming import incremental

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_raw_text_and_optional_date(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text("Customer_ID,Age,snapshot_date\nc,28_,2024-01-01\nd,3,2024-02-01\ne,4,bad\n")
    raw = tables.read_raw(spark, path)
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert [r["Customer_ID"] for r in tables.ingest_snapshot(raw, JAN).collect()] == ["c"]
    assert tables.ingest_snapshot(raw.drop("snapshot_date"), JAN, optional_date=True).count() == 3
    with pytest.raises(ValueError, match="snapshot_date"):
        tables.ingest_snapshot(raw.drop("snapshot_date"), JAN)
    frames = tables.ingest_all(spark, {"attributes": path, "loan_daily": path}, FEB)
    assert {k: v.count() for k, v in frames.items()} == {"attributes": 1, "loan_daily": 1}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rerun_of_one_month_leaves_the_others(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, JAN), (2, FEB), (3, FEB)], "v int, snapshot_date date")
    tables.write_snapshot(rows, path, fmt)
    again = spark.createDataFrame([(9, FEB)], "v int, snapshot_date date")
    for _ in range(2):
        tables.write_snapshot(again, path, fmt)
    got = tables.read_table(spark, path, fmt)
    assert sorted((int(r["v"]), r["snapshot_date"]) for r in got.collect()) == [(1, JAN), (9, FEB)]
    assert tables.read_snapshot(spark, path, JAN, fmt).count() == 1


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing_here"):
        tables.read_table(spark, str(tmp_path / "nothing_here"))
    assert tables.read_runs(spark, str(tmp_path / "no_runs")).count() == 0


def test_calendar(spark):
    def days(a, b):
        return [r[0] for r in tables.snapshot_calendar(spark, a, b).collect()]

    assert len(days(date(2023, 1, 1), date(2024, 12, 1))) == 24
    assert days(date(2024, 1, 15), date(2024, 3, 1)) == [FEB, date(2024, 3, 1)]
    assert days(date(2024, 1, 15), date(2024, 1, 20)) == []


def test_predictions_by_folder(spark, tmp_path):
    for model in ("m 1", "m2"):
        df = spark.createDataFrame([("c", "2024-01-01", 0.5)], "Customer_ID string, snapshot_date string, default_proba double")
        (df.withColumn("model_version", F.lit("named")) if model == "m2" else df).coalesce(1).write.parquet(str(tmp_path / model))
    got = {r["model_version"]: r["snapshot_date"] for r in tables.read_predictions(spark, str(tmp_path)).collect()}
    assert got == {"m 1": JAN, "named": JAN}


def test_json_summaries(spark, tmp_path):
    for model, when in (("a", "2024-01-01 10:00:00"), ("b", "not a time")):
        (tmp_path / model).mkdir()
        (tmp_path / model / "summary_1.json").write_text(
            json.dumps({"evaluation_time": when, "f1": {"macro": 0.5, "deep": {"x": 1}}, "model_version": "ignored"}, indent=1))
    df = tables.read_json_summaries(spark, str(tmp_path), "summary_*.json")
    assert set(df.columns) == {"evaluation_time", "f1.macro", "f1.deep.x", "model_version"}
    got = {r["model_version"]: r for r in df.collect()}
    assert got["a"]["evaluation_time"].hour == 10 and got["b"]["evaluation_time"] is None and got["a"]["f1.deep.x"] == 1


def test_monitoring_files(spark, tmp_path):
    spark.createDataFrame([("2024-02-15", 0.7)], "month string, auc double").coalesce(1).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("2024-01-02", 0.6)], "month string, auc_roc double").coalesce(1).write.parquet(str(tmp_path / "y"))
    assert [r["month"] for r in tables.read_monitoring(spark, str(tmp_path)).collect()] == [JAN, FEB]
    (tmp_path / "x" / "broken.parquet").write_bytes(b"PAR1 broken")
    with pytest.raises(Exception, match="footer|FOOTER|Parquet"):
        tables.read_monitoring(spark, str(tmp_path)).collect()
    got, skipped = tables.read_monitoring_leniently(spark, str(tmp_path))
    assert [r["month"] for r in got.collect()] == [JAN, FEB]
    assert [r["file"].rsplit("/", 1)[1] for r in skipped.collect()] == ["broken.parquet"]
    only_old = tables.normalise_monitoring(spark.createDataFrame([("2024-02-15", 0.7)], "month string, auc double"))
    assert only_old.first()["auc_roc"] == 0.7


def test_runs_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    for version in ("v1", "v2"):
        tables.append_run(spark, [{"model_version": version, "train_start": JAN, "auc_oot": 0.7, "promoted_flag": False}], path)
    got = tables.read_runs(spark, path)
    assert {r["model_version"] for r in got.collect()} == {"v1", "v2"} and "promoted_at" in got.columns


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(2.5, 2)], "v double, k int")
    assert sorted(map(tuple, union_snapshots([a, b]).collect())) == [(1, "x", None), (2, None, 2.5)]


def test_incremental_landing_takes_each_file_once(spark, tmp_path):
    raw, out, done = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "done")
    raw.mkdir()
    header = "Customer_ID," + ",".join(f"fe_{i}" for i in range(1, 21)) + ",snapshot_date\n"
    schema = "Customer_ID string, " + ", ".join(f"fe_{i} string" for i in range(1, 21)) + ", snapshot_date date"
    for n, day in enumerate(("2024-01-01", "2024-02-01")):
        (raw / f"{n}.csv").write_text(header + "c," + ",".join(["1"] * 20) + f",{day}\n")
        for _ in range(2):
            incremental.land_available(incremental.new_raw_rows(spark, str(raw), schema), out, done, silver_clickstream)
        assert tables.read_table(spark, out).count() == n + 1


def raw_files(folder, loan_days, feature_days):
    folder.mkdir(exist_ok=True)
    (folder / "loan.csv").write_text(
        "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date\n"
        + "".join(f"l{d},c,2023-01-01,10,6,100,10,0,25,1,{d}\n" for d in loan_days))
    (folder / "click.csv").write_text("Customer_ID," + ",".join(f"fe_{i}" for i in range(1, 21)) + ",snapshot_date\n"
                                      + "".join("c," + ",".join(["4"] * 20) + f",{d}\n" for d in feature_days))
    (folder / "attr.csv").write_text("Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n"
                                     + "".join(f"c,ann,30_,123-45-6789,Media_Manager,{d}\n" for d in feature_days))
    names = ["Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
             "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Outstanding_Debt",
             "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance"]
    (folder / "fin.csv").write_text(
        "Customer_ID," + ",".join(names) + ",Type_of_Loan,Credit_Mix,Credit_History_Age,Payment_of_Min_Amount,Payment_Behaviour,snapshot_date\n"
        + "".join("c," + ",".join("5_" if n == "Num_of_Loan" else "12" for n in names)
                  + f',"A, and B",Good,1 Years and 2 Months,NM,High_spent_Small_value_payments,{d}\n' for d in feature_days))
    return {"loan_daily": str(folder / "loan.csv"), "clickstream": str(folder / "click.csv"),
            "attributes": str(folder / "attr.csv"), "financials": str(folder / "fin.csv")}


def test_backfill_is_idempotent_and_months_are_independent(spark, tmp_path):
    raw = raw_files(tmp_path / "raw", ["2024-01-01", "2024-02-01"], ["2023-07-01", "2023-08-01"])
    mart = Datamart(spark, str(tmp_path / "mart"))
    mart.backfill(raw)

    def state():
        return sorted(map(str, mart.read("gold", "training").collect()))

    first = state()
    assert len(first) == 2 and "A|B" in first[0]
    ages = {r["label_snapshot_date"].month: r["financials_snapshot_date"].month for r in mart.read("gold", "training").collect()}
    assert ages == {1: 7, 2: 8}
    assert dict(mart.read("silver", "loan_daily").dtypes)["due_amt"] == "float"
    mart.backfill(raw)
    assert state() == first
    mart.run_month(raw, FEB)
    assert state() == first


def test_first_month_can_be_run_alone(spark, tmp_path):
    raw = raw_files(tmp_path / "raw", ["2024-01-01"], ["2023-07-01"])
    mart = Datamart(spark, str(tmp_path / "mart"))
    mart.backfill(raw, date(2023, 7, 1), JAN)
    assert mart.read("gold", "training").count() == 1
    assert mart.read("gold", "label_store", JAN, JAN).first()["label"] == 1


def test_a_month_that_became_empty_goes(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, JAN), (2, FEB), (3, date(2024, 3, 1))], "k int, snapshot_date date")
    tables.write_snapshot(rows, path)
    tables.write_snapshot(rows.filter("k = 1"), path, covered=(JAN, FEB))
    assert sorted(r["k"] for r in tables.read_table(spark, path).collect()) == [1, 3]
    tables.write_snapshot(rows.filter("k = 2"), path)  # nothing stated: other months stay
    assert sorted(r["k"] for r in tables.read_table(spark, path).collect()) == [1, 2, 3]
    tables.write_snapshot(rows.filter("k = 2"), path, covered=(None, None))
    assert [r["k"] for r in tables.read_table(spark, path).collect()] == [2]


def test_own_predictions_are_read_back(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = spark.createDataFrame([("a", JAN, 0.5, "m1"), ("b", FEB, 0.25, "007")],
                                 "Customer_ID string, snapshot_date date, default_proba double, model_version string")
    tables.write_predictions(rows, path)
    got = tables.read_predictions(spark, path)
    assert {tuple(r) for r in got.select(*rows.columns).collect()} == {tuple(r) for r in rows.collect()}


def test_other_read_errors_are_not_taken_for_absence(spark, tmp_path):
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "x.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception) as error:
        tables.read_runs(spark, str(tmp_path / "runs")).collect()
    assert not isinstance(error.value, FileNotFoundError)


def test_scratch_folder_is_removed(spark):
    with session.scratch(spark) as folder:
        df = session.materialise(spark.range(5))
        assert df.count() == 5 and session.shared_folder(spark, "x").startswith(folder)
        system, place = session.file_system(spark, folder)
        assert system.exists(place)
    assert not system.exists(place) and not session.shared_folder(spark, "x").startswith(folder)


def test_undated_source_needs_a_month(spark):
    raw = spark.createDataFrame([("a",)], "Customer_ID string")
    assert tables.ingest_snapshot(raw, JAN, optional_date=True).first()["snapshot_date"] == JAN
    assert "snapshot_date" not in tables.ingest_snapshot(raw, None, optional_date=True).columns
