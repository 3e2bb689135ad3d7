from datetime import date

import pytest
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.operators import profiling, pit, schema
from featuremart.plans import gold, pretrain, silver

LOAN = ("loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, loan_amt double,"
        " due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date")


def loan(due, overdue, snapshot, instalment=6, balance=1.0):
    return ("l", "c", date(2023, 1, 1), 10, instalment, 100.0, due, 0.0, overdue, balance, snapshot)


def test_delinquency(spark):
    rows = [loan(10.0, 25.0, date(2023, 3, 31)), loan(0.0, 5.0, date(2023, 3, 1)), loan(10.0, 0.0, date(2023, 3, 1)),
            loan(10.0, -5.0, date(2023, 3, 1)), loan(10.0, 10.0, date(2023, 3, 31)), loan(None, 5.0, date(2023, 3, 1), balance=None)]
    got = silver.add_delinquency(spark.createDataFrame(rows, LOAN)).select(
        "installments_missed", "first_missed_date", "dpd", "due_amt", "balance").collect()
    assert [tuple(r)[:3] for r in got] == [
        (3, date(2022, 12, 31), 90), (0, None, None), (0, None, 0), (0, None, 0), (1, date(2023, 2, 28), 31), (0, None, None)]
    assert got[5]["due_amt"] == 0 and got[5]["balance"] == 0
    labels = gold.label_store(silver.add_delinquency(spark.createDataFrame(rows, LOAN)))
    assert labels.columns == fixed.LABEL_COLUMNS
    assert [r["label"] for r in labels.collect()] == [1, 0, 0, 0, 1, 0]
    assert gold.label_store(silver.add_delinquency(spark.createDataFrame(rows, LOAN)), 90, 7).count() == 0


def test_delinquency_can_keep_nulls(spark):
    df = spark.createDataFrame([loan(10.0, 0.0, date(2023, 3, 1), balance=None)], LOAN)
    assert silver.add_delinquency(df, fill_nulls=False).first()["balance"] is None


def test_silver_from_text(spark):
    raw = spark.createDataFrame([loan(10.0, 25.0, date(2023, 3, 31))], LOAN)
    typed = silver.silver_loans(raw.select(*[F.col(c).cast("string") for c in raw.columns]))
    assert dict(typed.dtypes)["due_amt"] == "float" and typed.first()["dpd"] == 90
    with pytest.raises(ValueError, match="balance"):
        silver.silver_loans(raw.drop("balance"))


def test_silver_attributes_without_date(spark):
    raw = spark.createDataFrame([("c", " ann LEE ", "28_", "123-45-6789", "Media_Manager")],
                                "Customer_ID string, Name string, Age string, SSN string, Occupation string")
    row = silver.silver_attributes(raw).first().asDict()
    assert row == {"Customer_ID": "c", "Name": "Ann Lee", "Age": 28, "SSN": "123-45-6789", "Occupation": "Media Manager",
                   "Name_Masked": "A******", "SSN_Masked": "XXX-XX-6789"}


def test_codes_are_not_added_twice(spark):
    df = spark.createDataFrame([("Good", 9), ("odd", 9)], "Credit_Mix string, Credit_Mix_Enc int")
    assert gold.add_ordinal_codes(df).columns == df.columns
    codes = gold.add_ordinal_codes(df.drop("Credit_Mix_Enc")).collect()
    assert [r["Credit_Mix_Enc"] for r in codes] == [2, None]


def test_schema_operators(spark):
    df = spark.createDataFrame([("3.7", "x", None), (None, "y", 1.5)], "a string, b string, c double")
    assert [r["a"] for r in schema.enforce_schema(df, {"a": "int"}).collect()] == [3, None]
    assert schema.project_present(df, ["c", "zz", "a"], {"a": "first"}).columns == ["c", "first"]
    assert schema.drop_null_features(df, ["a"]).count() == 1
    assert [r["c"] for r in schema.fill_numeric_nulls(df).collect()] == [0.0, 1.5]
    assert schema.feature_columns(df, ["b"]) == (["c"], ["a"])
    with pytest.raises(ValueError, match="zz"):
        schema.expect_columns(df, ["a", "zz"])


def test_coerce_numeric_needs_every_value(spark):
    df = spark.createDataFrame([(" 1 ", "1", "1", ""), ("2.5", "x", "2", None)], "a string, b string, c string, d string")
    got = schema.coerce_numeric(df, exclude=["c"])
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "string", "d": "double"}
    assert [r["a"] for r in got.collect()] == [1.0, 2.5]


# ---------------------------------------------------------------- point in time
LABEL = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
JULY = date(2023, 7, 1)


def labels(spark, *rows):
    return spark.createDataFrame(rows or [("1", "c", 1, "d", JULY)], LABEL)


def source(spark, *rows):
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, v int")


def test_cutoff_is_exclusive(spark):
    src = source(spark, ("c", date(2023, 1, 31), 1), ("c", date(2023, 2, 1), 2), ("c", None, 3), ("other", date(2022, 1, 1), 4))
    batch = pit.label_batch(labels(spark))
    joined = pit.point_in_time_join(batch, src, 6, ["v"], "seen").collect()
    assert [(r["v"], r["seen"], r["label_snapshot_date"]) for r in joined] == [(1, date(2023, 1, 31), JULY)]
    assert [r["v"] for r in pit.as_of_latest(batch, src, 6, ["v"], "seen").collect()] == [1]
    assert [r["v_mean"] for r in pit.pit_mean_features(batch, src, 6, ["v"]).collect()] == [1.0]


def test_two_loans_on_one_date_do_not_double_anything(spark):
    batch = pit.label_batch(labels(spark, ("1", "c", 1, "d", JULY), ("2", "c", 0, "d", JULY)))
    src = source(spark, ("c", date(2023, 1, 1), 1), ("c", date(2023, 1, 1), 4), ("c", date(2022, 1, 1), None))
    assert pit.point_in_time_join(batch, src, 6, ["v"], "seen").count() == 6
    assert [tuple(r) for r in pit.as_of_latest(batch, src, 6, ["v"], "seen").collect()] == [("c", JULY, 1, date(2023, 1, 1))]
    assert [tuple(r) for r in pit.pit_mean_features(batch, src, 6, ["v"]).collect()] == [("c", JULY, 2.5)]


def test_several_label_dates_each_see_their_own_past(spark):
    rows = [(str(m), "c", 1, "d", date(2023, m, 1)) for m in (7, 8, 9)]
    src = source(spark, ("c", date(2023, 1, 1), 1), ("c", date(2023, 2, 1), 2), ("c", date(2023, 3, 1), 6))
    batch = pit.label_batch(labels(spark, *rows))
    latest = {r["label_snapshot_date"].month: r["v"] for r in pit.as_of_latest(batch, src, 6, ["v"], "seen").collect()}
    means = {r["label_snapshot_date"].month: r["v_mean"] for r in pit.pit_mean_features(batch, src, 6, ["v"]).collect()}
    assert latest == {7: 1, 8: 2, 9: 6}
    assert means == {7: 1.0, 8: 1.5, 9: 3.0}


def test_no_usable_history_gives_no_row(spark):
    batch = pit.label_batch(labels(spark))
    src = source(spark, ("c", date(2023, 6, 1), 1))
    assert pit.as_of_latest(batch, src, 6, ["v"], "seen").count() == 0
    assert pit.pit_mean_features(batch, src, 6, ["v"]).count() == 0


def test_as_of_equals_join_then_latest_with_a_hot_customer(spark):
    """One customer holds most rows; the pair-free way agrees with the plain definition."""
    src = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("Customer_ID"),
        F.add_months(F.lit(date(2020, 1, 1)), (F.col("id") % 31).cast("int")).alias("snapshot_date"),
        (F.col("id") * 7 % 1000).cast("int").alias("v"))
    lab = spark.range(200).select(
        F.col("id").cast("string").alias("loan_id"),
        F.when(F.col("id") % 4 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("Customer_ID"),
        F.lit(1).alias("label"), F.lit("d").alias("label_def"),
        F.add_months(F.lit(date(2020, 4, 1)), (F.col("id") % 29).cast("int")).alias("snapshot_date"))
    batch = pit.label_batch(lab)
    keys = ["Customer_ID", "label_snapshot_date"]
    pairs = pit.point_in_time_join(batch, src, 6, ["v"], "seen")
    plain = pit.latest_per_key(pairs, keys, ["seen"])
    fast = pit.as_of_latest(batch, src, 6, ["v"], "seen")
    assert sorted(map(tuple, fast.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    means = pairs.groupBy(*keys).agg(F.round(F.avg("v"), 2).alias("v_mean"))
    got = pit.pit_mean_features(batch, src, 6, ["v"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, means.collect()))
    cutoff = F.add_months("label_snapshot_date", -5)
    assert pairs.filter(F.col("seen") >= cutoff).count() == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", None, date(2023, 1, 1), 9), ("a", date(2022, 1, 1), date(2023, 1, 1), 2), ("a", date(2022, 1, 1), date(2023, 1, 1), 1)],
        "k string, d1 date, d2 date, v int")
    assert [r["v"] for r in pit.latest_per_key(df, ["k"], ["d1", "d2"]).collect()] == [1]
    assert pit.latest_per_key(df, ["k"], ["d1"], "none").count() == 3
    with pytest.raises(ValueError):
        pit.latest_per_key(df, ["k"], ["d1"], "first")


def click_rows(spark, *days):
    return spark.createDataFrame([("c", d, *([i] * 20)) for i, d in enumerate(days)],
                                 "Customer_ID string, snapshot_date date, " + ", ".join(f"{c} int" for c in fixed.CLICK_FEATURES))


def financial_rows(spark, *days):
    types = {c: "double" for c in fixed.FINANCIAL_BASE_COLUMNS}
    types.update({c: "string" for c in fixed.ORDINAL_CODES}, Type_of_Loan="string")
    values = ["Good" if types[c] == "string" else 1.0 for c in fixed.FINANCIAL_BASE_COLUMNS]
    return spark.createDataFrame([("c", d, *values) for d in days],
                                 "Customer_ID string, snapshot_date date, " + ", ".join(f"{c} {t}" for c, t in types.items()))


def test_pretrain_strategies(spark):
    days = [date(2022, 11, 1), date(2022, 12, 1), date(2023, 2, 1)]
    attrs = spark.createDataFrame([("c", 30, "x", d, "25_34") for d in days],
                                  "Customer_ID string, Age int, Occupation string, snapshot_date date, Age_bin string")
    args = (labels(spark), attrs, financial_rows(spark, *days), click_rows(spark, *days))
    latest = pretrain.pretrain_features(*args)
    row = latest.first()
    assert latest.count() == 1 and row["attributes_snapshot_date"] == row["financials_snapshot_date"] == date(2022, 12, 1)
    assert row["fe_1_mean"] == 0.5 and row["Credit_Mix_Enc"] == 2
    assert [c for c in fixed.PRETRAIN_COLUMNS if c in latest.columns] == latest.columns
    assert pretrain.pretrain_features(*args, strategy="none").count() == 4
    assert pretrain.pretrain_features(*args, drop_nulls=True).count() == 0  # codes of unknown categories are NULL
    with pytest.raises(ValueError):
        pretrain.pretrain_features(*args, strategy="oldest")
    training = pretrain.training_rows(latest, labels(spark, ("1", "c", 1, "d", JULY), ("2", "c", 0, "d", JULY)))
    assert training.count() == 2 and {"loan_id", "label", "label_def"} <= set(training.columns)
    assert [r["violations"] for r in profiling.leakage_audit(latest, 6).collect()] == [0, 0]


def test_left_join_keeps_all_labels(spark):
    feats = spark.createDataFrame([("c", JULY, 5)], "Customer_ID string, snapshot_date date, f int")
    got = pit.label_left_features(labels(spark, ("1", "c", 1, "d", JULY), ("2", "z", 0, "d", JULY)), feats)
    assert {(r["loan_id"], r["f"]) for r in got.collect()} == {("1", 5), ("2", None)}


def test_merge_on_customer_keeps_the_fan_out(spark):
    a = spark.createDataFrame([("c", 1), ("c", 2)], "Customer_ID string, a int")
    b = spark.createDataFrame([("c", 3), ("c", 4)], "Customer_ID string, b int")
    assert pit.merge_features([a, b], on=["Customer_ID"]).count() == 4
