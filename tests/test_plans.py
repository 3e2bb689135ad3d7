"""The plans: pruning, pushdown, no pair joins, no whole-table windows, no Python rows."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from checks.compare import rows_of
from checks.views import REGISTRY, VIEWS, Inputs
from featuremart.operators import metrics, pit, sampling
from featuremart.operators.ordered import prefix_sum
from featuremart.plans import gold
from featuremart.sources import tables

SMALL = "/root/testdata/sf0.001"
EAGER = {  # these write files or fit models while they are built
    "ingest_snapshot", "ingest_optional_date", "read_snapshot", "write_snapshot", "read_table_csv", "read_predictions",
    "flatten_json_summaries", "flatten_varied_summaries", "training_table_bucketed", "read_monitoring", "append_run", "incremental_landing", "backfill", "write_feature_matrix",
    "train_logreg", "train_gbt", "train_regularised_trees", "tune", "tune_sequential", "score_snapshot", "write_predictions", "model_lifecycle", "stratified_split",
    "stratified_folds", "monitor", "one_hot_entries", "multi_hot_entries"}


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture(scope="module")
def silver_folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    rows = spark.range(200).select(
        F.col("id").cast("string").alias("loan_id"), (F.col("id") % 20).cast("string").alias("Customer_ID"),
        (F.col("id") % 8).cast("int").alias("mob"), (F.col("id") % 50).cast("int").alias("dpd"), F.lit(1.5).alias("unused"),
        F.add_months(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("snapshot_date"))
    return tables.write_snapshot(rows, path)


def test_every_lazy_query_plans_cleanly(spark):
    for name in REGISTRY.queries:
        if name in EAGER:
            continue
        text = plan(REGISTRY.queries[name](spark, SMALL))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name
        assert not re.search("EvalPython|MapInPandas|FlatMapGroups|PythonUDF", text), name


def test_month_reads_one_partition(spark, silver_folder):
    text = plan(tables.read_snapshot(spark, silver_folder, date(2024, 2, 1)))
    assert "snapshot_date" in re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)


def test_label_store_pushes_the_age_filter_and_prunes_columns(spark, silver_folder):
    text = plan(gold.label_store(spark.read.parquet(silver_folder)))
    assert "EqualTo(mob,6)" in text and "unused" not in re.search(r"ReadSchema: struct<(.*)>", text).group(1)


def test_feature_months_beyond_the_cutoff_are_skipped(spark, silver_folder):
    labels = pit.label_batch(gold.label_store(spark.read.parquet(silver_folder)))
    features = spark.read.parquet(silver_folder)
    for df in (pit.as_of_latest(labels, features, 6, ["dpd"], "seen"), pit.point_in_time_join(labels, features, 6, ["dpd"], "seen")):
        assert any("ubquery" in filters for filters in re.findall(r"PartitionFilters: \[(.*?)\]", plan(df)))


def test_pretrain_has_no_join_and_one_customer_shuffle(spark):
    from checks.pit_queries import features

    text = plan(features(Inputs(spark, SMALL)))
    above_union = text.split("- Union")[0]
    assert len(re.findall(r"\n[ +\-]*Window \[", above_union)) == 1
    assert "Join" not in above_union and above_union.count("Exchange") == 1


def test_latest_row_is_reduced_before_the_shuffle(spark, silver_folder):
    text = plan(pit.latest_per_key(spark.read.parquet(silver_folder), ["Customer_ID"], ["snapshot_date"]))
    assert re.search(r"Exchange hashpartitioning(.|\n)*WindowGroupLimit.*Partial", text)


def window_keys(text):
    return re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)


def test_running_sums_are_split_in_ranges(spark):
    df = spark.range(1000).select(F.rand(1).alias("s"), F.lit(1).alias("n"))
    text = plan(prefix_sum(df, "s", ["n"]))
    # one Exchange to a single partition for the range totals, one for the sketch; rows go by range
    assert any("_key" in keys for keys in window_keys(text))
    local = [line for line in text.splitlines() if "_local_n" in line and "Window" in line]
    assert local and all("_key" in line for line in local)


def test_grouped_running_sums_are_not_shuffled_again_for_the_totals(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("s"), F.lit(1).alias("n"))
    for threshold in ("10MB", "-1"):  # also when the totals are too large to broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            text = plan(prefix_sum(df, "s", ["n"], ["g"]))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        local_side = text[: text.index("_local_n", text.index("Window ["))]
        assert "Exchange" not in local_side.split("Join")[1]


def test_shared_shuffle_is_read_once(spark):
    df = Inputs(spark, SMALL).view("predictions")
    auc = metrics.roc_auc(df)
    auc.collect()
    assert "ReusedExchange" in plan(auc)


def test_split_computes_its_input_once(spark):
    """The hashed rows are written; every later branch reads them, and settled rows stay in place."""
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("label"))
    text = plan(sampling.stratified_split(df, "label"))
    assert "Range (" not in text
    settled = text.split("\n   :- ")[1].split("\n   +- ")[0]
    outside_subquery = "\n".join(line for line in settled.splitlines() if not re.search(r"^\s*:[ :]*:", line))
    assert "Exchange" not in outside_subquery.split("Subquery subquery")[0]


def test_monitoring_reads_its_input_through_two_counts(spark):
    view = Inputs(spark, SMALL).view("predictions")
    truth = view.select("Customer_ID", "snapshot_date", "label")
    text = plan(metrics.monitor(view.drop("label"), truth))
    assert "orders.parquet" not in text and "scores-" in text


def test_nobody_shares_features(spark):
    """Rows without a customer match no label, as in the plain join."""
    day, label_day = date(2024, 1, 1), date(2024, 7, 1)
    source = spark.createDataFrame([(None, day, 1.0), ("c", day, 2.0)], "Customer_ID string, snapshot_date date, v double")
    labels = spark.createDataFrame([(None, label_day), ("c", label_day)], "Customer_ID string, label_snapshot_date date")
    for got in (pit.as_of_latest(labels, source, 6, ["v"], "v_date"), pit.pit_mean_features(labels, source, 6, ["v"]),
                pit.point_in_time_join(labels, source, 6, ["v"], "v_date")):
        assert [r["Customer_ID"] for r in got.collect()] == ["c"]


def test_entry_contract(spark):
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 90
    assert entry_points.entry(spark).count() == 7
    assert set(REGISTRY.queries) == set(REGISTRY.oracles)  # every query of the reference's own operators has its SQL


@pytest.mark.parametrize("view", sorted(VIEWS))
def test_views_are_the_same_in_both_engines(spark, view):
    import duckdb

    from checks.views import TABLES, duck_view

    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    result = duck.execute(f"SELECT * FROM {duck_view(view)}")
    df = Inputs(spark, SMALL).view(view)
    names = [d[0] for d in result.description]
    assert names == df.columns
    assert rows_of(names, result.fetchall()) == rows_of(df.columns, df.collect())
