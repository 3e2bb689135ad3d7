"""Point-in-time, feature store and split queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.datamart_queries import GOLD_ATTRIBUTES, GOLD_FINANCIALS_FLOAT, LABELS, SILVER_LOAN
from checks.views import REGISTRY, Inputs
from featuremart import fixed_values as fixed
from featuremart.operators import pit, sampling
from featuremart.plans import gold, pretrain, silver

CUTOFF = "CAST(label_snapshot_date - INTERVAL 5 MONTH AS DATE)"
BATCH = f"(SELECT loan_id, Customer_ID, snapshot_date AS label_snapshot_date FROM ({LABELS}))"
KEYS = f"(SELECT DISTINCT Customer_ID, label_snapshot_date FROM {BATCH})"
MEANS = ", ".join(
    f"CAST(round(CAST(avg(fe_{i}) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS fe_{i}_mean" for i in range(1, 21)
)
CLICK_MEANS = f"""
SELECT Customer_ID, label_snapshot_date, {MEANS}
FROM {KEYS} JOIN $click USING (Customer_ID) WHERE snapshot_date < {CUTOFF}
GROUP BY Customer_ID, label_snapshot_date
"""
ATTRIBUTES = ["Age_bin", "Occupation"]
MONEY = [c for c in fixed.FINANCIAL_BASE_COLUMNS if c != "Changed_Credit_Limit"] + [
    *fixed.ENCODED_COLUMNS, *fixed.RATIO_COLUMNS, *fixed.FLAG_COLUMNS]


def pit_sql(source: str, columns: list[str], date_as: str, keys: str = KEYS) -> str:
    return f"""SELECT Customer_ID, label_snapshot_date, {', '.join(columns)}, snapshot_date AS {date_as}
FROM {keys} JOIN ({source}) USING (Customer_ID) WHERE snapshot_date < {CUTOFF}"""


def latest_sql(source: str, columns: list[str], date_as: str) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in columns)
    return f"""SELECT * FROM ({pit_sql(source, columns, date_as)})
QUALIFY row_number() OVER (PARTITION BY Customer_ID, label_snapshot_date
                           ORDER BY {date_as} DESC, {order}) = 1"""


PRETRAIN = f"""
SELECT {', '.join(fixed.PRETRAIN_COLUMNS)} FROM ({CLICK_MEANS})
JOIN ({latest_sql(GOLD_ATTRIBUTES, ATTRIBUTES, 'attributes_snapshot_date')})
     USING (Customer_ID, label_snapshot_date)
JOIN ({latest_sql(GOLD_FINANCIALS_FLOAT, MONEY, 'financials_snapshot_date')})
     USING (Customer_ID, label_snapshot_date)
"""


def labels(t: Inputs) -> DataFrame:
    """The label table, stored once as it is in the datamart; many steps read it."""
    return t.stored("labels", lambda: gold.label_store(silver.add_delinquency(t.view("loan"))))


def batch(t: Inputs) -> DataFrame:
    return pit.label_batch(labels(t))


def make_attributes(raw: DataFrame) -> DataFrame:
    return gold.gold_attributes(silver.silver_attributes(raw))


def make_financials(raw: DataFrame) -> DataFrame:
    return gold.gold_financials(silver.silver_financials(raw))


def attributes(t: Inputs) -> DataFrame:
    return make_attributes(t.view("attributes"))


def financials(t: Inputs) -> DataFrame:
    return make_financials(t.view("financials"))


def features(t: Inputs, **options) -> DataFrame:
    return pretrain.pretrain_features(
        labels(t), t.view("attributes"), t.view("financials"), t.view("click"),
        make_attributes=make_attributes, make_financials=make_financials, **options)


REGISTRY.add("point_in_time_join", pit_sql(GOLD_ATTRIBUTES, ATTRIBUTES, "attributes_snapshot_date", BATCH))(
    lambda t: pit.point_in_time_join(batch(t), attributes(t), 6, ATTRIBUTES, "attributes_snapshot_date"))

REGISTRY.add("as_of_latest", latest_sql(GOLD_FINANCIALS_FLOAT, MONEY, "financials_snapshot_date"))(
    lambda t: pit.as_of_latest(batch(t), t.view("financials"), 6, MONEY, "financials_snapshot_date", make_financials))

REGISTRY.add("pit_mean_features", CLICK_MEANS)(
    lambda t: pit.pit_mean_features(batch(t), t.view("click"), 6, fixed.CLICK_FEATURES))

REGISTRY.add("merge_features", f"""
SELECT * FROM ({CLICK_MEANS})
JOIN ({pit_sql(GOLD_ATTRIBUTES, ATTRIBUTES, 'attributes_snapshot_date')})
     USING (Customer_ID, label_snapshot_date)
""")(lambda t: pit.merge_features([
    pit.pit_mean_features(batch(t), t.view("click"), 6, fixed.CLICK_FEATURES),
    pit.point_in_time_join(batch(t).select("Customer_ID", "label_snapshot_date").distinct(),
                           attributes(t), 6, ATTRIBUTES, "attributes_snapshot_date")]))

REGISTRY.add("merge_features_by_customer", f"""
SELECT c.* EXCLUDE (label_snapshot_date), Age_bin, Occupation, attributes_snapshot_date
FROM ({CLICK_MEANS}) c
JOIN ({latest_sql(GOLD_ATTRIBUTES, ATTRIBUTES, 'attributes_snapshot_date')}) USING (Customer_ID)
""")(lambda t: pit.merge_features([
    pit.pit_mean_features(batch(t), t.view("click"), 6, fixed.CLICK_FEATURES).drop("label_snapshot_date"),
    pit.as_of_latest(batch(t), t.view("attributes"), 6, ATTRIBUTES, "attributes_snapshot_date", make_attributes)
    .drop("label_snapshot_date")], on=["Customer_ID"]))

REGISTRY.add("latest_per_key", """
SELECT * FROM $attributes QUALIFY row_number() OVER (PARTITION BY Customer_ID
    ORDER BY snapshot_date DESC NULLS LAST, Name NULLS LAST, Age NULLS LAST, SSN NULLS LAST,
             Occupation NULLS LAST) = 1
""")(lambda t: pit.latest_per_key(t.view("attributes"), ["Customer_ID"], ["snapshot_date"]))

REGISTRY.add("pretrain_features", PRETRAIN)(lambda t: features(t))

REGISTRY.add("pretrain_every_snapshot", f"""
SELECT Customer_ID, label_snapshot_date, count(*) AS rows, min(financials_snapshot_date) AS oldest,
       CAST(sum(high_utilization_flag) AS BIGINT) AS high
FROM ({CLICK_MEANS})
JOIN ({pit_sql(GOLD_ATTRIBUTES, ATTRIBUTES, 'attributes_snapshot_date', BATCH)}) USING (Customer_ID, label_snapshot_date)
JOIN ({pit_sql(GOLD_FINANCIALS_FLOAT, MONEY, 'financials_snapshot_date', BATCH)}) USING (Customer_ID, label_snapshot_date)
GROUP BY 1, 2
""")(lambda t: features(t, strategy="none").groupBy("Customer_ID", "label_snapshot_date").agg(
    F.count(F.lit(1)).alias("rows"), F.min("financials_snapshot_date").alias("oldest"),
    F.sum("high_utilization_flag").alias("high")))

REGISTRY.add("pretrain_features_no_nulls", f"""
SELECT * FROM ({PRETRAIN}) WHERE {' AND '.join(
    f'{c} IS NOT NULL' for c in fixed.PRETRAIN_COLUMNS if c not in fixed.PRETRAIN_METADATA)}
""")(lambda t: features(t, drop_nulls=True).select(*fixed.PRETRAIN_COLUMNS))

REGISTRY.add("training_table", f"""
SELECT p.*, loan_id, label, label_def FROM ({PRETRAIN}) p
JOIN ({LABELS}) l ON p.Customer_ID = l.Customer_ID AND p.label_snapshot_date = l.snapshot_date
""")(lambda t: pretrain.training_rows(features(t), labels(t)))

REGISTRY.add("label_left_features", f"""
SELECT * FROM ({LABELS}) LEFT JOIN $click USING (Customer_ID, snapshot_date)
""")(lambda t: pit.label_left_features(labels(t), t.view("click")))

SPLIT_ROWS = f"SELECT loan_id, Customer_ID, snapshot_date, mob, CAST(dpd >= 30 AS INT) AS label FROM ({SILVER_LOAN})"
SPLIT_HASH = ("md5(loan_id || '|' || COALESCE(Customer_ID, chr(0)) || '|' || CAST(snapshot_date AS VARCHAR) || '|' || "
              "CAST(mob AS VARCHAR) || '|' || COALESCE(CAST(label AS VARCHAR), chr(0)) || '|88')")


def split_rows(t: Inputs) -> DataFrame:
    return silver.add_delinquency(t.view("loan")).select(
        "loan_id", "Customer_ID", "snapshot_date", "mob", (F.col("dpd") >= 30).cast("int").alias("label"))


RANKED = f"""
SELECT *, row_number() OVER (PARTITION BY label ORDER BY {SPLIT_HASH}) - 1 AS place,
       count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS all_rows
FROM ({SPLIT_ROWS})
"""
REGISTRY.add("stratified_split", f"""
WITH ranked AS ({RANKED}),
sizes AS (SELECT label, n, all_rows - CAST(ceil(all_rows * (CAST(1 AS DOUBLE) - CAST(0.8 AS DOUBLE))) AS BIGINT) AS train,
                 CAST(n AS DOUBLE) * (all_rows - CAST(ceil(all_rows * (CAST(1 AS DOUBLE) - CAST(0.8 AS DOUBLE))) AS BIGINT)) / all_rows AS exact
          FROM (SELECT DISTINCT label, n, all_rows FROM ranked)),
cuts AS (SELECT label, floor(exact) + CASE WHEN
            row_number() OVER (ORDER BY exact - floor(exact) DESC, COALESCE(CAST(label AS VARCHAR), chr(0)))
            <= train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS cut FROM sizes)
SELECT loan_id, Customer_ID, snapshot_date, mob, ranked.label,
       CASE WHEN place < cut THEN 'train' ELSE 'test' END AS split
FROM ranked JOIN cuts ON ranked.label IS NOT DISTINCT FROM cuts.label
""")(lambda t: sampling.stratified_split(split_rows(t), "label"))

REGISTRY.add("stratified_folds", f"""
SELECT loan_id, Customer_ID, snapshot_date, mob, label, CAST(place * 5 // n AS INT) AS fold FROM ({RANKED})
""")(lambda t: sampling.stratified_folds(split_rows(t), "label"))
