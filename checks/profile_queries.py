"""Profiling, audit and monitoring-summary queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.datamart_queries import SILVER_LOAN
from checks.pit_queries import PRETRAIN, features
from checks.views import REGISTRY
from featuremart.operators import profiling
from featuremart.operators.registry import union_snapshots
from featuremart.plans import silver

MONTH = "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE)"


def dec(expression: str, digits: int = 6) -> str:
    """Rounding half away from zero on the decimal form, as Spark rounds doubles."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def rounded(df, digits: int = 6, *skip: str):
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


REGISTRY.add("row_count", "SELECT count(*) AS rows FROM lineitem")(
    lambda t: profiling.row_count(t.table("lineitem")))

FINANCIAL_COLUMNS = [
    "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio",
    "Credit_History_Age", "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly",
    "Monthly_Balance", "Payment_Behaviour", "snapshot_date"]
REGISTRY.add("null_profile", " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", count(*) - count({c}) AS null_count, '
    f'{dec(f"(count(*) - count({c})) / count(*)", 4)} AS null_rate FROM $financials'
    for c in FINANCIAL_COLUMNS))(
    lambda t: profiling.null_profile(t.view("financials")))

REGISTRY.add("duplicate_keys", """
SELECT loan_id, snapshot_date, count(*) AS rows FROM $loan GROUP BY ALL HAVING count(*) > 1
""")(lambda t: profiling.duplicate_keys(t.view("loan"), ["loan_id", "snapshot_date"]))

REGISTRY.add("rows_per_customer", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1")(
    lambda t: profiling.duplicate_keys(t.table("orders"), ["o_custkey"], at_least=1))

REGISTRY.add("duplicate_row_count", """
SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem
""")(lambda t: profiling.duplicate_row_count(t.table("lineitem"), ["l_orderkey", "l_linenumber"]))

REGISTRY.add("value_counts", """
SELECT l_partkey AS value, count(*) AS rows FROM lineitem GROUP BY 1
ORDER BY rows DESC, value NULLS LAST LIMIT 20
""")(lambda t: profiling.value_counts(t.table("lineitem"), "l_partkey"))

REGISTRY.add("distinct_values", "SELECT DISTINCT p_type FROM part")(
    lambda t: profiling.distinct_values(t.table("part"), "p_type"))

REGISTRY.add("non_numeric_values", """
SELECT DISTINCT Annual_Income FROM $financials
WHERE trim(Annual_Income) <> '' AND TRY_CAST(Annual_Income AS DOUBLE) IS NULL
""")(lambda t: profiling.non_numeric_values(t.view("financials"), "Annual_Income"))

DESCRIBED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
REGISTRY.add("describe_numbers", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", {dec(f'avg({c})', 4)} AS mean,
        {dec(f'stddev_samp({c})', 4)} AS std, CAST(min({c}) AS DOUBLE) AS min,
        {dec(f'quantile_cont({c}, 0.25)')} AS p25, {dec(f'quantile_cont({c}, 0.5)')} AS p50,
        {dec(f'quantile_cont({c}, 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
    for c in DESCRIBED))(
    lambda t: profiling.describe_numbers(t.table("lineitem"), DESCRIBED).select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
        *[F.round(q, 6).alias(q) for q in ("p25", "p50", "p75")], "max"))

TEXTS = ["l_returnflag", "l_linestatus"]
REGISTRY.add("describe_text", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
        first(v ORDER BY n DESC, v) AS top, max(n) AS freq
        FROM (SELECT {c} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in TEXTS))(lambda t: profiling.describe_text(t.table("lineitem"), TEXTS))

REGISTRY.add("rule_violations", """
SELECT 'Interest_Rate>100' AS rule, count(*) FILTER (Interest_Rate > 100) AS violations FROM $financials
UNION ALL SELECT 'Credit_Utilization_Ratio>1', count(*) FILTER (Credit_Utilization_Ratio > 1) FROM $financials
UNION ALL SELECT 'Credit_Utilization_Ratio<0', count(*) FILTER (Credit_Utilization_Ratio < 0) FROM $financials
""")(lambda t: profiling.rule_violations(t.view("financials"), profiling.sanity_rules()))

REGISTRY.add("leakage_audit", """
WITH f AS (SELECT snapshot_date AS label_snapshot_date, CAST(snapshot_date - INTERVAL 5 MONTH AS DATE) AS cutoff,
                  loan_start_date AS attributes_snapshot_date, loan_start_date AS financials_snapshot_date FROM $loan)
SELECT 'attributes' AS rule, count(*) FILTER (attributes_snapshot_date >= cutoff) AS violations FROM f
UNION ALL SELECT 'financials', count(*) FILTER (financials_snapshot_date >= cutoff) FROM f
UNION ALL SELECT 'misaligned', count(*) FILTER (label_snapshot_date <> DATE '1998-06-01') FROM f
""")(lambda t: profiling.leakage_audit(
    t.view("loan").select(
        F.col("snapshot_date").alias("label_snapshot_date"),
        F.col("loan_start_date").alias("attributes_snapshot_date"),
        F.col("loan_start_date").alias("financials_snapshot_date")),
    6, datetime.date(1998, 6, 1)))

REGISTRY.add("leakage_audit_pretrain", f"""
SELECT r.rule, count(*) FILTER (d >= CAST(label_snapshot_date - INTERVAL 5 MONTH AS DATE)) AS violations
FROM (SELECT label_snapshot_date, unnest([attributes_snapshot_date, financials_snapshot_date]) AS d,
             unnest(['attributes', 'financials']) AS rule FROM ({PRETRAIN})) r GROUP BY 1
""")(lambda t: profiling.leakage_audit(features(t), 6))

REGISTRY.add("bad_rate_curve", f"""
SELECT mob, {dec('avg(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0.0 END)')} AS bad_rate, count(*) AS loans
FROM ({SILVER_LOAN}) WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob
""")(lambda t: rounded(profiling.bad_rate_curve(
    silver.add_delinquency(t.view("loan")), 30, datetime.date(2000, 1, 1))))

REGISTRY.add("loans_at_age", f"""
SELECT loan_id, Customer_ID, snapshot_date, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
FROM ({SILVER_LOAN}) WHERE loan_start_date < DATE '2000-01-01' AND installment_num = 7
""")(lambda t: profiling.loans_at_age(
    silver.add_delinquency(t.view("loan")), 7, datetime.date(2000, 1, 1)).select(
    "loan_id", "Customer_ID", "snapshot_date", "dpd_flag"))

HISTOGRAMS = DESCRIBED
REGISTRY.add("histogram", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(b AS INT) AS bin, {dec('low + (high - low) / 50 * b', 4)} AS bin_start,
       {dec('low + (high - low) / 50 * (b + 1)', 4)} AS bin_end, COALESCE(n, 0) AS rows
FROM (SELECT min({c}) AS low, max({c}) AS high FROM lineitem), range(50) r(b)
LEFT JOIN (SELECT least(floor(({c} - lo) / (hi - lo) * 50), 49) AS k, count(*) AS n
           FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1) ON k = b
""" for c in HISTOGRAMS))(lambda t: rounded(profiling.histogram(t.table("lineitem"), HISTOGRAMS), 4))

REGISTRY.add("mean_all_numeric", f"""
SELECT Customer_ID, {', '.join(
    f'{dec(f"avg(fe_{i})", 2)} AS fe_{i}' for i in range(1, 21))} FROM $click GROUP BY 1
""")(lambda t: profiling.mean_all_numeric(t.view("click"), ["Customer_ID"]))

REGISTRY.add("score_by_snapshot", f"""
SELECT snapshot_date, count(default_proba) AS scored, {dec('avg(default_proba)')} AS score_mean,
       {', '.join(f"{dec(f'quantile_cont(default_proba, {p})')} AS {n}"
                  for n, p in (('p25', 0.25), ('p50', 0.5), ('p75', 0.75)))}
FROM $predictions GROUP BY 1
""")(lambda t: rounded(profiling.score_by_snapshot(t.view("predictions"))))

# any rows will do: as many as asked for, and all from the table
REGISTRY.add("sample_rows", """
SELECT CAST(least(5, count(*)) AS BIGINT) AS sampled, CAST(least(5, count(*)) AS BIGINT) AS from_table FROM orders
""")(lambda t: sampled(t.table("orders"), 5))


def sampled(df, n: int):
    rows = profiling.sample_rows(df, n).select(F.struct(*df.columns).alias("row"))
    known = df.select(F.struct(*df.columns).alias("row"), F.lit(1).alias("known"))
    return rows.join(known, "row", "left").agg(F.count(F.lit(1)).alias("sampled"), F.count("known").alias("from_table"))


REGISTRY.add("tail_by", """
SELECT o_orderkey, CASE WHEN o_orderkey % 1000 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders
ORDER BY day DESC NULLS FIRST, o_orderkey DESC LIMIT 40
""")(lambda t: profiling.tail_by(
    t.table("orders").select("o_orderkey", F.expr(
        "CASE WHEN o_orderkey % 1000 <> 0 THEN CAST(o_orderdate AS DATE) END").alias("day")), ["day", "o_orderkey"], 40))

REGISTRY.add("rolling_mean", f"""
SELECT {MONTH} AS month, count(*) AS sample_size, {dec('''avg(count(*)) OVER (ORDER BY ''' + MONTH + '''
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''')} AS sample_size_rolling FROM orders GROUP BY 1
""")(lambda t: rounded(profiling.rolling_mean(
    t.table("orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("sample_size")), "month", ["sample_size"])))

REGISTRY.add("union_snapshots", """
SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders
""")(lambda t: union_snapshots([
    t.table("orders").select("o_orderkey", "o_orderstatus"),
    t.table("orders").select("o_orderpriority", "o_orderkey")]))
