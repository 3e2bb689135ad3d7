"""Silver and gold queries: typing, cleaning, delinquency, labels, features."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.views import REGISTRY
from featuremart import fixed_values as fixed
from featuremart.functions import dates, numeric, text
from featuremart.operators import schema
from featuremart.plans import gold, silver

# ---------------------------------------------------------------- SQL building blocks
MISSED = "COALESCE(CAST(ceil(overdue_amt / NULLIF(due_amt, 0)) AS INT), 0)"
SILVER_LOAN = f"""
SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
               ELSE 0 END AS dpd
FROM (SELECT *, CASE WHEN installments_missed > 0
                     THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END
                AS first_missed_date
      FROM (SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt,
                   due_amt, COALESCE(paid_amt, 0) AS paid_amt, overdue_amt,
                   COALESCE(balance, 0) AS balance, snapshot_date,
                   installment_num AS mob, {MISSED} AS installments_missed
            FROM $loan))
"""
# the same over single-precision amounts, as the silver table stores them
SILVER_LOAN_FLOAT = SILVER_LOAN.replace("$loan", """(SELECT * REPLACE (CAST(loan_amt AS FLOAT) AS loan_amt,
   CAST(due_amt AS FLOAT) AS due_amt, CAST(paid_amt AS FLOAT) AS paid_amt,
   CAST(overdue_amt AS FLOAT) AS overdue_amt, CAST(balance AS FLOAT) AS balance) FROM $loan)""").replace(
    "overdue_amt / NULLIF(due_amt, 0)", "CAST(overdue_amt AS DOUBLE) / NULLIF(CAST(due_amt AS DOUBLE), 0)")
LABELS = f"""
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
       '30dpd_6mob' AS label_def, snapshot_date
FROM ({SILVER_LOAN}) WHERE mob = 6
"""


def DIGITS(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def BOUNDED(value: str, low=None, high=None) -> str:
    test = " AND ".join(
        ([f"{value} >= {low}"] if low is not None else [])
        + ([f"{value} <= {high}"] if high is not None else [])
    )
    return f"CASE WHEN {test} THEN {value} END"


AGE = BOUNDED("TRY_CAST(regexp_replace(Age, '[^0-9\\-]', '', 'g') AS INT)", 18, 120)
SSN = (
    "CASE WHEN regexp_matches(regexp_replace(SSN, '[^0-9\\-]', '', 'g'), '^\\d{3}-\\d{2}-\\d{4}$') "
    "THEN regexp_replace(SSN, '[^0-9\\-]', '', 'g') END"
)
OCCUPATION = "replace(NULLIF(Occupation, '_______'), '_', ' ')"
# DuckDB has no initcap; the view's names are "word digits" with one letter word.
NAME = "(upper(substr(trim(Name), 1, 1)) || substr(trim(Name), 2))"
SILVER_ATTRIBUTES = f"""
SELECT Customer_ID, {NAME} AS Name, {AGE} AS Age, {SSN} AS SSN, {OCCUPATION} AS Occupation,
       snapshot_date,
       substr({NAME}, 1, 1) || repeat('*', greatest(length({NAME}) - 1, 0)) AS Name_Masked,
       'XXX-XX-' || right({SSN}, 4) AS SSN_Masked
FROM $attributes
"""
MONTHS = (
    "COALESCE(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years', 1) AS INT), 0) * 12 + "
    "COALESCE(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months', 1) AS INT), 0)"
)
LOAN_ITEMS = (
    "list_transform(string_split(regexp_replace(Type_of_Loan, '\\s+and\\s+', ',', 'g'), ','), lambda x: trim(x))"
)
LOAN_TYPES = f"""(SELECT array_to_string(list_filter({LOAN_ITEMS},
     lambda x, i: x NOT IN ('Not Specified', '') AND list_position({LOAN_ITEMS}, x) = i), '|'))"""
SPENT = """CASE WHEN Payment_Behaviour ILIKE 'low\\_spent%' ESCAPE '\\' THEN 'Low'
     WHEN Payment_Behaviour ILIKE 'high\\_spent%' ESCAPE '\\' THEN 'High' END"""
PAYMENT = """CASE WHEN lower(Payment_Behaviour) LIKE '%large_value_payments%' THEN 'Large'
     WHEN lower(Payment_Behaviour) LIKE '%medium_value_payments%' THEN 'Medium'
     WHEN lower(Payment_Behaviour) LIKE '%small_value_payments%' THEN 'Small' END"""
MIN_AMOUNT = """CASE WHEN Payment_of_Min_Amount IN ('No', 'NM') THEN 'No'
     WHEN Payment_of_Min_Amount = 'Yes' THEN 'Yes' END"""
SILVER_FINANCIALS = f"""
SELECT Customer_ID, {DIGITS('Annual_Income')} AS Annual_Income, Monthly_Inhand_Salary,
       {BOUNDED('Num_Bank_Accounts', 0, 50)} AS Num_Bank_Accounts,
       {BOUNDED('Num_Credit_Card', 0, 20)} AS Num_Credit_Card,
       {BOUNDED('Interest_Rate', 0, 100)} AS Interest_Rate,
       CAST({BOUNDED(f"trunc({DIGITS('Num_of_Loan')})", 0, 20)} AS INT) AS Num_of_Loan,
       {LOAN_TYPES} AS Type_of_Loan, Delay_from_due_date,
       CAST({BOUNDED(f"trunc({DIGITS('Num_of_Delayed_Payment')})", 0, 100)} AS INT)
           AS Num_of_Delayed_Payment,
       {DIGITS('Changed_Credit_Limit')} AS Changed_Credit_Limit,
       {BOUNDED('Num_Credit_Inquiries', 0, 50)} AS Num_Credit_Inquiries,
       CASE WHEN Credit_Mix IN ('Good', 'Standard', 'Bad') THEN Credit_Mix END AS Credit_Mix,
       {DIGITS('Outstanding_Debt')} AS Outstanding_Debt, Credit_Utilization_Ratio,
       {MONTHS} AS Credit_History_Age, {MIN_AMOUNT} AS Payment_of_Min_Amount,
       {BOUNDED('Total_EMI_per_month', 0)} AS Total_EMI_per_month,
       {DIGITS('Amount_invested_monthly')} AS Amount_invested_monthly,
       {DIGITS('Monthly_Balance')} AS Monthly_Balance, snapshot_date,
       {SPENT} AS Payment_Behaviour_Spent, {PAYMENT} AS Payment_Behaviour_Payment
FROM $financials
"""
AGE_BIN = """CASE WHEN Age < 18 THEN 'under_18' WHEN Age < 25 THEN '18_24' WHEN Age < 35 THEN '25_34'
     WHEN Age < 50 THEN '35_49' WHEN Age < 65 THEN '50_64' WHEN Age >= 65 THEN '65_plus' END"""
GOLD_ATTRIBUTES = f"""
SELECT Customer_ID, Age, Occupation, snapshot_date, {AGE_BIN} AS Age_bin FROM ({SILVER_ATTRIBUTES})
"""
CODES = """
  CASE Credit_Mix WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END AS Credit_Mix_Enc,
  CASE Payment_of_Min_Amount WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS Payment_of_Min_Amount_Enc,
  CASE Payment_Behaviour_Spent WHEN 'Low' THEN 0 WHEN 'High' THEN 1 END
      AS Payment_Behaviour_Spent_Enc,
  CASE Payment_Behaviour_Payment WHEN 'Small' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Large' THEN 2 END
      AS Payment_Behaviour_Payment_Enc
"""
RATIOS = """
  CASE WHEN Annual_Income > 0 THEN Total_EMI_per_month / (Annual_Income / 12) END AS emi_to_income_ratio,
  CASE WHEN Annual_Income > 0 THEN Outstanding_Debt / Annual_Income END AS debt_to_income_ratio,
  CASE WHEN Num_of_Loan > 0 THEN Delay_from_due_date / Num_of_Loan END AS avg_delay,
  CASE WHEN Annual_Income > 0 THEN Monthly_Balance / (Annual_Income / 12) END
      AS balance_to_income_ratio
"""
FLAGS = """
  CASE WHEN Num_Credit_Inquiries > 10 THEN 1 ELSE 0 END AS high_credit_inquiry_flag,
  CASE WHEN Credit_Utilization_Ratio > CAST(0.8 AS DOUBLE) THEN 1 ELSE 0 END AS high_utilization_flag,
  CASE WHEN emi_to_income_ratio > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS high_emi_burden_flag,
  CASE WHEN Monthly_Balance < 0 THEN 1 ELSE 0 END AS negative_balance_flag
"""
GOLD_FINANCIALS = f"""
SELECT *, {FLAGS} FROM (SELECT *, {CODES}, {RATIOS} FROM ({SILVER_FINANCIALS}))
"""

# what is stored: floating columns in single precision, arithmetic in double
FLOATS = sorted(
    {c for c, t in fixed.FINANCIAL_TYPES.items() if t == "float"} | set(fixed.DIRTY_FLOATS)
    | {c for c, (_, _, kind) in fixed.FINANCIAL_RANGES.items() if kind == "float"})


def cast_all(columns: list[str], kind: str, source: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {kind}) AS {c}' for c in columns)}) FROM ({source})"


SILVER_FINANCIALS_FLOAT = cast_all(FLOATS, "FLOAT", SILVER_FINANCIALS)
STORED_FINANCIALS = cast_all(FLOATS, "DOUBLE", SILVER_FINANCIALS_FLOAT)
GOLD_FINANCIALS_FLOAT = cast_all(
    FLOATS, "FLOAT", f"SELECT *, {FLAGS} FROM (SELECT *, {CODES}, {RATIOS} FROM ({STORED_FINANCIALS}))")

# ---------------------------------------------------------------- typing and schema
REGISTRY.add("enforce_schema", """
SELECT CAST(trunc(CAST(o_totalprice AS DOUBLE)) AS INT) AS price_int,
       TRY_CAST(o_orderstatus AS INT) AS status_int,
       CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderkey AS VARCHAR) AS o_orderkey
FROM orders
""")(lambda t: schema.enforce_schema(
    t.table("orders").select(
        F.col("o_totalprice").cast("string").alias("price_int"),
        F.col("o_orderstatus").alias("status_int"),
        F.col("o_orderdate").alias("order_date"), "o_orderkey"),
    {"price_int": "int", "status_int": "int", "order_date": "date", "o_orderkey": "string"},
))

REGISTRY.add("project_present", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS attributes_snapshot_date, o_orderstatus FROM orders
""")(lambda t: schema.project_present(
    t.table("orders").withColumn("snapshot_date", F.to_date("o_orderdate")),
    ["o_custkey", "snapshot_date", "not_there", "o_orderstatus"],
    {"snapshot_date": "attributes_snapshot_date"},
))

REGISTRY.add("select_prefix", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
""")(lambda t: schema.select_prefix(
    t.table("orders").drop("o_orderdate"), "o_order", keys=["o_orderkey"]))

WINDOWS = dates.derive_windows(datetime.date(2000, 1, 1), 12, 2)
REGISTRY.add("filter_window", """
SELECT loan_id, snapshot_date, CASE WHEN snapshot_date >= DATE '1999-11-01' THEN 'oot'
       ELSE 'train_test' END AS split
FROM $loan WHERE snapshot_date BETWEEN DATE '1998-11-01' AND DATE '1999-12-31'
""")(lambda t: schema.filter_window(t.view("loan"), "snapshot_date", WINDOWS).select(
    "loan_id", "snapshot_date", dates.assign_split("snapshot_date", WINDOWS).alias("split")))

REGISTRY.add("fill_numeric_nulls", """
SELECT loan_id, COALESCE(paid_amt, 0) AS paid_amt, COALESCE(balance, 0) AS balance,
       NULLIF(loan_id, '1-1') AS maybe_text
FROM $loan
""")(lambda t: schema.fill_numeric_nulls(t.view("loan").select(
    "loan_id", "paid_amt", "balance", F.nullif(F.col("loan_id"), F.lit("1-1")).alias("maybe_text"))))

REGISTRY.add("drop_null_features", """
SELECT loan_id, Customer_ID, paid_amt, balance FROM $loan
WHERE paid_amt IS NOT NULL AND balance IS NOT NULL
""")(lambda t: schema.drop_null_features(
    t.view("loan").select("loan_id", "Customer_ID", "paid_amt", "balance"), ["loan_id", "Customer_ID"]))

REGISTRY.add("coerce_numeric", """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS cust_text, o_orderstatus,
       CAST(o_orderkey AS VARCHAR) AS key_text
FROM orders
""")(lambda t: schema.coerce_numeric(
    t.table("orders").select(
        "o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("cust_text"),
        "o_orderstatus", F.col("o_orderkey").cast("string").alias("key_text")),
    exclude=["key_text"]))

# ---------------------------------------------------------------- cleaning functions
REGISTRY.add("parse_dirty_number", f"""
SELECT Customer_ID, {DIGITS('Annual_Income')} AS income, {DIGITS('Changed_Credit_Limit')} AS credit_limit,
       CAST(trunc({DIGITS('Num_of_Loan')}) AS INT) AS loans
FROM $financials
""")(lambda t: t.view("financials").select(
    "Customer_ID", text.parse_dirty_number("Annual_Income").alias("income"),
    text.parse_dirty_number("Changed_Credit_Limit").alias("credit_limit"),
    text.parse_dirty_number("Num_of_Loan", "int").alias("loans")))

REGISTRY.add("null_out_of_range", f"""
SELECT Customer_ID, {BOUNDED('Num_Bank_Accounts', 0, 50)} AS accounts,
       {BOUNDED('Total_EMI_per_month', 0)} AS emi
FROM $financials
""")(lambda t: t.view("financials").select(
    "Customer_ID", text.null_out_of_range("Num_Bank_Accounts", 0, 50).alias("accounts"),
    text.null_out_of_range("Total_EMI_per_month", 0).alias("emi")))

REGISTRY.add("clean_age", f"SELECT Age AS raw, {AGE} AS age FROM $attributes")(
    lambda t: t.view("attributes").select(F.col("Age").alias("raw"), text.clean_age("Age").alias("age")))

REGISTRY.add("normalise_name", f"SELECT Customer_ID, {NAME} AS name FROM $attributes")(
    lambda t: t.view("attributes").select("Customer_ID", text.normalise_name("Name").alias("name")))

REGISTRY.add("mask_keep_first", """
SELECT p_partkey, substr(p_name, 1, 1) || repeat('*', greatest(length(p_name) - 1, 0)) AS masked
FROM part
""")(lambda t: t.table("part").select("p_partkey", text.mask_keep_first("p_name").alias("masked")))

REGISTRY.add("validate_pattern", f"""
SELECT Customer_ID, {SSN} AS ssn, 'XXX-XX-' || right({SSN}, 4) AS masked FROM $attributes
""")(lambda t: t.view("attributes").select(
    "Customer_ID", text.validate_pattern("SSN").alias("ssn"),
    text.mask_keep_last(text.validate_pattern("SSN")).alias("masked")))

REGISTRY.add("clean_category", f"SELECT Customer_ID, {OCCUPATION} AS occupation FROM $attributes")(
    lambda t: t.view("attributes").select("Customer_ID", text.clean_category("Occupation").alias("occupation")))

REGISTRY.add("whitelist_collapse", f"""
SELECT Customer_ID, CASE WHEN Credit_Mix IN ('Good', 'Standard', 'Bad') THEN Credit_Mix END AS mix,
       {MIN_AMOUNT} AS min_amount
FROM $financials
""")(lambda t: t.view("financials").select(
    "Customer_ID", text.whitelist("Credit_Mix", fixed.CREDIT_MIX_VALUES).alias("mix"),
    text.collapse_values("Payment_of_Min_Amount", fixed.MIN_AMOUNT_VALUES).alias("min_amount")))

REGISTRY.add("regex_category", f"""
SELECT Customer_ID, {SPENT} AS spent, {PAYMENT} AS payment FROM $financials
""")(lambda t: t.view("financials").select(
    "Customer_ID", text.regex_category("Payment_Behaviour", fixed.SPENT_PATTERNS).alias("spent"),
    text.regex_category("Payment_Behaviour", fixed.PAYMENT_PATTERNS).alias("payment")))

REGISTRY.add("parse_duration_months", f"SELECT Credit_History_Age AS raw, {MONTHS} AS months FROM $financials")(
    lambda t: t.view("financials").select(
        F.col("Credit_History_Age").alias("raw"),
        text.parse_duration_months("Credit_History_Age").alias("months")))

REGISTRY.add("clean_multi_value", f"SELECT Customer_ID, {LOAN_TYPES} AS loan_types FROM $financials")(
    lambda t: t.view("financials").select("Customer_ID", text.clean_multi_value("Type_of_Loan").alias("loan_types")))

REGISTRY.add("normalise_nulls", """
SELECT conv_id, turn, CASE WHEN trim(role) IN ('', 'user') THEN NULL ELSE trim(role) END AS role,
       CASE WHEN trim(text, E' \\t\\n\\r\\x0b\\x0c') IN
            ('', ' ', 'NONE', 'None', 'none', 'NULL', 'null', 'NaN', 'nan', 'N/A', 'NA')
            THEN NULL ELSE trim(text, E' \\t\\n\\r\\x0b\\x0c') END AS text
FROM conversations
""")(lambda t: t.table("conversations").select(
    "conv_id", "turn", text.normalise_nulls("role", ["", "user"]).alias("role"),
    text.normalise_nulls("text").alias("text")))

REGISTRY.add("hash_id", """
SELECT Customer_ID, sha256(concat_ws('||', Customer_ID, SSN)) AS hashed FROM $attributes
""")(lambda t: t.view("attributes").select("Customer_ID", text.hash_id("Customer_ID", "SSN").alias("hashed")))

REGISTRY.add("parse_version_date", """
SELECT o_orderkey, TRY_CAST(replace(regexp_extract(v, '(\\d{4}_\\d{2}_\\d{2})$', 1), '_', '-') AS DATE)
       AS trained_on
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'm_2024_13_01'
             ELSE 'm_' || replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '_') END AS v FROM orders)
""")(lambda t: t.table("orders").select("o_orderkey", text.parse_version_date(
    F.when(F.col("o_orderkey") % 9 == 0, F.lit("m_2024_13_01")).otherwise(
        F.concat(F.lit("m_"), F.date_format("o_orderdate", "yyyy_MM_dd")))).alias("trained_on")))

# ---------------------------------------------------------------- dates
REGISTRY.add("month_floor", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       TRY_CAST(o_orderpriority AS DATE) AS bad_date
FROM orders
""")(lambda t: t.table("orders").select(
    "o_orderkey", dates.month_floor("o_orderdate").alias("month"),
    dates.to_date_safe("o_orderpriority").alias("bad_date")))

REGISTRY.add("derive_windows", """
SELECT d AS anchor, CAST(d - INTERVAL 2 MONTH - INTERVAL 12 MONTH AS DATE) AS train_test_start,
       CAST(d - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end,
       CAST(d - INTERVAL 2 MONTH AS DATE) AS oot_start, CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
""")(lambda t: t.table("orders").select(F.to_date("o_orderdate").alias("anchor")).distinct().select(
    "anchor", *dates.derive_window_columns("anchor", 12, 2)))

REGISTRY.add("whole_months_between", """
SELECT l_orderkey, l_linenumber, a, b,
       CAST(m - CASE WHEN b >= a AND CAST(a + to_months(CAST(m AS INT)) AS DATE) > b THEN 1 ELSE 0 END
              + CASE WHEN b < a AND CAST(a + to_months(CAST(m AS INT)) AS DATE) < b THEN 1 ELSE 0 END
            AS INT) AS months
FROM (SELECT *, (year(b) - year(a)) * 12 + month(b) - month(a) AS m
      FROM (SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
""")(lambda t: t.table("lineitem").join(
    t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
    "l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("a"), F.to_date("l_shipdate").alias("b")).select(
    "*", dates.whole_months_between("a", "b").alias("months")))

# ---------------------------------------------------------------- silver tables
REGISTRY.add("add_delinquency", SILVER_LOAN)(lambda t: silver.add_delinquency(t.view("loan")))

REGISTRY.add("silver_loans", SILVER_LOAN_FLOAT)(lambda t: silver.silver_loans(t.view("loan")))

REGISTRY.add("silver_clickstream", "SELECT * FROM $click")(
    lambda t: silver.silver_clickstream(t.view("click").withColumns(
        {c: F.col(c).cast("string") for c in fixed.CLICK_FEATURES})))

REGISTRY.add("silver_attributes", SILVER_ATTRIBUTES)(
    lambda t: silver.silver_attributes(t.view("attributes")))

REGISTRY.add("silver_financials", SILVER_FINANCIALS_FLOAT)(
    lambda t: silver.silver_financials(t.view("financials")))

# ---------------------------------------------------------------- gold tables
REGISTRY.add("label_store", LABELS)(lambda t: gold.label_store(silver.add_delinquency(t.view("loan"))))

REGISTRY.add("gold_clickstream", "SELECT *, snapshot_date AS feature_snapshot_date FROM $click")(
    lambda t: gold.gold_clickstream(silver.silver_clickstream(t.view("click"))))

REGISTRY.add("gold_attributes", GOLD_ATTRIBUTES)(
    lambda t: gold.gold_attributes(silver.silver_attributes(t.view("attributes"))))

REGISTRY.add("bucketise", f"SELECT Customer_ID, Age, {AGE_BIN} AS age_bin FROM ({SILVER_ATTRIBUTES})")(
    lambda t: t.view("attributes").select("Customer_ID", text.clean_age("Age").alias("Age")).select(
        "Customer_ID", "Age", numeric.bucketise("Age", fixed.AGE_BINS).alias("age_bin")))

REGISTRY.add("ordinal_encode", f"SELECT Customer_ID, {CODES} FROM ({SILVER_FINANCIALS})")(
    lambda t: gold.add_ordinal_codes(silver.silver_financials(t.view("financials"), "double")).select(
        "Customer_ID", *fixed.ENCODED_COLUMNS))

REGISTRY.add("guarded_ratio", f"SELECT Customer_ID, {RATIOS} FROM ({SILVER_FINANCIALS})")(
    lambda t: gold.add_ratios(silver.silver_financials(t.view("financials"), "double")).select(
        "Customer_ID", *fixed.RATIO_COLUMNS))

REGISTRY.add("threshold_flags", f"""
SELECT Customer_ID, {FLAGS} FROM (SELECT *, {RATIOS} FROM ({SILVER_FINANCIALS}))
""")(lambda t: gold.add_risk_flags(gold.add_ratios(
    silver.silver_financials(t.view("financials"), "double"))).select("Customer_ID", *fixed.FLAG_COLUMNS))

REGISTRY.add("gold_financials", GOLD_FINANCIALS_FLOAT)(
    lambda t: gold.gold_financials(silver.silver_financials(t.view("financials"))))
