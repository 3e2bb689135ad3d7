"""Input views: the driver tables shaped like the datamart's raw tables.

Each view is one SQL text that both engines run unchanged, over whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featuremart.session import materialise

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_MONTH = "CAST(date_trunc('month', CAST({} AS DATE)) AS DATE)".format

VIEWS: dict[str, str] = {}

VIEWS["loan"] = f"""
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS loan_id,
       CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
       CAST(o_orderdate AS DATE) AS loan_start_date,
       7 AS tenure,
       l_linenumber AS installment_num,
       l_extendedprice AS loan_amt,
       CASE WHEN l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / 10 END AS due_amt,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_extendedprice / 10 END AS paid_amt,
       CASE WHEN l_returnflag = 'R' THEN (l_extendedprice / 10) * (CAST(l_quantity AS INT) % 4)
            ELSE CAST(0 AS DOUBLE) END AS overdue_amt,
       NULLIF(l_extendedprice * l_discount, 0) AS balance,
       {_MONTH('l_shipdate')} AS snapshot_date
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

VIEWS["click"] = f"""
SELECT CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
       {_MONTH('o_orderdate')} AS snapshot_date,
       {", ".join(
           f"CASE WHEN (o_orderkey + {i}) % 13 = 0 THEN NULL "
           f"ELSE CAST((o_orderkey * {i} + o_custkey) % 97 AS INT) - 40 END AS fe_{i}"
           for i in range(1, 21))}
FROM {{orders}}
"""

VIEWS["attributes"] = f"""
SELECT CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
       '  ' || lower(replace(c_name, '#', ' ')) || ' ' AS Name,
       CASE WHEN o_orderkey % 17 = 0 THEN '-500'
            WHEN o_orderkey % 19 = 0 THEN '45.5'
            WHEN o_orderkey % 23 = 0 THEN ''
            ELSE CAST((o_custkey * 7 + o_orderkey) % 130 AS STRING) || '_' END AS Age,
       CASE WHEN o_orderkey % 7 = 0 THEN '#F%$D@*&8'
            ELSE lpad(CAST(o_custkey % 1000 AS STRING), 3, '0') || '-'
                 || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || '-'
                 || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') END AS SSN,
       CASE WHEN o_orderkey % 5 = 0 THEN '_______'
            ELSE replace(c_mktsegment || ' clerk', ' ', '_') END AS Occupation,
       {_MONTH('o_orderdate')} AS snapshot_date
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

VIEWS["financials"] = f"""
SELECT CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS Customer_ID,
       CASE WHEN o_orderkey % 29 = 0 THEN '-'
            ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.25_' END AS Annual_Income,
       o_totalprice / 12 AS Monthly_Inhand_Salary,
       CAST(o_orderkey % 60 AS INT) - 3 AS Num_Bank_Accounts,
       CAST(o_custkey % 25 AS INT) - 1 AS Num_Credit_Card,
       CAST(o_orderkey % 130 AS DOUBLE) - 5 AS Interest_Rate,
       CASE WHEN o_orderkey % 11 = 0 THEN '-100'
            WHEN o_orderkey % 10 = 0 THEN '3.7_'
            ELSE CAST(o_custkey % 23 AS STRING) || '_' END AS Num_of_Loan,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL
            WHEN o_orderkey % 8 = 0 THEN 'Not Specified'
            ELSE replace(substr(o_orderpriority, 3), ' ', '') || ' Loan, Auto Loan, and '
                 || CASE WHEN o_orderkey % 2 = 0 THEN 'Auto Loan' ELSE 'Payday Loan' END
       END AS Type_of_Loan,
       CAST(o_orderkey % 70 AS INT) - 5 AS Delay_from_due_date,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_orderkey % 120 AS STRING) || '_' END
           AS Num_of_Delayed_Payment,
       CASE WHEN o_orderkey % 15 = 0 THEN '_' ELSE CAST(o_orderkey % 31 AS STRING) || '.5' END
           AS Changed_Credit_Limit,
       CAST(o_orderkey % 61 AS INT) - 4 AS Num_Credit_Inquiries,
       CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Standard'
            ELSE CASE WHEN o_orderkey % 3 = 0 THEN '_' ELSE 'Bad' END END AS Credit_Mix,
       CAST(CAST(floor(o_totalprice / 3) AS BIGINT) AS STRING) || '_' AS Outstanding_Debt,
       CAST(o_orderkey % 150 AS DOUBLE) / 100 - 0.1 AS Credit_Utilization_Ratio,
       CASE WHEN o_orderkey % 21 = 0 THEN NULL
            WHEN o_orderkey % 20 = 0 THEN 'NA'
            ELSE CAST(o_orderkey % 34 AS STRING) || ' Years and '
                 || CAST(o_custkey % 12 AS STRING) || ' Months' END AS Credit_History_Age,
       CASE o_orderkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NM' ELSE 'zz' END
           AS Payment_of_Min_Amount,
       o_totalprice / 20 - 500 AS Total_EMI_per_month,
       '__' || CAST(o_orderkey % 1000 AS STRING) || '__' AS Amount_invested_monthly,
       CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) || '_' AS Monthly_Balance,
       CASE WHEN o_orderkey % 14 = 0 THEN '!@9#%8'
            ELSE CASE o_orderstatus WHEN 'F' THEN 'low_spent_' ELSE 'High_spent_' END
                 || CASE o_orderkey % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'large' END
                 || '_value_payments' END AS Payment_Behaviour,
       {_MONTH('o_orderdate')} AS snapshot_date
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

# Document quality labels against a length score.
VIEWS["scored"] = """
SELECT CAST(d.doc_id AS STRING) AS Customer_ID, d.lang, d.source,
       least(1.0, CAST(n_chars AS DOUBLE) / 5000) AS score,
       quality AS label, toxic
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# One score per order line with a month; the label is "returned".
VIEWS["predictions"] = f"""
SELECT CAST(o_custkey AS STRING) AS Customer_ID,
       {_MONTH('o_orderdate')} AS snapshot_date,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_totalprice / 600000 END AS default_proba,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       'm' || CAST(o_orderkey % 3 AS STRING) AS model_version
FROM {{orders}}
"""

# One monitoring row per month, with the older metric names.
VIEWS["monitoring"] = f"""
SELECT {_MONTH('o_orderdate')} AS month,
       COUNT(*) AS sample_size,
       round(AVG(o_totalprice) / 600000, 6) AS predicted_default_risk_mean,
       round(AVG(CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS accuracy,
       CASE WHEN COUNT(*) % 5 = 0 THEN NULL
            ELSE CAST(CAST(COUNT(*) % 89 AS DOUBLE) / 89 AS STRING) END AS macro_f1
FROM {{orders}} GROUP BY 1
"""

# Model runs: one per part.
VIEWS["runs"] = """
SELECT 'r' || CAST(p_partkey AS STRING) AS run_id,
       CASE WHEN p_partkey % 7 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
       make_date(2024, 1 + CAST(p_size % 12 AS INT), 1) AS train_date,
       CASE WHEN p_partkey % 2 = 0 THEN 'xgboost' ELSE 'logreg' END AS flavor,
       p_brand AS model_name,
       p_partkey AS version,
       CASE p_partkey % 5 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging'
            WHEN 2 THEN 'Archived' ELSE 'None' END AS stage,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey % 40 AS DOUBLE) / 80 + 0.5 END
           AS auc_test,
       CASE WHEN p_partkey % 9 = 0 THEN NULL
            ELSE round(p_retailprice / 2500, 6) + CAST(p_partkey % 1000 AS DOUBLE) / 1000000 END
           AS auc_oot,
       p_type AS params_text
FROM {part}
"""


def duck_view(name: str) -> str:
    """View text for DuckDB, as a derived table."""
    return "(" + VIEWS[name].format(**{t: t for t in TABLES}) + ")"


def oracle(text: str) -> str:
    """Replace ``$name`` by the view of that name."""
    return re.sub(r"\$(\w+)", lambda m: duck_view(m.group(1)), text)


class Inputs:
    """Driver tables and views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A result written once for all steps of a query that read it."""
        key = "stored " + name
        if key not in self._known:
            self._known[key] = materialise(build(), name)
        return self._known[key]

    def view(self, name: str) -> DataFrame:
        key = "view " + name
        if key not in self._known:
            text = VIEWS[name]
            used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
            self._known[key] = self.spark.sql(text, **used)
        return self._known[key]


class Registry:
    """Named queries, each with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(build: Callable[[Inputs], DataFrame]):
            if name in self.queries:
                raise ValueError(f"duplicate query {name}")
            self.queries[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = oracle(sql)
            return build

        return register


REGISTRY = Registry()
