"""Scoring quality, drift, preprocessing and registry queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.datamart_queries import LABELS, SILVER_FINANCIALS
from checks.pit_queries import labels
from checks.profile_queries import dec, rounded
from checks.views import REGISTRY
from featuremart.functions import numeric
from featuremart import fixed_values as fixed
from featuremart.operators import metrics, prep, registry
from featuremart.plans import monitoring, silver
from featuremart.session import shared_folder

HALF = "CAST(0.5 AS DOUBLE)"
CONFUSION = """
SELECT {g} count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 0) AS tn,
       count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn
FROM (SELECT *, label AS y, CASE WHEN COALESCE({s}, 0) >= {h} THEN 1 ELSE 0 END AS p FROM {src}) {by}
"""


def share(top: str, bottom: str) -> str:
    return f"COALESCE(CAST({top} AS DOUBLE) / NULLIF({bottom}, 0), 0)"


CLASSES = "((CASE WHEN tp + fp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp + fn > 0 THEN 1 ELSE 0 END))"
F1_1, F1_0 = share("2 * tp", "2 * tp + fp + fn"), share("2 * tn", "2 * tn + fp + fn")
RATES = f"""
{dec(share('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {dec(share('tp', 'tp + fp'))} AS precision,
{dec(share('tp', 'tp + fn'))} AS recall,
{dec(share(f"({share('tp', 'tp + fp')} + {share('tn', 'tn + fn')})", CLASSES))} AS precision_macro,
{dec(share(f"({share('tp', 'tp + fn')} + {share('tn', 'tn + fp')})", CLASSES))} AS recall_macro,
{dec(share(f'({F1_1} + {F1_0})', CLASSES))} AS f1_macro,
{dec(share(f'({F1_1} * (tp + fn) + {F1_0} * (tn + fp))', 'tp + tn + fp + fn'))} AS f1_weighted
"""


def metric_sql(source: str, score: str, group: str = "") -> str:
    counts = CONFUSION.format(
        g=f"{group}," if group else "", s=score, h=HALF, src=source, by=f"GROUP BY {group}" if group else "")
    return f"SELECT *, {RATES} FROM ({counts})"


def auc_sql(source: str, score: str, group: str = "") -> str:
    over = f"PARTITION BY {group} " if group else ""
    g = f"{group}," if group else ""
    return f"""
SELECT {g} {dec('auc')} AS auc_roc, {dec('2 * auc - 1')} AS gini FROM (
  SELECT {g} sum(CASE WHEN label = 1 THEN CAST(below AS DOUBLE) + (ties - 1.0) / 2 END)
             / NULLIF(CAST(sum(label) AS DOUBLE) * (count(*) - sum(label)), 0) AS auc
  FROM (SELECT {g} label, count(*) FILTER (label = 0) OVER ({over} ORDER BY s) -
               count(*) FILTER (label = 0) OVER ({over + ',' if over else 'PARTITION BY '} s) AS below,
               1 + count(*) FILTER (label = 0) OVER ({over + ',' if over else 'PARTITION BY '} s) AS ties
        FROM (SELECT *, COALESCE({score}, 0) AS s FROM {source}))
  {f'GROUP BY {group}' if group else ''})
"""


REGISTRY.add("binary_metrics", metric_sql("$scored", "score"))(
    lambda t: rounded(metrics.binary_metrics(t.view("scored"), "label", "score")))

REGISTRY.add("binary_metrics_by_month", metric_sql("$predictions", "default_proba", "snapshot_date"))(
    lambda t: rounded(metrics.binary_metrics(t.view("predictions"), groups=["snapshot_date"])))

REGISTRY.add("roc_auc", auc_sql("$scored", "score"))(
    lambda t: rounded(metrics.roc_auc(t.view("scored"), "label", "score")))

REGISTRY.add("roc_auc_by_month", auc_sql("$predictions", "default_proba", "snapshot_date"))(
    lambda t: rounded(metrics.roc_auc(t.view("predictions"), groups=["snapshot_date"])))

SPLITS = ("(SELECT *, CASE WHEN snapshot_date >= DATE '2000-06-01' THEN 'oot' "
          "WHEN snapshot_date >= DATE '1999-06-01' THEN 'test' ELSE 'train' END AS split FROM $predictions)")


def with_splits(t):
    day = F.col("snapshot_date")
    split = F.when(day >= datetime.date(2000, 6, 1), "oot").when(
        day >= datetime.date(1999, 6, 1), "test").otherwise("train")
    return t.view("predictions").withColumn("split", split)


REGISTRY.add("evaluate_splits", f"""
SELECT * FROM ({auc_sql(SPLITS, 'default_proba', 'split')})
JOIN ({metric_sql(SPLITS, 'default_proba', 'split')}) USING (split)
""")(lambda t: rounded(metrics.evaluate_splits(with_splits(t))))

REGISTRY.add("split_stats", f"""
SELECT split, label, count(*) AS rows, CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS sample_size,
       {dec('count(*) / sum(count(*)) OVER (PARTITION BY split)')} AS label_ratio
FROM {SPLITS} GROUP BY split, label
""")(lambda t: rounded(metrics.split_stats(with_splits(t))))

KS_BASE = "(SELECT default_proba AS s FROM $predictions WHERE snapshot_date < DATE '1998-01-01' AND default_proba IS NOT NULL)"
KS_CURR = "(SELECT default_proba AS s FROM $predictions WHERE snapshot_date >= DATE '1998-01-01' AND default_proba IS NOT NULL)"


def halves(t):
    p = t.view("predictions")
    return p.filter("snapshot_date < DATE '1998-01-01'"), p.filter("snapshot_date >= DATE '1998-01-01'")


REGISTRY.add("ks_statistic", f"""
SELECT {dec('max(abs(a - b))')} AS ks_stat FROM (
  SELECT s, sum(w_b) OVER (ORDER BY s) / (SELECT count(*) FROM {KS_BASE}) AS a,
         sum(w_c) OVER (ORDER BY s) / (SELECT count(*) FROM {KS_CURR}) AS b
  FROM (SELECT s, sum(b) AS w_b, sum(c) AS w_c
        FROM (SELECT s, 1 AS b, 0 AS c FROM {KS_BASE} UNION ALL SELECT s, 0, 1 FROM {KS_CURR}) GROUP BY s))
""")(lambda t: rounded(metrics.ks_statistic(*halves(t))))

DECILES = ", ".join(str(k / 10) for k in range(1, 10))
TERM = "(c - b) * ln((c + CAST(1e-8 AS DOUBLE)) / (b + CAST(1e-8 AS DOUBLE)))"
REGISTRY.add("psi", f"""
WITH e AS (SELECT quantile_cont(s, [{DECILES}]) AS edges FROM {KS_BASE}),
hist AS (SELECT len(list_filter(edges, lambda q: q <= s)) AS k, sum(wb) AS nb, sum(wc) AS nc
         FROM (SELECT s, 1 AS wb, 0 AS wc FROM {KS_BASE} UNION ALL SELECT s, 0, 1 FROM {KS_CURR}), e GROUP BY 1)
SELECT {dec(f'sum({TERM})')} AS psi_stat
FROM (SELECT nb / sum(nb) OVER () AS b, nc / sum(nc) OVER () AS c FROM hist)
""")(lambda t: rounded(metrics.psi(*halves(t))))

SCORES = "(SELECT model_version, snapshot_date AS month, default_proba AS s FROM $predictions WHERE default_proba IS NOT NULL)"
DRIFT = f"""
WITH rows AS (SELECT model_version, month, s, 0 AS wb, 1 AS wc FROM {SCORES}
              UNION ALL SELECT model_version, CAST(month + INTERVAL 1 MONTH AS DATE), s, 1, 0 FROM {SCORES}),
sizes AS (SELECT model_version, month, sum(wb) AS tb, sum(wc) AS tc FROM rows GROUP BY 1, 2),
edges AS (SELECT model_version, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, quantile_cont(s, [{DECILES}]) AS edges
          FROM {SCORES} GROUP BY 1, 2),
psi AS (SELECT model_version, month, sum({TERM}) AS psi_stat
        FROM (SELECT model_version, month, sum(wb) / any_value(tb) AS b, sum(wc) / any_value(tc) AS c
              FROM rows JOIN edges USING (model_version, month) JOIN sizes USING (model_version, month)
              GROUP BY model_version, month, len(list_filter(edges, lambda q: q <= s))) GROUP BY 1, 2),
steps AS (SELECT model_version, month, s, sum(wb) AS nb, sum(wc) AS nc FROM rows GROUP BY 1, 2, 3),
ks AS (SELECT model_version, month, max(abs(fb - fc)) AS ks_stat
       FROM (SELECT model_version, month, sum(nb) OVER w / NULLIF(tb, 0) AS fb, sum(nc) OVER w / NULLIF(tc, 0) AS fc
             FROM steps JOIN sizes USING (model_version, month)
             WINDOW w AS (PARTITION BY model_version, month ORDER BY s)) GROUP BY 1, 2)
SELECT model_version, month, CAST(tc AS BIGINT) AS sample_size,
       {dec('CASE WHEN tb > 0 THEN psi_stat END')} AS psi_stat,
       {dec('CASE WHEN tb > 0 THEN ks_stat END')} AS ks_stat
FROM sizes LEFT JOIN psi USING (model_version, month) LEFT JOIN ks USING (model_version, month) WHERE tc > 0
"""
REGISTRY.add("monthly_drift", DRIFT)(lambda t: rounded(metrics.monthly_drift(
    t.view("predictions"), groups=["model_version"])))

REGISTRY.add("drift_band", f"""
SELECT model_version, month, CASE WHEN psi_stat < CAST(0.1 AS DOUBLE) THEN 'stable'
                   WHEN psi_stat <= CAST(0.25 AS DOUBLE) THEN 'moderate'
                   WHEN psi_stat > CAST(0.25 AS DOUBLE) THEN 'significant' END AS band
FROM ({DRIFT})
""")(lambda t: metrics.monthly_drift(t.view("predictions"), groups=["model_version"]).select(
    "model_version", "month", metrics.drift_band("psi_stat").alias("band")))

REGISTRY.add("auc_band", f"""
SELECT snapshot_date, CASE WHEN auc_roc < CAST(0.7 AS DOUBLE) THEN 'poor'
       WHEN auc_roc < CAST(0.75 AS DOUBLE) THEN 'caution' WHEN auc_roc IS NOT NULL THEN 'good' END AS band
FROM ({auc_sql('$predictions', 'default_proba', 'snapshot_date')})
""")(lambda t: rounded(metrics.roc_auc(t.view("predictions"), groups=["snapshot_date"])).select(
    "snapshot_date", numeric.bucketise("auc_roc", fixed.AUC_BANDS).alias("band")))

SUMMARY = f"""count(default_proba) AS sample_size, min(default_proba) AS default_proba_min,
       max(default_proba) AS default_proba_max, {dec('avg(default_proba)')} AS default_proba_mean,
       {dec('stddev_samp(default_proba)')} AS default_proba_std"""
REGISTRY.add("score_summary", f"SELECT {SUMMARY} FROM $predictions")(
    lambda t: rounded(metrics.score_summary(t.view("predictions")), 6, "default_proba_min", "default_proba_max"))

LABELLED = f"""(SELECT p.Customer_ID, p.model_version, p.snapshot_date AS month, p.default_proba, l.label FROM $predictions p
               JOIN (SELECT Customer_ID, snapshot_date, label FROM ({LABELS})) l
               ON p.Customer_ID = l.Customer_ID AND p.snapshot_date = l.snapshot_date)"""
MONITOR = f"""
SELECT * FROM ({metric_sql(LABELLED, 'default_proba', 'model_version, month')})
JOIN ({auc_sql(LABELLED, 'default_proba', 'model_version, month')}) USING (model_version, month)
JOIN (SELECT model_version, snapshot_date AS month, {SUMMARY} FROM $predictions GROUP BY 1, 2) USING (model_version, month)
LEFT JOIN (SELECT model_version, month, psi_stat, ks_stat FROM ({DRIFT})) USING (model_version, month)
"""
REGISTRY.add("monitor", MONITOR)(lambda t: rounded(metrics.monitor(
    t.view("predictions").drop("label"), labels(t)), 6, "default_proba_min", "default_proba_max"))


@REGISTRY.add("monitor_by_month", MONITOR)
def monitored_by_month(t):
    """Counts of all months but the last, then of the last one, then of the first one again."""
    found, known, path = t.view("predictions").drop("label"), labels(t), shared_folder(t.spark, "score-counts")
    first, last = found.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    monitoring.update_state(found, known, path, None, last.replace(day=1) - datetime.timedelta(days=1))
    for month in (last, first):
        monitoring.update_state(found, known, path, month, month)
    return rounded(monitoring.monitor_state(t.spark, path), 6, "default_proba_min", "default_proba_max")


REGISTRY.add("monitoring_overview", f"""
SELECT count(DISTINCT month) AS coverage_months, min(month) AS first_month, max(month) AS last_month,
       {dec('avg(sample_size)', 4)} AS avg_sample_size, {dec('avg(accuracy)', 4)} AS avg_accuracy,
       {dec('avg(TRY_CAST(macro_f1 AS DOUBLE))', 4)} AS avg_f1_macro,
       {dec('avg(predicted_default_risk_mean)', 4)} AS avg_score_mean
FROM $monitoring
""")(lambda t: rounded(metrics.monitoring_overview(t.view("monitoring").withColumnsRenamed(
    {"macro_f1": "f1_macro", "predicted_default_risk_mean": "score_mean"})), 4))

# ---------------------------------------------------------------- preprocessing
SILVER = f"({SILVER_FINANCIALS})"


def money(t):
    return silver.silver_financials(t.view("financials"), "double").select(
        "Customer_ID", "snapshot_date", "Annual_Income", "Num_of_Loan", "Interest_Rate", "Credit_Mix",
        "Type_of_Loan")


REGISTRY.add("impute_median", f"""
SELECT Customer_ID, {', '.join(
    f"{dec(f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM {SILVER}))')} AS {c}"
    for c in ('Annual_Income', 'Num_of_Loan', 'Interest_Rate'))} FROM {SILVER}
""")(lambda t: rounded(prep.impute_median(
    money(t), ["Annual_Income", "Num_of_Loan", "Interest_Rate"]).select(
    "Customer_ID", "Annual_Income", "Num_of_Loan", "Interest_Rate")))

REGISTRY.add("impute_mode", f"""
SELECT Customer_ID, snapshot_date, COALESCE(Credit_Mix, (SELECT Credit_Mix FROM {SILVER} WHERE Credit_Mix IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, Credit_Mix LIMIT 1)) AS Credit_Mix FROM {SILVER}
""")(lambda t: prep.impute_mode(money(t), ["Credit_Mix"]).select("Customer_ID", "snapshot_date", "Credit_Mix"))

REGISTRY.add("impute_constant", f"""
SELECT Customer_ID, COALESCE(Type_of_Loan, 'Unknown') AS Type_of_Loan FROM {SILVER}
""")(lambda t: prep.impute_constant(money(t), ["Type_of_Loan"]).select("Customer_ID", "Type_of_Loan"))

REGISTRY.add("standard_scale", f"""
SELECT o_orderkey, {dec('''(o_totalprice - (SELECT avg(o_totalprice) FROM orders))
       / (SELECT stddev_pop(o_totalprice) FROM orders)''')} AS o_totalprice,
       CAST(0 AS DOUBLE) AS constant FROM orders
""")(lambda t: rounded(prep.standard_scale(
    t.table("orders").select("o_orderkey", "o_totalprice", F.lit(3).alias("constant")),
    ["o_totalprice", "constant"])))

REGISTRY.add("min_max_scale", f"""
SELECT o_orderkey, {dec('''(o_totalprice - (SELECT min(o_totalprice) FROM orders))
       / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders)''')} AS o_totalprice FROM orders
""")(lambda t: rounded(prep.min_max_scale(t.table("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])))

REGISTRY.add("one_hot", """
SELECT o_orderkey, o_orderstatus, CAST(o_orderstatus = 'F' AS DOUBLE) AS o_orderstatus_F,
       CAST(o_orderstatus = 'O' AS DOUBLE) AS o_orderstatus_O,
       CAST(o_orderstatus = 'P' AS DOUBLE) AS o_orderstatus_P FROM orders
""")(lambda t: prep.one_hot(t.table("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus"))

REGISTRY.add("multi_hot", f"""
SELECT Customer_ID, snapshot_date, Type_of_Loan, {', '.join(
    f"CASE WHEN list_contains(string_split(Type_of_Loan, '|'), '{v}') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
    f'AS "Type_of_Loan__{v}"' for v in ('Auto Loan', 'HIGH Loan', 'LOW Loan', 'MEDIUM Loan', 'NOTSPECIFIED Loan',
                                        'Payday Loan', 'URGENT Loan'))} FROM {SILVER}
""")(lambda t: prep.multi_hot(money(t).select("Customer_ID", "snapshot_date", "Type_of_Loan"), "Type_of_Loan"))

# ---------------------------------------------------------------- registry and gates
REGISTRY.add("best_run", """
SELECT * FROM $runs WHERE status = 'FINISHED' AND auc_oot IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY train_date ORDER BY auc_oot DESC, run_id, status, flavor, model_name,
                           version, stage, auc_test NULLS LAST, params_text) = 1
""")(lambda t: registry.best_run(t.view("runs")))

REGISTRY.add("promotion_decision", """
WITH best AS (SELECT train_date, run_id, auc_oot, auc_test FROM $runs WHERE status = 'FINISHED' AND auc_oot IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY train_date ORDER BY auc_oot DESC, run_id) = 1)
SELECT train_date, run_id, auc_oot, auc_test, CASE WHEN run_id IS NULL THEN 'no_run'
       WHEN auc_test >= CAST(0.7 AS DOUBLE) THEN 'promote' ELSE 'guard_failed' END AS outcome
FROM (SELECT DISTINCT train_date FROM $runs) LEFT JOIN best USING (train_date)
""")(lambda t: registry.promotion_decision(t.view("runs")))

LATEST = """SELECT * FROM $runs WHERE stage = 'Production'
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1"""
REGISTRY.add("latest_in_stage", LATEST)(lambda t: registry.latest_in_stage(t.view("runs")))

REGISTRY.add("champion_challenger", f"""
SELECT c.run_id, c.model_name, c.auc_oot, p.version AS current_version, p.auc_oot AS current_metric,
       c.auc_oot IS NOT NULL AND (p.auc_oot IS NULL OR c.auc_oot > p.auc_oot + CAST(1e-6 AS DOUBLE)) AS promote
FROM (SELECT * FROM $runs WHERE stage = 'Staging') c LEFT JOIN ({LATEST}) p ON c.model_name = p.model_name
""")(lambda t: registry.champion_challenger(
    t.view("runs").filter("stage = 'Staging'").select("run_id", "model_name", "auc_oot"), t.view("runs")))

# two promotions in a row: the newest staged versions, then the newest archived ones
REGISTRY.add("transition_stage", """
WITH pick AS (SELECT model_name, max(version) AS chosen FROM $runs WHERE stage = 'Staging' GROUP BY 1),
again AS (SELECT model_name, max(version) AS chosen FROM $runs WHERE stage = 'Archived' GROUP BY 1),
first AS (
  SELECT run_id, r.model_name, version, CASE WHEN version = chosen THEN 'Production'
         WHEN chosen IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
         CASE WHEN version = chosen THEN '{"run_id":"' || run_id || '","version":' || version || '}' END AS description
  FROM $runs r LEFT JOIN pick ON r.model_name = pick.model_name)
SELECT run_id, f.model_name, version, CASE WHEN version = chosen THEN 'Production'
       WHEN chosen IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
       CASE WHEN version = chosen THEN '{"run_id":"' || run_id || '","version":' || version || '}'
            ELSE description END AS description
FROM first f LEFT JOIN again ON f.model_name = again.model_name
""")(lambda t: registry.transition_stage(
    registry.transition_stage(
        t.view("runs").select("run_id", "model_name", "version", "stage"),
        registry.latest_in_stage(t.view("runs"), "Staging"), snapshot=["run_id", "version"]),
    registry.latest_in_stage(t.view("runs"), "Archived"), snapshot=["run_id", "version"]))

REGISTRY.add("dedupe_runs", """
SELECT flavor, train_date, promoted_flag, promoted_at
FROM (SELECT flavor, train_date, stage = 'Production' AS promoted_flag,
             CASE WHEN auc_oot IS NOT NULL THEN train_date + version::INT END AS promoted_at FROM $runs)
QUALIFY row_number() OVER (PARTITION BY flavor, train_date
                           ORDER BY promoted_flag DESC NULLS LAST, promoted_at DESC NULLS LAST) = 1
""")(lambda t: registry.dedupe_runs(t.view("runs").select(
    "flavor", "train_date", (F.col("stage") == "Production").alias("promoted_flag"),
    F.when(F.col("auc_oot").isNotNull(), F.date_add("train_date", F.col("version").cast("int"))).alias("promoted_at"))))

COVERAGE = """
WITH months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
      INTERSECT SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem),
numbered AS (SELECT (year(a) * 12 + month(a)) - (year(m) * 12 + month(m)) - (row_number() OVER (ORDER BY m DESC) - 1) AS gap
             FROM months, (SELECT DATE '2001-06-01' AS a) WHERE m <= a)
SELECT count(*) FILTER (gap = 0) AS months_ready, count(*) FILTER (gap = 0) >= 14 AS enough FROM numbered
"""
REGISTRY.add("month_coverage", COVERAGE)(lambda t: registry.month_coverage(
    [t.table("orders").select("o_orderdate"), t.table("lineitem").select("l_shipdate")],
    F.lit(datetime.date(2001, 6, 1))))

REGISTRY.add("run_decision", f"""
SELECT DATE '2001-07-01' AS run_date, last_train_date, CAST(months AS INT) AS months_apart, months_ready, enough,
       COALESCE(months >= 3, TRUE) AS training_due,
       CASE WHEN enough AND COALESCE(months >= 3, TRUE) THEN 'train' ELSE 'infer' END AS next_step
FROM (SELECT max_by(train_date, version) AS last_train_date,
             -1 * date_sub('month', DATE '2001-07-01', max_by(train_date, version)) AS months
      FROM (SELECT version, CAST(train_date - INTERVAL 23 YEAR AS DATE) AS train_date FROM $runs
            WHERE stage = 'Production' AND model_name = 'Brand#11')),
     ({COVERAGE})
""")(lambda t: registry.run_decision(
    t.view("runs").withColumn("train_date", F.add_months("train_date", -23 * 12)),
    [t.table("orders").select("o_orderdate"), t.table("lineitem").select("l_shipdate")],
    datetime.date(2001, 7, 1), "Brand#11"))

# ---------------------------------------------------------------- encodings of any size
REGISTRY.add("one_hot_entries", """
SELECT o_orderkey, CAST(index AS BIGINT) AS index FROM orders
JOIN (SELECT key, row_number() OVER (ORDER BY key) - 1 AS index
      FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS key FROM orders)) ON CAST(o_custkey AS VARCHAR) = key
""")(lambda t: prep.one_hot_entries(
    t.table("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer")), "customer", ["o_orderkey"]))

REGISTRY.add("multi_hot_entries", """
WITH items AS (SELECT o_orderkey, unnest(['c' || o_custkey, 'd' || o_orderkey // 3]) AS token FROM orders)
SELECT o_orderkey, CAST(index AS BIGINT) AS index FROM items
JOIN (SELECT token, row_number() OVER (ORDER BY token) - 1 AS index FROM (SELECT DISTINCT token FROM items)) USING (token)
""")(lambda t: prep.multi_hot_entries(
    t.table("orders").select("o_orderkey", F.expr(
        "concat('c', o_custkey, ' | d', o_orderkey DIV 3, '|c', o_custkey)").alias("tokens")), "tokens", ["o_orderkey"]))
