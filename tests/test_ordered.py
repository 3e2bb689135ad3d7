"""Ordered results against brute force, with ties and a value that holds a third of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.operators import metrics, ordered
from featuremart.operators.ordered import exact_quantiles, prefix_sum


@pytest.fixture(params=[20_000, 40, 2])
def ranges(request, monkeypatch):
    """One range, some, and as many as the root of the values: the same search finds a value's range."""
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", request.param)


def skewed(spark, n=3000, seed=1):
    draw = np.random.default_rng(seed)
    value = np.where(np.arange(n) % 3 == 0, 0.25, np.round(draw.random(n), 3))
    label = (draw.random(n) < value).astype(int)
    rows = [(int(i), "g1" if i % 5 else "g2", float(v), int(y)) for i, (v, y) in enumerate(zip(value, label))]
    return rows, spark.createDataFrame(rows, "i int, g string, score double, label int")


def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)


def psi(a, b, buckets=10):
    edges = np.percentile(a, np.linspace(0, 100, buckets + 1))[1:-1]
    ha = np.bincount((a[:, None] >= edges).sum(1), minlength=buckets) / len(a)
    hb = np.bincount((b[:, None] >= edges).sum(1), minlength=buckets) / len(b)
    return float(np.sum((hb - ha) * np.log((hb + 1e-8) / (ha + 1e-8))))


def test_prefix_sum(spark, ranges):
    rows, df = skewed(spark)
    got = {(r["g"], r["score"]): (r["n"], r["cum_n"], r["total_n"])
           for r in prefix_sum(df.withColumn("n", F.lit(1)), "score", ["n"], ["g"]).collect()}
    for g in ("g1", "g2"):
        values = sorted(v for _, k, v, _ in rows if k == g)
        for v in set(values):
            assert got[(g, v)] == (values.count(v), sum(w <= v for w in values), len(values))


@pytest.mark.parametrize("count", [100, 10_000, 250_000])
def test_edges_and_ranges_stay_near_the_root(spark, monkeypatch, count):
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 4)
    distinct = spark.range(count).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    edges = spark.range(1).select(ordered.edge_sketch(distinct, "v", ["n"])["edges"].alias("e")).first()["e"]
    root = count ** 0.5
    assert root / 2 <= len(edges) <= 2 * root and edges == sorted(set(edges))
    assert max(np.diff([0, *edges, count])) <= 20 * root
    out = prefix_sum(distinct, "v", ["n"])
    assert out.agg(F.max("cum_n"), F.count("*")).first() == (count, count)
    # the edges reach expressions as a scalar; no operator passes them on with the rows
    assert all("array<" not in t for _, t in out.dtypes) and "_edges" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_prefix_sum_with_null_group_and_few_values(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 3.0, 5), ("a", 1.0, 1)], "g string, s double, n int")
    got = {(r["g"], r["s"]): r["cum_n"] for r in prefix_sum(df, "s", ["n"], ["g"]).collect()}
    assert got == {(None, 1.0): 2, (None, 3.0): 7, ("a", 1.0): 1}


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0, 3.0, 4.0], [5.0] * 9, [0.0, 0.0, 0.0, 1.0]])
def test_quantiles_of_small_samples(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ps = {"a": 0.1, "b": 0.5, "c": 0.9}
    row = exact_quantiles(df, ["x"], ps).first()
    assert [row[n] for n in ps] == pytest.approx([np.percentile(values, 100 * p) for p in ps.values()])


def test_quantiles_by_group_and_column(spark, ranges):
    rows, df = skewed(spark)
    df = df.withColumn("neg", F.when(F.col("i") % 7 > 0, -F.col("score")))
    got = {(r["g"], r["column"]): r["q"] for r in exact_quantiles(df, ["score", "neg"], {"q": 0.37}, ["g"]).collect()}
    for g in ("g1", "g2"):
        assert got[(g, "score")] == pytest.approx(np.percentile([v for _, k, v, _ in rows if k == g], 37))
        assert got[(g, "neg")] == pytest.approx(np.percentile([-v for i, k, v, _ in rows if k == g and i % 7 > 0], 37))


def test_auc(spark):
    rows, df = skewed(spark)
    want = auc([r[3] for r in rows], [r[2] for r in rows])
    row = metrics.roc_auc(df, "label", "score").first()
    assert row["auc_roc"] == pytest.approx(want) and row["gini"] == pytest.approx(2 * want - 1)
    flipped = metrics.roc_auc(df.withColumn("score", 1 - F.col("score")), "label", "score").first()
    assert flipped["auc_roc"] == pytest.approx(1 - want)
    by_group = {r["g"]: r["auc_roc"] for r in metrics.roc_auc(df, "label", "score", ["g"]).collect()}
    for g, value in by_group.items():
        assert value == pytest.approx(auc([r[3] for r in rows if r[1] == g], [r[2] for r in rows if r[1] == g]))


def test_auc_edges(spark):
    same = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 0)], "score double, label int")
    assert metrics.roc_auc(same, "label", "score").first()["auc_roc"] == 0.5
    assert metrics.roc_auc(same.filter("label = 0"), "label", "score").first()["auc_roc"] is None
    missing = spark.createDataFrame([(None, 1), (0.1, 0)], "score double, label int")
    assert metrics.roc_auc(missing, "label", "score").first()["auc_roc"] == 0.0


def test_ks_and_psi(spark, ranges):
    rows, df = skewed(spark)
    a = np.array([r[2] for r in rows if r[0] < 1000])
    b = np.array([r[2] ** 2 for r in rows if r[0] >= 1000])
    base = df.filter("i < 1000").select("score")
    curr = df.filter("i >= 1000").select((F.col("score") * F.col("score")).alias("score"))
    assert metrics.ks_statistic(base, curr, "score").first()[0] == pytest.approx(ks(a, b))
    assert metrics.psi(base, curr, "score").first()[0] == pytest.approx(psi(a, b))
    assert metrics.ks_statistic(base, base, "score").first()[0] == 0
    assert metrics.psi(base, base, "score").first()[0] == 0
    empty = base.filter("score > 9")
    assert metrics.ks_statistic(empty, curr, "score").first()[0] is None
    assert metrics.psi(empty, curr, "score").first()[0] is None
    assert metrics.psi(base, empty, "score").first()[0] is None


def test_monthly_drift_equals_pairwise(spark):
    _, df = skewed(spark, 1200)
    df = df.select(F.add_months(F.lit("2024-01-01").cast("date"), F.when(F.col("i") % 4 == 3, 4).otherwise(F.col("i") % 4).cast("int"))
                   .alias("snapshot_date"), "score")
    drift = {r["month"].month: r for r in metrics.monthly_drift(df, "score").collect()}
    assert sorted(drift) == [1, 2, 3, 5]
    parts = {m: df.filter(F.month("snapshot_date") == m) for m in drift}
    for m in (2, 3):
        assert drift[m]["psi_stat"] == pytest.approx(metrics.psi(parts[m - 1], parts[m], "score").first()[0])
        assert drift[m]["ks_stat"] == pytest.approx(metrics.ks_statistic(parts[m - 1], parts[m], "score").first()[0])
    for m in (1, 5):  # no month before
        assert drift[m]["psi_stat"] is None and drift[m]["ks_stat"] is None


def test_binary_metrics_edges(spark):
    def run(rows):
        return metrics.binary_metrics(spark.createDataFrame(rows, "label int, default_proba double")).first()

    perfect = run([(0, 0.1), (0, 0.2)])
    assert perfect["f1_macro"] == 1.0 and perfect["precision"] == 0 and perfect["tn"] == 2
    nothing_predicted = run([(1, 0.1), (0, 0.2), (1, None), (0, float("nan"))])
    assert nothing_predicted["precision"] == 0 and nothing_predicted["fn"] == 2 and nothing_predicted["tn"] == 2
    mixed = run([(1, 0.9), (1, 0.5), (0, 0.7), (0, 0.1), (1, 0.2)])
    assert (mixed["tp"], mixed["fp"], mixed["tn"], mixed["fn"]) == (2, 1, 1, 1)
    f1, f0 = 4 / 6, 2 / 4
    assert mixed["f1_macro"] == pytest.approx((f1 + f0) / 2)
    assert mixed["f1_weighted"] == pytest.approx((3 * f1 + 2 * f0) / 5)


def test_many_values_and_no_subquery_reuse(spark):
    """Ranges are the same in every part of the plan even when nothing is shared."""
    n = 60000
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), 1000003) / 7.0).alias("s"), F.lit(1).alias("n"))
    values = np.sort([r["s"] for r in df.collect()])
    for key in ("spark.sql.execution.reuseSubquery", "spark.sql.exchange.reuse"):
        spark.conf.set(key, "false")
    try:
        got = {r["s"]: (r["cum_n"], r["total_n"]) for r in prefix_sum(df, "s", ["n"]).collect()}
    finally:
        for key in ("spark.sql.execution.reuseSubquery", "spark.sql.exchange.reuse"):
            spark.conf.unset(key)
    distinct, last = np.unique(values, return_index=False), np.searchsorted(values, np.unique(values), side="right")
    assert got == {v: (int(k), n) for v, k in zip(distinct, last)}
