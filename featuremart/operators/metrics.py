"""Classification, ranking and drift metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions.numeric import clean_score, decide
from featuremart.functions.text import _col
from featuremart.operators.ordered import passed_edges, prefix_sum, quantiles_of_counts
from featuremart.session import materialise


def _ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def binary_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "default_proba",
    groups: Sequence[str] = (),
    threshold: float = fixed.DECISION_THRESHOLD,
) -> DataFrame:
    """Confusion counts and derived rates; a missing score counts as 0.

    Macro averages run over the classes present in labels or decisions; empty
    denominators give 0.
    """
    return _rates(df, label, score, groups, threshold, F.lit(1))


def _rates(
    df: DataFrame, label: str, score: str, groups: Sequence[str], threshold: float, n: Column
) -> DataFrame:
    """The same from rows that stand for ``n`` rows each."""
    truth = _col(label).cast("int")
    hit = decide(F.coalesce(clean_score(score), F.lit(0.0)), threshold)

    def rows_with(true: int, decided: int) -> Column:
        return F.coalesce(F.sum(F.when((truth == true) & (hit == decided), n)), F.lit(0)).cast("bigint")

    counts = df.groupBy(*groups).agg(
        rows_with(1, 1).alias("tp"),
        rows_with(0, 0).alias("tn"),
        rows_with(0, 1).alias("fp"),
        rows_with(1, 0).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    rows = tp + tn + fp + fn
    wrong = fp + fn
    recall_1, recall_0 = _ratio_or_zero(tp, tp + fn), _ratio_or_zero(tn, tn + fp)
    precision_1, precision_0 = _ratio_or_zero(tp, tp + fp), _ratio_or_zero(tn, tn + fn)
    f1_1, f1_0 = _ratio_or_zero(2 * tp, 2 * tp + wrong), _ratio_or_zero(2 * tn, 2 * tn + wrong)
    classes = F.when(tp + wrong > 0, 1).otherwise(0) + F.when(tn + wrong > 0, 1).otherwise(0)
    return counts.select(
        *groups, "tp", "tn", "fp", "fn",
        _ratio_or_zero(tp + tn, rows).alias("accuracy"),
        precision_1.alias("precision"),
        recall_1.alias("recall"),
        _ratio_or_zero(precision_1 + precision_0, classes).alias("precision_macro"),
        _ratio_or_zero(recall_1 + recall_0, classes).alias("recall_macro"),
        _ratio_or_zero(f1_1 + f1_0, classes).alias("f1_macro"),
        _ratio_or_zero(f1_1 * (tp + fn) + f1_0 * (tn + fp), rows).alias("f1_weighted"),
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "default_proba", groups: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve, ties at half credit, and Gini; NULL with one class only."""
    rows = df.select(
        *groups,
        F.coalesce(clean_score(score), F.lit(0.0)).alias("_score"),
        F.when(_col(label).cast("int") == 1, 1).otherwise(0).cast("bigint").alias("pos"),
        F.when(_col(label).cast("int") == 0, 1).otherwise(0).cast("bigint").alias("neg"),
    )
    return _area(rows, groups)


def _area(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """AUC and Gini from rows ``groups, _score, pos, neg`` with counts of both labels."""
    ranked = prefix_sum(rows, "_score", ["pos", "neg"], groups)
    below = F.col("cum_neg") - F.col("neg")
    wins = F.col("pos").cast("double") * (below + F.col("neg") / 2)
    area = F.try_divide(
        F.sum(wins), F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    )
    return ranked.groupBy(*groups).agg(area.alias("auc_roc")).select(
        "*", (2 * F.col("auc_roc") - 1).alias("gini")
    )


def _both_sides(base: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """Non-missing scores of two samples with one counter column per sample."""

    def side(df: DataFrame, b: int, c: int) -> DataFrame:
        return df.select(
            clean_score(score).alias("_score"),
            F.lit(b).cast("bigint").alias("base"),
            F.lit(c).cast("bigint").alias("curr"),
        ).filter(F.col("_score").isNotNull())

    return side(base, 1, 0).unionByName(side(current, 0, 1))


def _largest_gap(counted: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    ranked = prefix_sum(counted, "_score", ["base", "curr"], groups)
    gap = F.abs(
        F.try_divide(F.col("cum_base"), F.col("total_base"))
        - F.try_divide(F.col("cum_curr"), F.col("total_curr"))
    )
    return ranked.groupBy(*groups).agg(F.max(gap).alias("ks_stat"))


def ks_statistic(base: DataFrame, current: DataFrame, score: str = "default_proba") -> DataFrame:
    """Largest distance of the two score distributions; NULL when a sample is empty."""
    return _largest_gap(_both_sides(base, current, score))


def _index_sum(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Stability index from base and current counts per bucket; an absent bucket adds nothing."""
    everything = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    eps = F.lit(fixed.PSI_EPSILON)
    share_b = F.try_divide("base", F.sum("base").over(everything))
    share_c = F.try_divide("curr", F.sum("curr").over(everything))
    shares = counts.select(*groups, share_b.alias("b"), share_c.alias("c"))
    term = (F.col("c") - F.col("b")) * F.ln((F.col("c") + eps) / (F.col("b") + eps))
    return shares.groupBy(*groups).agg(F.sum(term).alias("psi_stat"))


def _inner_edges(buckets: int) -> dict[str, float]:
    return {f"q{k}": k / buckets for k in range(1, buckets)}


def psi(
    base: DataFrame,
    current: DataFrame,
    score: str = "default_proba",
    buckets: int = fixed.PSI_BUCKETS,
) -> DataFrame:
    """Population stability index over quantile buckets of the base sample.

    The edges are exact quantiles; repeated edges leave a bucket empty.  NULL when a
    sample has no scores.
    """
    names = _inner_edges(buckets)
    counted = _both_sides(base, current, score).groupBy("_score").agg(
        F.sum("base").alias("base"), F.sum("curr").alias("curr"))
    of_base = counted.filter(F.col("base") > 0).select(F.col("_score").alias("value"), F.col("base").alias("n"))
    edges = quantiles_of_counts(of_base, names).select(F.array(*names).alias("e")).scalar()
    placed = counted.select("*", edges.alias("_edges")).select(
        "base", "curr", passed_edges(F.col("_edges"), buckets - 1, F.col("_score")).alias("bucket")
    )
    return _index_sum(placed.groupBy("bucket").agg(F.sum("base").alias("base"), F.sum("curr").alias("curr")))


def monthly_drift(
    predictions: DataFrame,
    score: str = "default_proba",
    month: str = "snapshot_date",
    buckets: int = fixed.PSI_BUCKETS,
    groups: Sequence[str] = (),
) -> DataFrame:
    """PSI and KS of every month against the month before, per group, all months in one job.

    Rows are counted per month and score once; each count then serves as the current
    sample of its month and as the base sample of the next.
    """
    counted = (
        predictions.select(*groups, F.trunc(month, "month").alias("month"), clean_score(score).alias("_score"))
        .filter(F.col("month").isNotNull() & F.col("_score").isNotNull())
        .groupBy(*groups, "month", "_score")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _drift_of_counts(counted, buckets, list(groups))


def _drift_of_counts(counted: DataFrame, buckets: int, groups: list[str]) -> DataFrame:
    """Drift from rows ``groups, month, _score, n``."""
    keys = [*groups, "month"]
    sides = F.array(
        F.struct(F.col("month").alias("month"), F.lit(0).cast("bigint").alias("base"), F.col("n").alias("curr")),
        F.struct(F.add_months("month", 1).alias("month"), F.col("n").alias("base"), F.lit(0).cast("bigint").alias("curr")),
    )
    paired = counted.select(*groups, "_score", F.inline(sides))
    # edges of the month before; one short array per calendar month
    names = _inner_edges(buckets)
    by_month = (
        quantiles_of_counts(counted.withColumnRenamed("_score", "value"), names, keys)
        .agg(F.map_from_entries(F.collect_list(
            F.struct(F.struct(*groups, F.add_months("month", 1).alias("month")), F.array(*names)))).alias("m"))
        .scalar()
    )
    placed = paired.select("*", by_month.alias("_all")).select(
        *keys, "base", "curr", F.try_element_at("_all", F.struct(*keys)).alias("_edges"), "_score"
    ).select(*keys, "base", "curr", passed_edges(F.col("_edges"), buckets - 1, F.col("_score")).alias("bucket"))
    by_bucket = placed.groupBy(*keys, "bucket").agg(F.sum("base").alias("base"), F.sum("curr").alias("curr"))
    # one row per group and month from here on
    stability = _index_sum(by_bucket, keys).select(F.struct(*keys).alias("_key"), "psi_stat")
    distance = _largest_gap(paired, keys).select(F.struct(*keys).alias("_key"), "ks_stat")
    sizes = by_bucket.groupBy(*keys).agg(F.sum("curr").alias("sample_size")).filter(F.col("sample_size") > 0)
    return (
        sizes.select("*", F.struct(*keys).alias("_key"))
        .join(stability, "_key", "left").join(distance, "_key", "left").drop("_key").orderBy("month", *groups)
    )


def score_summary(df: DataFrame, score: str = "default_proba", groups: Sequence[str] = ()) -> DataFrame:
    """Size, range, mean and sample deviation of the usable scores."""
    value = clean_score(score)
    return df.groupBy(*groups).agg(
        F.count(value).alias("sample_size"),
        F.min(value).alias("default_proba_min"),
        F.max(value).alias("default_proba_max"),
        F.avg(value).alias("default_proba_mean"),
        F.stddev_samp(value).alias("default_proba_std"),
    )


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Sample size and label share per split and label."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("rows"))
    size = F.sum("rows").over(W.partitionBy(split))
    return counts.select(split, label, "rows", size.alias("sample_size"), (F.col("rows") / size).alias("label_ratio"))


def evaluate_splits(
    df: DataFrame,
    split: str = "split",
    label: str = "label",
    score: str = "default_proba",
    threshold: float = fixed.DECISION_THRESHOLD,
) -> DataFrame:
    """All metrics per split in one grouped evaluation."""
    return roc_auc(df, label, score, [split]).join(
        binary_metrics(df, label, score, [split], threshold), split
    )


def monitor(
    predictions: DataFrame,
    labels: DataFrame,
    score: str = "default_proba",
    threshold: float = fixed.DECISION_THRESHOLD,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Monthly monitoring table: quality on labelled rows, score summary and drift.

    Model versions are kept apart: ``groups`` is ``model_version`` where predictions have
    it.  Predictions and labelled rows are counted per month and score once and written;
    quality, summary and drift come from those counts.
    """
    if groups is None:
        groups = [c for c in ("model_version",) if c in predictions.columns]
    return monitor_of_counts(*[
        materialise(counts, name) for counts, name in zip(
            score_counts(predictions, labels, score, groups), ("scores", "labelled-scores"), strict=True)
    ], threshold, groups)


def score_counts(
    predictions: DataFrame, labels: DataFrame, score: str = "default_proba", groups: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(groups, month, _score, n) of all predictions and (.., label, n) of the labelled ones."""
    keys = [*groups, "month"]
    month = F.trunc("snapshot_date", "month").alias("month")
    rows = predictions.select(*groups, "Customer_ID", "snapshot_date", month, clean_score(score).alias("_score"))
    labelled = rows.join(labels.select("Customer_ID", "snapshot_date", "label"), ["Customer_ID", "snapshot_date"])
    return (rows.groupBy(*keys, "_score").agg(F.count(F.lit(1)).alias("n")),
            labelled.groupBy(*keys, "_score", "label").agg(F.count(F.lit(1)).alias("n")))


def monitor_of_counts(
    counted: DataFrame, judged: DataFrame, threshold: float = fixed.DECISION_THRESHOLD, groups: Sequence[str] = ()
) -> DataFrame:
    """The monitoring table from the two kinds of counts."""
    groups = list(groups)
    keys = [*groups, "month"]
    ranked = judged.select(
        *keys, F.coalesce("_score", F.lit(0.0)).alias("_score"),
        F.when(F.col("label").cast("int") == 1, F.col("n")).otherwise(0).alias("pos"),
        F.when(F.col("label").cast("int") == 0, F.col("n")).otherwise(0).alias("neg"),
    )
    parts = [
        _rates(judged.select(*keys, "_score", "label", "n"), "label", "_score", keys, threshold, F.col("n")),
        _area(ranked, keys),
        _summary_of_counts(counted, keys),
    ]
    usable = counted.filter(F.col("month").isNotNull() & F.col("_score").isNotNull())
    drift = _drift_of_counts(usable, fixed.PSI_BUCKETS, groups).drop("sample_size")
    joined, *others = [p.select(F.struct(*keys).alias("_key"), *[c for c in p.columns if c not in keys])
                       for p in [*parts, drift]]
    for other in others[:-1]:
        joined = joined.join(other, "_key")
    return joined.join(others[-1], "_key", "left").select("_key.*", *[
        c for p in [*parts, drift] for c in p.columns if c not in keys]).orderBy("month", *groups)


def _summary_of_counts(counted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Score summary from rows ``groups, _score, n``; the deviation about the group's own mean."""
    n = F.when(F.col("_score").isNotNull(), F.col("n")).otherwise(0)
    every = W.partitionBy(*groups)
    mean = F.try_divide(F.sum(F.col("_score") * F.col("n")).over(every), F.sum(n).over(every))
    square = F.pow(F.col("_score") - F.col("_mean"), 2) * F.col("n")
    return counted.select("*", mean.alias("_mean")).groupBy(*groups).agg(
        F.sum(n).alias("sample_size"),
        F.min("_score").alias("default_proba_min"),
        F.max("_score").alias("default_proba_max"),
        F.max("_mean").alias("default_proba_mean"),
        F.sqrt(F.try_divide(F.sum(square), F.sum(n) - 1)).alias("default_proba_std"),
    )


def drift_band(value: Column | str) -> Column:
    """Name of the stability band; the middle band is closed on both sides."""
    psi_value = _col(value)
    (calm, _, low), (watch, _, high), (alarm, _, _) = fixed.PSI_BANDS
    return F.when(psi_value < low, calm).when(psi_value <= high, watch).when(psi_value > high, alarm)


def monitoring_overview(monthly: DataFrame, metrics: Sequence[str] = tuple(fixed.MONITORING_METRICS)) -> DataFrame:
    """Months covered, first and last month, and the mean of each metric that is there."""
    present = [m for m in metrics if m in monthly.columns]
    return monthly.agg(
        F.count_distinct("month").alias("coverage_months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        *[F.avg(F.col(m).try_cast("double")).alias(f"avg_{m}") for m in present],
    )
