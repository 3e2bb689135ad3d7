"""Profiles and audits, each in a fixed number of passes however many columns there are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featuremart.functions.dates import feature_cutoff
from featuremart.functions.numeric import clean_score
from featuremart.functions.text import _col
from featuremart.operators.ordered import column_stats, exact_quantiles, unpivot_numbers
from featuremart.operators.schema import numeric_columns


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column with their share, highest share first, from one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("position"),
            (F.col("rows") - F.col(f"c{i}")).alias("null_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    rate = F.round(F.try_divide("null_count", "rows"), 4)
    return (
        counted.select("rows", F.inline(F.array(*entries)))
        .select("column", "null_count", rate.alias("null_rate"), "position")
        .orderBy(F.desc("null_rate"), "position")
        .drop("position")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """Keys with several rows; ``at_least=1`` gives the row count of every key."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") >= at_least)
        .orderBy(F.desc("rows"), *keys)
    )


def duplicate_row_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """Most frequent values; equal counts in value order."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_last("value"))
        .limit(top)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def non_numeric_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank texts that are not numbers."""
    text = F.col(column)
    return df.filter((F.trim(text) != "") & text.try_cast("double").isNull()).select(column).distinct()


def describe_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, one row per column."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    moments = column_stats(
        df, columns, count=F.count, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max
    )
    return moments.join(quartiles.drop("n"), "column").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq per text column; the smallest of equally frequent values.

    Values are counted first, so one very frequent value costs no more than a rare one.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("top"),
        F.max("n").alias("freq"),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows for which each named condition holds, all rules in one pass."""
    counted = df.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def sanity_rules(
    interest: str = "Interest_Rate",
    utilisation: str = "Credit_Utilization_Ratio",
    max_interest: float = 100,
    max_utilisation: float = 1,
) -> dict[str, Column]:
    return {
        f"{interest}>{max_interest:g}": F.col(interest) > max_interest,
        f"{utilisation}>{max_utilisation:g}": F.col(utilisation) > max_utilisation,
        f"{utilisation}<0": F.col(utilisation) < 0,
    }


def leakage_audit(
    features: DataFrame,
    months_on_book: int,
    expected_date: date | None = None,
    label_date: str = "label_snapshot_date",
    suffix: str = "_snapshot_date",
) -> DataFrame:
    """Rows whose source date is not before the cutoff, per source, plus misdated labels."""
    cutoff = feature_cutoff(label_date, months_on_book)
    sources = [c for c in features.columns if c.endswith(suffix) and c != label_date]
    rules = {c.removesuffix(suffix): F.col(c) >= cutoff for c in sources}
    if expected_date is not None:
        rules["misaligned"] = F.col(label_date) != F.lit(expected_date)
    return rule_violations(features, rules)


def bad_rate_curve(
    loans: DataFrame, dpd: int = 30, started_before: date | None = None, age: str = "mob"
) -> DataFrame:
    """Share of rows at least ``dpd`` days past due by months on book."""
    if started_before is not None:
        loans = loans.filter(F.col("loan_start_date") < F.lit(started_before))
    bad = F.when(F.col("dpd") >= dpd, 1).otherwise(0)
    return (
        loans.groupBy(age)
        .agg(F.avg(bad).alias("bad_rate"), F.count(F.lit(1)).alias("loans"))
        .orderBy(age)
    )


def loans_at_age(loans: DataFrame, instalment: int, started_before: date, dpd: int = 30) -> DataFrame:
    """Loans of completed cohorts at one instalment, flagged bad or not."""
    return loans.filter(
        (F.col("loan_start_date") < F.lit(started_before)) & (F.col("installment_num") == instalment)
    ).select("*", F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("dpd_flag"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum, top edge closed, empty bins included."""
    columns = list(columns)
    numbers = unpivot_numbers(df, columns)
    # a constant column gets one unit of width around its value
    bounds = (
        column_stats(df, columns, low=F.min, high=F.max)
        .filter(F.col("low").isNotNull())
        .select(
            "column",
            F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(F.col("low") == F.col("high"), F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )
    by_column = bounds.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("low", "high")))).alias("m")
    ).scalar()
    placed = numbers.select("column", "value", by_column[F.col("column")].alias("b")).select(
        "column",
        F.least(
            F.floor((F.col("value") - F.col("b.low")) / (F.col("b.high") - F.col("b.low")) * bins),
            F.lit(bins - 1),
        ).cast("int").alias("bin"),
    )
    counts = placed.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("rows"))
    every_bin = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("high") - F.col("low")) / bins
    return every_bin.join(counts, ["column", "bin"], "left").select(
        "column", "bin",
        (F.col("low") + width * F.col("bin")).alias("bin_start"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
    )


def mean_all_numeric(df: DataFrame, keys: Sequence[str], digits: int = 2) -> DataFrame:
    """Rounded mean of every numeric column per key."""
    return df.groupBy(*keys).agg(
        *[F.round(F.avg(c), digits).alias(c) for c in numeric_columns(df, keys)]
    )


def score_by_snapshot(
    predictions: DataFrame, score: str = "default_proba", snapshot: str = "snapshot_date"
) -> DataFrame:
    """Mean and quartiles of the score per snapshot."""
    quartiles = exact_quantiles(predictions, [score], {"p25": 0.25, "p50": 0.5, "p75": 0.75}, [snapshot])
    usable = clean_score(score)
    means = predictions.groupBy(snapshot).agg(
        F.count(usable).alias("scored"), F.avg(usable).alias("score_mean")
    )
    return means.join(quartiles.drop("column", "n"), snapshot, "left").orderBy(snapshot)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, for display."""
    return df.limit(n)


def tail_by(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows in the given order, NULL last, shown in that order."""
    last = df.orderBy(*[F.desc_nulls_first(c) for c in order]).limit(n)
    return last.orderBy(*[F.asc_nulls_last(c) for c in order])


def rolling_mean(
    df: DataFrame, order: str, columns: Sequence[str], rows: int = 3, groups: Sequence[str] = ()
) -> DataFrame:
    """Mean over the last ``rows`` months for tables with one row per month (and group).

    Rows are reduced to months first, so that the ordered part never holds more than the
    calendar; rows of one month share the mean of their month's means.
    """
    keys = [*groups, order]
    monthly = df.groupBy(*keys).agg(*[F.avg(_col(c)).alias(f"_{c}") for c in columns])
    recent = W.partitionBy(*groups).orderBy(order).rowsBetween(1 - rows, 0)
    rolled = monthly.select(
        F.struct(*keys).alias("_month"), *[F.avg(f"_{c}").over(recent).alias(f"{c}_rolling") for c in columns])
    # a struct as key also compares NULL months and groups as equal
    return df.select("*", F.struct(*keys).alias("_month")).join(rolled, "_month").drop("_month")
