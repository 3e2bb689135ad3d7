"""Point-in-time joins, feature merging and latest-row selection.

A feature row may be used for a label only if its snapshot lies before the label's
cutoff, ``add_months(label_date, 1 - months_on_book)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from featuremart.functions.dates import feature_cutoff
from featuremart.operators.schema import expect_columns

KEY = "Customer_ID"
LABEL_DATE = "label_snapshot_date"
SOURCE_DATE = "snapshot_date"


def label_batch(labels: DataFrame) -> DataFrame:
    """Labels with their date under the name the feature tables use."""
    return expect_columns(labels, [KEY, SOURCE_DATE]).withColumnRenamed(SOURCE_DATE, LABEL_DATE)


def before_last_cutoff(source: DataFrame, labels: DataFrame, months_on_book: int) -> DataFrame:
    """Drop source snapshots no label of the batch can use.

    The bound is a scalar subquery on the labels, so on a table partitioned by snapshot
    date whole partitions are skipped when the query runs.
    """
    last = labels.agg(F.max(feature_cutoff(LABEL_DATE, months_on_book)).alias("cutoff")).scalar()
    return source.filter(F.col(SOURCE_DATE) < last)


def point_in_time_join(
    labels: DataFrame,
    source: DataFrame,
    months_on_book: int,
    columns: Sequence[str],
    date_as: str,
) -> DataFrame:
    """Every source row before the cutoff of every label row of the same customer.

    The range test is part of the join condition.  No side is forced to be broadcast:
    adaptive execution does so from measured sizes and otherwise splits skewed keys.
    """
    rows = before_last_cutoff(source, labels, months_on_book).select(KEY, SOURCE_DATE, *columns)
    batch = labels.select(KEY, LABEL_DATE)
    usable = F.col(SOURCE_DATE) < feature_cutoff(LABEL_DATE, months_on_book)
    return (
        rows.join(batch, KEY)
        .filter(usable)
        .select(KEY, LABEL_DATE, *columns, F.col(SOURCE_DATE).alias(date_as))
    )


@dataclass(frozen=True)
class Latest:
    """Take the newest row of ``source`` before the cutoff.

    ``make`` turns rows of ``source`` into rows with ``columns``, row by row, and leaves
    customer and date as they are; it runs on the rows of the days that are taken alone.
    """

    source: DataFrame
    columns: Sequence[str]
    date_as: str
    make: Callable[[DataFrame], DataFrame] | None = None


@dataclass(frozen=True)
class Mean:
    """Take the mean of ``features`` over all rows of ``source`` before the cutoff."""

    source: DataFrame
    features: Sequence[str]
    digits: int = 2


def point_in_time_features(
    labels: DataFrame, months_on_book: int, parts: Sequence[Latest | Mean]
) -> DataFrame:
    """Features of several sources per customer and label date, without label-by-row pairs.

    Per source the days that have rows form one ordered sequence per customer with the
    label cutoffs, and only what a label can see goes on: of ``Latest`` the rows of the
    newest day before a cutoff, of ``Mean`` the sums up to a cutoff.  So rows that no
    label takes are neither made nor sorted, what is carried forward to the labels has
    no more rows than there are cutoffs per source, and the sequence of one customer is
    bounded by the number of snapshots, however many raw rows the customer has.  On equal
    days the label comes first, so a row exactly at the cutoff is not seen.  A label
    without usable rows in every source is left out.
    """
    # a row without a customer belongs to nobody: it never matches
    wanted = labels.select(KEY, LABEL_DATE).filter(F.col(KEY).isNotNull()).distinct().select(
        "*", feature_cutoff(LABEL_DATE, months_on_book).alias("_day"), F.lit(0).alias("_kind")
    )
    order = W.partitionBy(KEY).orderBy("_day", "_kind").rowsBetween(W.unboundedPreceding, 0)
    sequence, carried, found, output = wanted, [], F.col(LABEL_DATE).isNotNull(), []
    for i, part in enumerate(parts):
        usable = before_last_cutoff(part.source, labels, months_on_book).filter(F.col(KEY).isNotNull())
        seen = (_newest_before if isinstance(part, Latest) else _means_before)(wanted, usable, part)
        row = f"_row{i}"
        sequence = sequence.unionByName(seen.withColumnRenamed("_row", row), allowMissingColumns=True)
        carried.append(F.last(row, ignorenulls=True).over(order).alias(row))
        found = found & F.col(row).isNotNull()
        output.append(F.col(f"{row}.*"))
    return sequence.select(KEY, LABEL_DATE, *carried).filter(found).select(KEY, LABEL_DATE, *output)


def _with_cutoffs(wanted: DataFrame, days: DataFrame) -> DataFrame:
    """Days with rows (``_kind`` 1) and cutoffs (``_kind`` 0) of each customer."""
    events = days.withColumnRenamed(SOURCE_DATE, "_day").withColumn("_kind", F.lit(1))
    return wanted.select(KEY, "_day", "_kind").unionByName(events, allowMissingColumns=True)


def _backwards() -> WindowSpec:
    """From the last day to the first, so that what precedes a row is later; a row at the cutoff precedes it."""
    return W.partitionBy(KEY).orderBy(F.desc("_day"), F.desc("_kind"))


def _newest_before(wanted: DataFrame, usable: DataFrame, part: Latest) -> DataFrame:
    """The rows that are the newest before some cutoff; they take effect after their day.

    The days are found on keys alone.  They have one narrow row each and at most one per
    cutoff, so their side of the semi-join is hashed and the wide rows need no sort.
    """
    days = usable.select(KEY, SOURCE_DATE).distinct()
    newest = (
        _with_cutoffs(wanted, days)
        .select("*", F.lag("_kind").over(_backwards()).alias("_follower"))
        .filter((F.col("_kind") == 1) & (F.col("_follower") == 0))
        .select(KEY, F.col("_day").alias(SOURCE_DATE))
    )
    taken = usable.join(newest.hint("shuffle_hash"), [KEY, SOURCE_DATE], "left_semi")
    rows = part.make(taken) if part.make else taken
    return latest_per_key(rows.select(KEY, SOURCE_DATE, *part.columns), [KEY, SOURCE_DATE], []).select(
        KEY, F.col(SOURCE_DATE).alias("_day"), F.lit(1).alias("_kind"),
        F.struct(*part.columns, F.col(SOURCE_DATE).alias(part.date_as)).alias("_row"),
    )


def _means_before(wanted: DataFrame, usable: DataFrame, part: Mean) -> DataFrame:
    """Means over all rows before a cutoff, for each cutoff with rows since the one before it.

    They take effect at the cutoff.  Rows are added up by their next cutoff before the
    running sums, which so have no more rows than there are cutoffs.
    """
    expect_columns(part.source, [KEY, SOURCE_DATE, *part.features])
    names = [(f"_sum_{f}", F.sum, f) for f in part.features] + [(f"_count_{f}", F.count, f) for f in part.features]
    per_day = usable.groupBy(KEY, SOURCE_DATE).agg(*[add(f).alias(n) for n, add, f in names]).select(
        KEY, SOURCE_DATE, F.struct(*[n for n, _, _ in names]).alias("_row")
    )
    cutoff = F.last(F.when(F.col("_kind") == 0, F.col("_day")), ignorenulls=True)
    by_cutoff = (
        _with_cutoffs(wanted, per_day)
        .select("*", cutoff.over(_backwards().rowsBetween(W.unboundedPreceding, 0)).alias("_cutoff"))
        .filter((F.col("_kind") == 1) & F.col("_cutoff").isNotNull())
        .groupBy(KEY, "_cutoff")
        .agg(*[F.sum(f"_row.{n}").alias(n) for n, _, _ in names])
    )
    order = W.partitionBy(KEY).orderBy("_cutoff").rowsBetween(W.unboundedPreceding, 0)
    running = by_cutoff.select(KEY, "_cutoff", *[F.sum(n).over(order).alias(n) for n, _, _ in names])
    means = [
        F.round(F.try_divide(F.col(f"_sum_{f}").cast("double"), F.col(f"_count_{f}")), part.digits).alias(f"{f}_mean")
        for f in part.features
    ]
    return running.select(
        KEY, F.col("_cutoff").alias("_day"), F.lit(-1).alias("_kind"), F.struct(*means).alias("_row")
    )


def as_of_latest(
    labels: DataFrame,
    source: DataFrame,
    months_on_book: int,
    columns: Sequence[str],
    date_as: str,
    make: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Newest source row before the cutoff: the point-in-time join, then the latest row."""
    return point_in_time_features(labels, months_on_book, [Latest(source, columns, date_as, make)])


def pit_mean_features(
    labels: DataFrame, source: DataFrame, months_on_book: int, features: Sequence[str], digits: int = 2
) -> DataFrame:
    """Rounded mean of each feature over all rows before the cutoff."""
    return point_in_time_features(labels, months_on_book, [Mean(source, features, digits)])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    strategy: str = "latest",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the newest by the given columns, NULL dates last.

    Ties are settled by the columns ``ties``, by default all that remain, so the result
    is the same on every run; name a few that tell rows apart to sort by less.
    Spark keeps one candidate per key and map task before the shuffle, which makes keys
    with very many rows harmless.
    """
    if strategy == "none":
        return df
    if strategy != "latest":
        raise ValueError("strategy must be 'latest' or 'none'")
    rest = [c for c in df.columns if c not in keys and c not in newest_first] if ties is None else list(ties)
    ordering = [F.col(c).desc_nulls_last() for c in newest_first]
    ordering += [F.col(c).asc_nulls_last() for c in rest] or [F.lit(1)]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering))
    return df.select("*", rank.alias("_rank")).filter(F.col("_rank") == 1).drop("_rank")


def merge_features(frames: Sequence[DataFrame], on: Sequence[str] = (KEY, LABEL_DATE)) -> DataFrame:
    """Inner join of feature frames on shared keys; column names must not clash otherwise."""
    return reduce(lambda left, right: left.join(right, list(on), "inner"), frames)


def training_table(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with loan and label of the same customer and label date."""
    expect_columns(features, [KEY, LABEL_DATE])
    expect_columns(labels, [KEY, SOURCE_DATE, "label", "label_def", "loan_id"])
    return features.join(
        label_batch(labels).select(KEY, LABEL_DATE, "loan_id", "label", "label_def"), [KEY, LABEL_DATE]
    )


def label_left_features(
    labels: DataFrame, features: DataFrame, on: Sequence[str] = (KEY, SOURCE_DATE)
) -> DataFrame:
    """All labels, with features of the same customer and date where there are any."""
    return labels.join(features, list(on), "left")
