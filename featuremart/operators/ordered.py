"""Order-dependent results without a global sort in one task.

A window over a whole table runs in a single task.  Here rows are first reduced to one
row per distinct value, the values are cut into balanced ranges, and every range is
summed on its own; only one total per range is combined globally.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Distinct values in a range, on average, at least; the number of ranges grows with the data.
VALUES_PER_RANGE = 20_000
#: The search for a value's range doubles its reach so often: up to 2**24 ranges.
SEARCH_STEPS = 24


def passed_edges(edges: Column, count: int, value: Column) -> Column:
    """Number of ``count`` sorted edges, a fixed handful, that are <= value."""
    passed = F.lit(0)
    for i in range(count):
        passed = passed + F.when(F.get(edges, i) <= value, 1).otherwise(0)
    return passed


def range_index(edges: Column, value: Column) -> Column:
    """Number of sorted edges, of any number, that are <= value, found by halving in a built-in fold."""
    steps = [1 << k for k in reversed(range(SEARCH_STEPS))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(F.get(edges, low + step - 1) <= value, low + step).otherwise(low),
    )
    # never NULL, so a join on it adds no filter below the aggregate
    return F.coalesce(found, F.lit(0))


def edge_sketch(distinct: DataFrame, order_by: str, values: Sequence[str]) -> Column:
    """Scalar struct whose ``edges`` cut the different values of a column into balanced ranges.

    Edges are the values that a hash picks, one in so many: the same whenever they are
    computed.  That many is the root of the number of values once this exceeds
    VALUES_PER_RANGE, so that neither the edges, which one task collects, nor a range
    outgrow the root.  Edges only decide how even the ranges are.
    """
    # summing the values too lets both subqueries read the shuffle of the main plan instead of the input
    kept = [F.sum(v).alias(v) for v in values]
    sizes = distinct.agg(F.struct(F.count("*").alias("rows"), *kept).alias("sizes")).scalar()
    every = F.greatest(F.lit(VALUES_PER_RANGE), F.ceil(F.sqrt(sizes["rows"])))
    chosen = F.pmod(F.xxhash64(order_by), every) == 0
    edges = F.array_sort(F.array_distinct(F.collect_list("_edge")))
    return distinct.select("*", F.when(chosen, F.col(order_by)).alias("_edge")).agg(
        F.struct(edges.alias("edges"), *kept).alias("sketch")).scalar()


def prefix_sum(
    df: DataFrame, order_by: str, values: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Running and total sums per group in the order of a numeric column.

    Returns one row per group and distinct ``order_by`` value with, for each value
    column ``v``: ``v`` (sum at this value), ``cum_v`` (sum up to and including it) and
    ``total_v``.  NULL order values must be filtered before.
    """
    groups = list(groups)
    distinct = df.groupBy(*groups, order_by).agg(*[F.sum(v).alias(v) for v in values])
    sketch = edge_sketch(distinct, order_by, values)
    # One key for window and join: the rows stay where the window put them.  A struct also
    # compares NULL groups as equal.
    ranged = (
        distinct.select("*", sketch["edges"].alias("_edges"))
        .select(
            *groups, order_by, *values,
            range_index(F.col("_edges"), F.col(order_by)).alias("_range"),
        )
        .select("*", F.struct(*groups, "_range").alias("_key"))
    )
    by_range = W.partitionBy(*groups).orderBy("_range")
    offsets = (
        ranged.groupBy(*groups, "_range")
        .agg(*[F.sum(v).alias(f"_r_{v}") for v in values])
        .select(
            F.struct(*groups, "_range").alias("_key"),
            *[
                F.coalesce(
                    F.sum(f"_r_{v}").over(by_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
                ).alias(f"_before_{v}")
                for v in values
            ],
            *[F.sum(f"_r_{v}").over(W.partitionBy(*groups)).alias(f"total_{v}") for v in values],
        )
    )
    inside = W.partitionBy("_key").orderBy(order_by).rowsBetween(W.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(v).over(inside).alias(f"_local_{v}") for v in values])
    return local.join(offsets, "_key").select(
        *groups, order_by, *values,
        *[(F.col(f"_local_{v}") + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in values],
        *[f"total_{v}" for v in values],
    )


def unpivot_numbers(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Long form ``groups, column, value`` of numeric columns without NULL and NaN."""
    groups = list(groups)
    wide = df.select(*groups, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    long = wide.unpivot(groups, list(columns), "column", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def column_stats(df: DataFrame, columns: Sequence[str], **stats: Callable[[Column], Column]) -> DataFrame:
    """Named aggregates of several numeric columns, one row per column, from one wide aggregate."""

    def usable(c: str) -> Column:
        value = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(value), value)

    row = df.agg(
        *[F.struct(*[f(usable(c)).alias(n) for n, f in stats.items()]).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}.{n}").alias(n) for n in stats])
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Exact linearly interpolated quantiles of several columns, optionally per group.

    ``probabilities`` maps result names to probabilities.  One row per group and column:
    ``groups, column, n`` and one double per name.
    """
    groups = list(groups)
    counted = unpivot_numbers(df, columns, groups).select("*", F.lit(1).cast("bigint").alias("n"))
    return quantiles_of_counts(counted, probabilities, [*groups, "column"])


def quantiles_of_counts(
    counted: DataFrame, probabilities: dict[str, float], groups: Sequence[str] = ()
) -> DataFrame:
    """The same from rows ``groups, value, n`` that say how often each value occurs."""
    groups = list(groups)
    ranked = prefix_sum(counted, "value", ["n"], groups)
    first, behind, total = F.col("cum_n") - F.col("n"), F.col("cum_n"), F.col("total_n")
    aggregates = [F.max("total_n").alias("n")]
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (total - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (first <= rank) & (rank < behind)
            aggregates.append(F.max(F.when(holds, F.col("value"))).alias(f"_{side}_{name}"))
    picked = ranked.groupBy(*groups).agg(*aggregates)

    def interpolate(name: str, p: float) -> Column:
        place = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return picked.select(
        *groups, "n", *[interpolate(name, p) for name, p in probabilities.items()]
    )


def medians_of_counters(counted: DataFrame, counters: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """Exact medians by each of several counts of the same values, in one pass.

    ``counted`` are rows ``groups, value`` and the counters; the result has, per group and
    under each counter's name, a struct of the median (NULL without rows) and the count.
    """
    ranked = prefix_sum(counted, "value", counters, groups)
    picked, medians = [], []
    for c in counters:
        first, behind, place = F.col(f"cum_{c}") - F.col(c), F.col(f"cum_{c}"), F.lit(0.5) * (F.col(f"total_{c}") - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picked.append(F.max(F.when((first <= rank) & (rank < behind), F.col("value"))).alias(f"_{side}_{c}"))
        picked.append(F.max(f"total_{c}").alias(f"_n_{c}"))
        place, low = F.lit(0.5) * (F.col(f"_n_{c}") - 1), F.col(f"_low_{c}")
        medians.append(F.struct(
            (low + (F.col(f"_high_{c}") - low) * (place - F.floor(place))).alias("median"), F.col(f"_n_{c}").alias("n")).alias(c))
    return ranked.groupBy(*groups).agg(*picked).select(*groups, *medians)
