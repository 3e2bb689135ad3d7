"""Exact stratified train/test splits and folds.

Rows are put in the order of a seeded hash, which is the same on every run, and cut at
exact ranks per class.  A class may hold most of the data, so it is never sorted in one
place: a histogram of hash prefixes finds the few prefixes that hold a cut, all other
rows are assigned in place without a shuffle, and only the rows under those prefixes
are ordered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart import fixed_values as fixed
from featuremart.session import materialise

#: Rows under one hash prefix, on average; prefixes get longer with the data.
ROWS_PER_PREFIX = 4096
COPIES_PER_CHUNK = 4096


def stable_columns(df: DataFrame) -> list[str]:
    """Columns that identify rows the same way whenever they are computed: no fractions."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """Seeded MD5 of the given columns; NULL differs from empty text."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _assign(
    df: DataFrame,
    stratum: str,
    cuts_of: Callable[[DataFrame], DataFrame],
    cut_count: int,
    name: str,
    columns: Sequence[str] | None,
    seed: int,
) -> DataFrame:
    """Add ``name``: how many cut ranks of its class lie at or before the row's rank.

    ``cuts_of`` turns the table ``_class, n`` into ``_class, cuts``, an array of
    ``cut_count`` ranks.  The hashed rows are written once: the histogram, the settled and
    the contested rows then read the same values, and the input is computed once.
    """
    data_columns = df.columns
    keyed = materialise(df.select(
        "*",
        F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("\u0000")).alias("_class"),
        row_hash(columns or stable_columns(df) or data_columns, seed).alias("_hash"),
    ), "split")
    rows, digits = keyed.count(), 4
    while 16 ** digits * ROWS_PER_PREFIX < rows and digits < 15:
        digits += 1
    hashed = keyed.select("*", F.conv(F.substring("_hash", 1, digits), 16, 10).cast("bigint").alias("_prefix"))

    histogram = hashed.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("n"))
    cuts = cuts_of(histogram.groupBy("_class").agg(F.sum("n").alias("n")))
    before = F.sum("n").over(W.partitionBy("_class").orderBy("_prefix")) - F.col("n")
    # per class and cut: under which prefix it falls, how far into it, and whether it splits it
    marks = (
        histogram.select("*", before.alias("before"))
        .join(cuts, "_class")
        .select("_class", "_prefix", "n", "before", F.posexplode("cuts").alias("i", "cut"))
        .filter((F.col("before") <= F.col("cut")) & (F.col("cut") < F.col("before") + F.col("n")))
        .select("_class", "i", F.struct("_prefix", (F.col("cut") - F.col("before")).alias("offset")).alias("mark"))
        .groupBy("_class")
        .agg(*[F.max(F.when(F.col("i") == i, F.col("mark"))).alias(f"c{i}") for i in range(cut_count)])
    )
    split_prefixes = F.array_compact(
        F.array(*[F.when(F.col(f"c{i}.offset") > 0, F.col(f"c{i}._prefix")) for i in range(cut_count)])
    )
    marks_by_class = (
        marks.select("_class", F.struct("*", split_prefixes.alias("split")).alias("m"))
        .agg(F.map_from_entries(F.collect_list(F.struct("_class", "m"))).alias("m"))
        .scalar()
    )
    located = hashed.select("*", marks_by_class.alias("_all")).select(
        *data_columns, "_class", "_hash", "_prefix", F.try_element_at("_all", F.col("_class")).alias("_marks")
    )
    # The filter names the hash once: Spark pushes it to the scan with the hash written out
    # in place, so every further mention would compute it again for each row.
    contested = F.coalesce(F.array_contains("_marks.split", F.col("_prefix")), F.lit(False))
    passed = F.lit(0)
    for i in range(cut_count):
        prefix, offset = F.col(f"_marks.c{i}._prefix"), F.col(f"_marks.c{i}.offset")
        behind = (prefix < F.col("_prefix")) | ((prefix == F.col("_prefix")) & (offset == 0))
        passed = passed + F.when(behind, 1).otherwise(0)
    settled = located.filter(~contested).select(*data_columns, passed.alias(name))

    # Contested prefixes: exact copies are counted, ranked by hash, divided, written out again.
    copies = (
        located.filter(contested)
        .groupBy(*data_columns, "_class", "_hash", "_prefix")
        .agg(F.count(F.lit(1)).alias("n"), F.any_value("_marks").alias("_marks"), F.max(passed).alias("_passed"))
    )
    in_prefix = W.partitionBy("_class", "_prefix").orderBy("_hash", *data_columns)
    start = F.sum("n").over(in_prefix.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    inner_cuts = F.array_compact(
        F.array(*[
            F.when(
                (F.col(f"_marks.c{i}._prefix") == F.col("_prefix")) & (F.col(f"_marks.c{i}.offset") > 0),
                F.col(f"_marks.c{i}.offset"),
            )
            for i in range(cut_count)
        ])
    )
    ranked = copies.select("*", start.alias("_start"), F.array_sort(inner_cuts).alias("_cuts"))
    # regions between cuts: [0, c1), [c1, c2), ... ; how many copies fall in each
    regions = ranked.select(
        *data_columns, "_start", "n", "_passed",
        F.posexplode(
            F.arrays_zip(
                F.concat(F.array(F.lit(0).cast("bigint")), "_cuts").alias("low"),
                F.concat("_cuts", F.array(F.lit(2**62).cast("bigint"))).alias("high"),
            )
        ).alias("_region", "_bounds"),
    ).select(
        *data_columns,
        (F.col("_passed") + F.col("_region")).alias(name),
        (
            F.least(F.col("_bounds.high"), F.col("_start") + F.col("n"))
            - F.greatest(F.col("_bounds.low"), F.col("_start"))
        ).alias("_copies"),
    ).filter(F.col("_copies") > 0)
    return settled.unionByName(write_out_copies(regions, "_copies"))


def write_out_copies(df: DataFrame, count: str) -> DataFrame:
    """Repeat each row ``count`` times; large counts are spread over tasks in chunks."""
    kept = [c for c in df.columns if c != count]
    chunks = df.select(
        "*",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / COPIES_PER_CHUNK)))
        .alias("_chunk"),
    ).repartition("_chunk", *kept[:1])
    in_chunk = F.least(
        F.lit(COPIES_PER_CHUNK).cast("bigint"), F.col(count) - F.col("_chunk") * COPIES_PER_CHUNK
    )
    return chunks.select(*kept, F.explode(F.sequence(F.lit(1).cast("bigint"), in_chunk)).alias("_copy")).drop("_copy")


def _train_sizes(totals: DataFrame, ratio: float) -> DataFrame:
    """Training rows per class: overall size first, remainders to the largest fractions."""
    everything = W.partitionBy(F.lit(0))
    overall = F.sum("n").over(everything)
    sized = totals.select("_class", "n", (overall - F.ceil(overall * (1 - ratio))).alias("train"), overall.alias("all"))
    exact = F.col("n") * F.col("train") / F.col("all")
    floored = sized.select("*", F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("part"))
    missing = F.col("train") - F.sum("whole").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("part"), "_class"))
    return floored.select("_class", "n", (F.col("whole") + F.when(place <= missing, 1).otherwise(0)).alias("cut"))


def stratified_split(
    df: DataFrame,
    label: str,
    ratio: float = fixed.SPLIT_RATIO,
    seed: int = fixed.SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``split``: ``train`` for the given share of every class, else ``test``.

    ``columns`` are hashed for the order (default: all but fractions); they should tell
    rows apart.
    """

    def cuts(totals: DataFrame) -> DataFrame:
        return _train_sizes(totals, ratio).select("_class", F.array("cut").alias("cuts"))

    assigned = _assign(df, label, cuts, 1, "_part", columns, seed)
    return assigned.select(
        *df.columns, F.when(F.col("_part") == 0, F.lit("train")).otherwise(F.lit("test")).alias("split")
    )


def stratified_folds(
    df: DataFrame,
    label: str,
    folds: int = 5,
    seed: int = fixed.SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``fold`` in ``0 .. folds-1`` with equal class shares, sizes differing by one."""

    def cuts(totals: DataFrame) -> DataFrame:
        bounds = [F.ceil(F.col("n") * k / folds).cast("bigint") for k in range(1, folds)]
        return totals.select("_class", F.array(*bounds).alias("cuts"))

    return _assign(df, label, cuts, folds - 1, "fold", columns, seed)
