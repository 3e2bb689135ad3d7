"""Imputation, scaling and encoding.

Every operator is a lazy DataFrame function whose statistics arrive as a scalar
subquery, or, in :class:`Preprocessor`, a fitted object that holds them and can be
applied to other data.  Statistics are a few numbers per column.  Wide forms have a
column for each value; sparse forms (index rows, or the vectors of
:class:`Preprocessor`) hold vocabularies of any size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featuremart.functions.text import WHITESPACE, _col
from featuremart.operators.ordered import column_stats, exact_quantiles, medians_of_counters, unpivot_numbers
from featuremart.session import materialise


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column: ``column, median``."""
    return exact_quantiles(df, columns, {"median": 0.5}).select("column", "median")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per text column, the smallest of equals: ``column, mode``."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column: ``column, mean, std``."""
    return column_stats(df, columns, mean=F.avg, std=F.stddev_pop)


def _by_column(stats: DataFrame, value: Column) -> Column:
    return stats.agg(F.map_from_entries(F.collect_list(F.struct(F.col("column"), value)))).scalar()


def _replace(df: DataFrame, new: dict[str, Column], extra: Column | None = None) -> DataFrame:
    source = df if extra is None else df.select("*", extra.alias("_stats"))
    return source.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])


def _stat(c: str) -> Column:
    return F.try_element_at("_stats", F.lit(c))


def filled_number(c: str, default: Column) -> Column:
    """Number as double, with NULL and NaN replaced."""
    value = F.col(c).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), default)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = _by_column(medians(df, columns), F.col("median"))
    return _replace(df, {c: filled_number(c, _stat(c)) for c in columns}, stats)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = _by_column(modes(df, columns), F.col("mode"))
    return _replace(df, {c: F.coalesce(F.col(c), _stat(c)) for c in columns}, stats)


def impute_constant(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def scaled(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in population deviations; a constant column becomes 0."""
    return (value.cast("double") - mean) / F.when(std > 0, std).otherwise(F.lit(1.0))


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = _by_column(moments(df, columns), F.struct("mean", "std"))
    return _replace(
        df, {c: scaled(F.col(c), _stat(c)["mean"], _stat(c)["std"]) for c in columns}, stats
    )


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Map each column to [0, 1]; a constant column becomes 0."""
    bounds = column_stats(df, columns, low=F.min, high=F.max)
    stats = _by_column(bounds, F.struct("low", "high"))

    def rescaled(c: str) -> Column:
        low, width = _stat(c)["low"], _stat(c)["high"] - _stat(c)["low"]
        return (F.col(c).cast("double") - low) / F.when(width > 0, width).otherwise(F.lit(1.0))

    return _replace(df, {c: rescaled(c) for c in columns}, stats)


def _vocabulary(values: DataFrame) -> list[str]:
    """Sorted distinct values, all of them: they name the columns of the wide forms."""
    return sorted(row[0] for row in values.distinct().collect())


def categories(df: DataFrame, column: str) -> list[str]:
    return _vocabulary(df.select(F.col(column)).filter(F.col(column).isNotNull()))


def split_tokens(column: Column | str, separator: str = "|") -> Column:
    """Trimmed, non-empty parts of a separated text; NULL gives none."""
    parts = F.split(F.coalesce(_col(column), F.lit("")), f"\\Q{separator}\\E")
    trimmed = F.transform(parts, lambda t: F.btrim(t, F.lit(WHITESPACE)))
    return F.filter(trimmed, lambda t: t != "")


def tokens(df: DataFrame, column: str, separator: str = "|") -> list[str]:
    return _vocabulary(df.select(F.explode(split_tokens(column, separator))))


def numbered_values(values: DataFrame, column: str = "value") -> DataFrame:
    """``value, index``: distinct values numbered from 0 in sorted order, however many there are.

    Values are cut into ranges by Spark's range partitioner; a range's first number is the
    size of the ranges before it.
    """
    parts = materialise(values.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
                        .repartitionByRange("value").select("value", F.spark_partition_id().alias("_part")), "values")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy("value")) - 1
    return parts.join(starts, "_part").select("value", (F.col("_start") + inside).cast("bigint").alias("index"))


def one_hot_entries(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Sparse one-hot form: ``keys, index`` of each row's category, for any number of categories.

    The entry's value is 1; a row without a category has no entry.
    """
    numbers = numbered_values(df, column)
    rows = df.select(*keys, F.col(column).alias("value"))
    return rows.join(numbers, "value").select(*keys, "index")


def multi_hot_entries(df: DataFrame, column: str, keys: Sequence[str], separator: str = "|") -> DataFrame:
    """Sparse multi-hot form: one ``keys, index`` for each different token of a row."""
    items = F.array_distinct(split_tokens(column, separator))
    rows = df.select(*keys, F.explode(items).alias("value"))
    return rows.join(numbered_values(rows), "value").select(*keys, "index")


def one_hot(df: DataFrame, column: str, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per category; a category unseen at fit time gives zeros only."""
    vocabulary = categories(df, column) if vocabulary is None else list(vocabulary)
    return df.select(
        "*",
        *[F.when(F.col(column) == v, 1.0).otherwise(0.0).alias(f"{column}_{v}") for v in vocabulary],
    )


def multi_hot(
    df: DataFrame, column: str, vocabulary: Sequence[str] | None = None, separator: str = "|"
) -> DataFrame:
    """One 0/1 column per token of a separated text column."""
    vocabulary = tokens(df, column, separator) if vocabulary is None else list(vocabulary)
    items = df.select("*", split_tokens(column, separator).alias("_items"))
    return items.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            F.when(F.array_contains("_items", v), 1.0).otherwise(0.0).alias(f"{column}__{v}")
            for v in vocabulary
        ],
    )


@dataclass
class Preprocessor:
    """Median + scaling for numbers, mode + one-hot for categories, multi-hot for lists.

    ``fit`` keeps a handful of numbers per column; ``transform`` is one projection, with
    no join or shuffle.
    """

    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    multi_value: list[str] = field(default_factory=list)
    separator: str = "|"

    def fit(self, df: DataFrame) -> Preprocessor:
        self.medians_ = dict(medians(df, self.numeric).collect()) if self.numeric else {}
        # deviations are taken after imputation, as the scaler sees imputed values
        imputed = df.select(
            *[filled_number(c, F.lit(self.medians_.get(c))).alias(c) for c in self.numeric]
        )
        self.moments_ = {
            r["column"]: (r["mean"], r["std"]) for r in moments(imputed, self.numeric).collect()
        } if self.numeric else {}
        self.modes_ = dict(modes(df, self.categorical).collect()) if self.categorical else {}
        self.categories_ = {c: categories(df, c) for c in self.categorical}
        self.tokens_ = {c: tokens(df, c, self.separator) for c in self.multi_value}
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        """The fitted settings and statistics as one JSON text."""
        spark.createDataFrame([(json.dumps(self.__dict__),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        state = json.loads(spark.read.text(path, wholetext=True).first()["value"])
        out = cls(state["numeric"], state["categorical"], state["multi_value"], state["separator"])
        out.__dict__.update(state)
        return out

    @property
    def feature_names(self) -> list[str]:
        return (
            list(self.numeric)
            + [f"{c}_{v}" for c in self.categorical for v in self.categories_[c]]
            + [f"{c}__{v}" for c in self.multi_value for v in self.tokens_[c]]
        )

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns in front, then one double per feature."""
        features: list[Column] = []
        for c in self.numeric:
            mean, std = self.moments_.get(c, (0.0, 0.0))
            value = filled_number(c, F.lit(self.medians_.get(c)))
            features.append(scaled(value, F.lit(mean), F.lit(std)).alias(c))
        for c in self.categorical:
            value = F.coalesce(F.col(c), F.lit(self.modes_.get(c)))
            features += [
                F.when(value == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in self.categories_[c]
            ]
        listed = [split_tokens(c, self.separator).alias(f"_items_{c}") for c in self.multi_value]
        for c in self.multi_value:
            features += [
                F.when(F.array_contains(f"_items_{c}", v), 1.0).otherwise(0.0).alias(f"{c}__{v}")
                for v in self.tokens_[c]
            ]
        return df.select("*", *listed).select(*keep, *features)

    def assemble(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns and one ``features`` vector for Spark ML, sparse in the encoded values."""
        columns, parts, vocabularies = [], [], {}
        for c in self.numeric:
            mean, std = self.moments_.get(c, (0.0, 0.0))
            parts.append(f"_f{len(parts)}")
            columns.append(scaled(filled_number(c, F.lit(self.medians_.get(c))), F.lit(mean), F.lit(std)).alias(parts[-1]))
        for c in self.categorical:
            value = F.coalesce(F.col(c), F.lit(self.modes_.get(c)))
            vocabularies[f"_c{len(vocabularies)}"] = (F.array_compact(F.array(value)), self.categories_[c])
        for c in self.multi_value:
            vocabularies[f"_c{len(vocabularies)}"] = (split_tokens(c, self.separator), self.tokens_[c])
        ready = df.select(*keep, *columns, *[v.alias(n) for n, (v, _) in vocabularies.items()])
        for name, (_, known) in vocabularies.items():
            if known:  # sparse 0/1 vector; values unseen at fit time are left out
                encoder = CountVectorizerModel.from_vocabulary(known, name, f"{name}_v", binary=True)
                ready = encoder.transform(ready)
                parts.append(f"{name}_v")
        return VectorAssembler(inputCols=parts, outputCol="features").transform(ready).select(*keep, "features")


def fit_without(
    steps: Preprocessor, df: DataFrame, slot: str, folds: int
) -> tuple[list[Preprocessor], list[dict[str, int]]]:
    """``steps`` for the rows outside of each of ``folds`` slots, and for all rows last: medians, modes and vocabularies.

    Slot ``folds`` is in no fold's way, later slots count for all rows only.  Values are
    counted once for all: a counter a target.  Also per target the number of known values
    of each numeric column.  Moments are left to a pass over the stored rows.
    """
    counters = [f"_n{t}" for t in range(folds + 1)]
    used = [*[(F.col(slot) != k) & (F.col(slot) <= folds) for k in range(folds)], F.lit(True)]
    counted = df.select("*", *[u.cast("bigint").alias(n) for u, n in zip(used, counters, strict=True)])
    fitted = [replace(steps) for _ in counters]
    known: list[dict[str, int]] = [{} for _ in counters]
    for own in fitted:
        own.medians_, own.modes_ = {}, {}
        own.categories_, own.tokens_ = {c: [] for c in steps.categorical}, {c: [] for c in steps.multi_value}
    if steps.numeric:
        for row in medians_of_counters(unpivot_numbers(counted, steps.numeric, counters), counters, ["column"]).collect():
            for own, some, (median, n) in zip(fitted, known, (row[c] for c in counters), strict=True):
                some[row["column"]] = n
                if median is not None:
                    own.medians_[row["column"]] = median
    for some in known:
        for c in steps.numeric:
            some.setdefault(c, 0)
    if steps.categorical:
        long = counted.select(*counters, *[F.col(c).cast("string").alias(c) for c in steps.categorical]).unpivot(
            counters, list(steps.categorical), "column", "value")
        rows = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(*[F.sum(n).alias(n) for n in counters]).collect()
        for own, n in zip(fitted, counters, strict=True):
            for c in steps.categorical:
                sizes = {r["value"]: r[n] for r in rows if r["column"] == c and r[n]}
                own.categories_[c] = sorted(sizes)
                if sizes:
                    own.modes_[c] = min(sizes, key=lambda v: (-sizes[v], v))
    for c in steps.multi_value:
        found = counted.select(F.explode(split_tokens(c, steps.separator)).alias("value"), *counters)
        rows = found.groupBy("value").agg(*[F.sum(n).alias(n) for n in counters]).collect()
        for own, n in zip(fitted, counters, strict=True):
            own.tokens_[c] = sorted(r["value"] for r in rows if r[n])
    return fitted, known
