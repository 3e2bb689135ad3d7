"""Schema, projection and filter operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.dates import TrainingWindows
from featuremart.functions.text import WHITESPACE


def lenient_cast(df: DataFrame, column: str, target: str) -> Column:
    """Cast that yields NULL on bad text; text reaches integers through double, truncated."""
    value = F.col(f"`{column}`")
    if target in ("int", "bigint") and isinstance(df.schema[column].dataType, T.StringType):
        value = value.try_cast("double")
    return value.try_cast(target)


def enforce_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns in one projection; other columns pass through."""
    expect_columns(df, types)
    return df.select(
        *[lenient_cast(df, c, types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )


def expect_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise with the list of missing columns; reads only the schema."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def column_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, present, type`` for each expected column; reads only the schema."""
    found = dict(df.dtypes)
    entries = [F.struct(F.lit(c).alias("column"), F.lit(c in found).alias("present"),
                        F.lit(found.get(c)).cast("string").alias("type")) for c in columns]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def feature_report(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """``column, kind, filled``: numeric and categorical features by type, with their non-NULL rows."""
    numbers, categories = feature_columns(df, exclude)
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate([*numbers, *categories])])
    kinds = [*((c, "numeric") for c in numbers), *((c, "categorical") for c in categories)]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(f"_{i}").alias("filled"))
        for i, (c, k) in enumerate(kinds)])))


def project_present(
    df: DataFrame, order: Sequence[str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Columns in the given order, absent ones skipped, some renamed."""
    renames = renames or {}
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in order if c in df.columns])


def select_prefix(df: DataFrame, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefix) and c not in keys])


def filter_window(df: DataFrame, column: str, windows: TrainingWindows) -> DataFrame:
    """Rows inside the training or the out-of-time window, as one date range per window.

    The bounds are date literals, so the filter prunes date partitions and reaches the scan.
    """
    day = F.col(column)
    return df.filter(
        day.between(windows.train_test_start, windows.train_test_end)
        | day.between(windows.oot_start, windows.oot_end)
    )


def drop_null_features(df: DataFrame, metadata: Iterable[str]) -> DataFrame:
    """Drop rows with NULL in any column that is not metadata."""
    exempt = set(metadata)
    return df.dropna(subset=[c for c in df.columns if c not in exempt])


def fill_numeric_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """NULL to 0 in numeric columns; text, dates and flags stay as they are."""
    return df.fillna(0, subset=list(subset) if subset else None)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def feature_columns(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names, by type."""
    skip = set(exclude)
    return numeric_columns(df, skip), text_columns(df, skip)


def coerce_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Text columns become double when every non-blank value parses.

    All columns are tested in one aggregate; only its single row of flags reaches the
    driver, where it decides the output schema.
    """
    candidates = text_columns(df, exclude)
    if not candidates:
        return df

    def trimmed(c: str) -> Column:
        text = F.btrim(F.col(f"`{c}`"), F.lit(WHITESPACE))
        return F.when(text != "", text)

    flags = df.agg(
        *[
            (F.count(trimmed(c)) == F.count(trimmed(c).try_cast("double"))).alias(f"c{i}")
            for i, c in enumerate(candidates)
        ]
    ).first()
    numeric = {c for i, c in enumerate(candidates) if flags[f"c{i}"]}
    return df.select(
        *[trimmed(c).try_cast("double").alias(c) if c in numeric else F.col(f"`{c}`") for c in df.columns]
    )
