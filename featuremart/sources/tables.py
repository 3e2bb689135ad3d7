"""Reading and writing snapshot tables.

A table is one folder partitioned by ``snapshot_date``.  Reading a month prunes
partitions; writing a month replaces only that partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from datetime import date
from fnmatch import fnmatch

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart import fixed_values as fixed
from featuremart.functions.dates import month_floor, to_date_safe
from featuremart.session import file_system, setting
from featuremart.sources.runs import VersionedTable

SNAPSHOT = "snapshot_date"
#: Without rebalancing a task keeps this many partitions' files open, each with so many
#: bytes at most in memory; rows of further partitions are sorted, which may spill.
OPEN_FILES, OPEN_BYTES = 128, 8 << 20


# --- raw input -------------------------------------------------------------------
def read_raw(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType | None = None) -> DataFrame:
    """CSV files with a header; a path may be a file, a folder or a pattern.

    Without a schema all columns stay text, which silver then parses: no extra pass over
    the files to guess types.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def ingest_snapshot(raw: DataFrame, day: date | None = None, optional_date: bool = False) -> DataFrame:
    """Rows of one snapshot, or of all when no day is given, with a real date column.

    A source without the date column is an error unless ``optional_date``; then it is
    taken whole, stamped with the day where one is given.
    """
    if SNAPSHOT not in raw.columns:
        if optional_date:
            return raw if day is None else raw.withColumn(SNAPSHOT, F.lit(day))
        raise ValueError(f"missing columns: ['{SNAPSHOT}']")
    dated = raw.withColumn(SNAPSHOT, to_date_safe(SNAPSHOT))
    return dated if day is None else dated.filter(F.col(SNAPSHOT) == F.lit(day))


# Sources whose extract may come without a snapshot date.
UNDATED_SOURCES = {"attributes", "financials"}


def ingest_all(
    spark: SparkSession, paths: Mapping[str, str], day: date | None = None
) -> dict[str, DataFrame]:
    """One frame per named raw source."""
    return {
        name: ingest_snapshot(read_raw(spark, path), day, optional_date=name in UNDATED_SOURCES)
        for name, path in paths.items()
    }


# --- snapshot tables ---------------------------------------------------------------
def write_snapshot(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (SNAPSHOT,),
    covered: tuple[date | None, date | None] | None = None,
    rebalance: bool = True,
) -> str:
    """Write a table, replacing exactly the partitions present in ``df``.

    ``covered`` names the first and last date that ``df`` stands for (None: no bound);
    partitions in that range that got no rows are removed, so that a month that has
    become empty is empty after a re-run.  Rows are rebalanced by partition first: small
    months become one file, a huge month is divided over many tasks.  Without
    ``rebalance`` each task writes what it has, a file a partition, with neither shuffle
    nor sort: for rows that come, one by one, from a table with the same partitions and
    so lie that way already, and where smaller files are better than a shuffle.
    """
    keys = [c for c in partition_by if c in df.columns]
    before = partition_files(df.sparkSession, path, keys[0]) if covered and keys else {}
    writer = (df.hint("rebalance", *[F.col(c) for c in keys]) if keys and rebalance else df).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    elif fmt == "parquet":
        writer = writer.option("compression", "zstd")
        if not rebalance:
            writer = writer.option("parquet.block.size", OPEN_BYTES)
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    with nullcontext() if rebalance else setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        writer.format(fmt).save(path)
    if before:
        remove_emptied(df.sparkSession, path, keys[0], before, covered)
    return path


def partition_files(spark: SparkSession, path: str, key: str) -> dict[str, set[str]]:
    """Names of the files of each partition folder of a dated table."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return {}
    found: dict[str, set[str]] = {}
    for folder in system.listStatus(place):
        name, _, value = folder.getPath().getName().partition("=")
        if name == key and folder.isDirectory():
            files, names = system.listFiles(folder.getPath(), True), set()
            while files.hasNext():
                names.add(files.next().getPath().getName())
            found[value] = names
    return found


def remove_emptied(
    spark: SparkSession, path: str, key: str, before: dict[str, set[str]], covered: tuple[date | None, date | None],
) -> None:
    """Delete the partitions of a range that have the files they had before a write: it gave them no rows."""
    after = partition_files(spark, path, key)
    start, end = covered
    for value, files in before.items():
        inside = (start is None or value >= start.isoformat()) and (end is None or value <= end.isoformat())
        if inside and after.get(value) == files:  # a partition that was written has new files
            system, place = file_system(spark, f"{path}/{key}={value}")
            system.delete(place, True)


#: Conditions under which a path holds no table yet; everything else is an error.
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def nothing_there(error: AnalysisException) -> bool:
    return (error.getCondition() or "").split(".")[0] in NOTHING_THERE


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A whole table; a missing or empty folder is reported by name."""
    reader = spark.read.options(**({"header": True} if fmt == "csv" else {}), **options)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if not nothing_there(error):
            raise
        raise FileNotFoundError(f"no {fmt} files under {path}") from error


def read_snapshot(spark: SparkSession, path: str, day: date, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, fmt).filter(F.col(SNAPSHOT) == F.lit(day))


def write_feature_matrix(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Feature columns with the keys in front."""
    df.select(*keys, *[c for c in df.columns if c not in keys]).write.mode("overwrite").parquet(path)
    return path


# --- calendar ------------------------------------------------------------------------
def first_of_months(start: Column, end: Column) -> Column:
    """Array of the first days of the months in ``[start, end]``."""
    months = F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month"))
    return F.filter(months, lambda m: m >= start)


def snapshot_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    months = first_of_months(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(months).alias(SNAPSHOT))


def covered_calendar(df: DataFrame, column: str) -> DataFrame:
    """Every month from the first to the last date of a table, gaps included."""
    bounds = df.agg(F.min(F.to_date(column)).alias("low"), F.max(F.to_date(column)).alias("high"))
    months = F.sequence(F.trunc("low", "month"), F.col("high"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias(SNAPSHOT))


# --- predictions, summaries, monitoring, runs ------------------------------------------
def parent_folder() -> Column:
    path = F.url_decode(F.col("_metadata.file_path"))
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def folder_value(name: str) -> Column:
    """Value of a partition folder ``name=value`` in the file's path; NULL without one."""
    path = F.url_decode(F.col("_metadata.file_path"))
    return F.nullif(F.regexp_extract(path, rf"/{name}=([^/]*)/", 1), F.lit(""))


def _nested_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Parquet files at any depth, columns merged by name.

    Below partition folders the partitions stay columns, so that a month is pruned;
    plain folders are searched.
    """
    system, place = file_system(spark, path)
    partitioned = system.exists(place) and any(
        "=" in s.getPath().getName() and s.isDirectory() for s in system.listStatus(place))
    reader = spark.read.option("pathGlobFilter", pattern).option("mergeSchema", True)
    return (reader if partitioned else reader.option("recursiveFileLookup", True)).parquet(path)


def write_predictions(df: DataFrame, path: str) -> str:
    """Predictions, partitioned by snapshot and model version; other snapshots and models stay."""
    return write_snapshot(df, path, partition_by=[SNAPSHOT, "model_version"])


def read_predictions(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Prediction files of all models; the folder name stands in for a missing version."""
    files = _nested_files(spark, path, pattern)
    version = F.coalesce(folder_value("model_version"), parent_folder())
    if "model_version" in files.columns:
        version = F.coalesce(folder_value("model_version"), F.col("model_version").cast("string"), version)
    columns = [c for c in files.columns if c != "model_version"]
    return files.select(
        *[to_date_safe(c).alias(c) if c == SNAPSHOT else F.col(c) for c in columns],
        version.alias("model_version"),
    )


def flat_columns(schema: T.StructType, prefix: Sequence[str] = ()) -> list[Column]:
    """One column per leaf of nested structs, named ``a.b.c``."""
    flat: list[Column] = []
    for f in schema.fields:
        path = [*prefix, f.name]
        if isinstance(f.dataType, T.StructType):
            flat += flat_columns(f.dataType, path)
        else:
            flat.append(F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)))
    return flat


def read_json_summaries(
    spark: SparkSession,
    path: str,
    pattern: str = "*.json",
    time_column: str = "evaluation_time",
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """JSON summary documents as flat rows, with the folder name as model version.

    A given schema saves the pass over the files that finds one.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    files = (
        reader.option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(path)
    )
    fields = T.StructType([f for f in files.schema.fields if f.name != "model_version"])
    flat = files.select(*flat_columns(fields), parent_folder().alias("model_version"))
    if time_column not in flat.columns:
        return flat
    parsed = F.try_to_timestamp(F.col(time_column).cast("string"))
    return flat.withColumn(time_column, parsed)


def normalise_monitoring(df: DataFrame) -> DataFrame:
    """Month floor and canonical metric names; an alias is copied only where the name is free."""
    added = [
        F.col(old).alias(new)
        for old, new in fixed.MONITORING_ALIASES.items()
        if old in df.columns and new not in df.columns
    ]
    columns = [month_floor(to_date_safe(c)).alias(c) if c == "month" else F.col(c) for c in df.columns]
    return df.select(*columns, *added).orderBy("month")


def read_monitoring(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Union of monthly metric files with differing columns; an unreadable file is an error."""
    return normalise_monitoring(_nested_files(spark, path, pattern))


def read_monitoring_leniently(
    spark: SparkSession, path: str, pattern: str = "*.parquet"
) -> tuple[DataFrame, DataFrame]:
    """The readable monthly files, and ``file, reason`` of every file that was skipped.

    There is one small file per run, so their footers are tried one by one.
    """
    system, place = file_system(spark, path)
    files, good, bad = system.listFiles(place, True), [], []
    while files.hasNext():
        file = files.next().getPath()
        if not fnmatch(file.getName(), pattern):
            continue
        try:
            spark.read.parquet(file.toString())
            good.append(file.toString())
        except Exception as error:  # Spark wraps the footer's error in several classes
            bad.append((file.toString(), str(error).splitlines()[0]))
    skipped = spark.createDataFrame(bad, "file string, reason string")
    if not good:
        raise FileNotFoundError(f"no readable monitoring files under {path}")
    return normalise_monitoring(spark.read.option("mergeSchema", True).parquet(*good)), skipped


def run_schema(spark: SparkSession) -> T.StructType:
    return spark.createDataFrame([], fixed.REGISTRY_SCHEMA).schema


def no_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], fixed.REGISTRY_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run records with the fixed registry schema, all or none; absent columns are NULL."""
    fields = run_schema(runs.sparkSession).fields
    VersionedTable(runs.sparkSession, path).append(runs.select(*[
        (F.col(f.name) if f.name in runs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]))


def append_run(spark: SparkSession, rows: Sequence[Mapping], path: str) -> None:
    """The same for a few records that a driver program holds."""
    schema = run_schema(spark)
    append_runs(spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields) for row in rows], schema), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table's last version, or an empty one with its schema before the first run."""
    runs = VersionedTable(spark, path).read()
    return no_runs(spark) if runs is None else runs
