"""Incremental landing of new raw files.

The monthly run only has to process files that arrived since the last one.  A file
stream with ``availableNow`` does that and stops: its checkpoint remembers which files
are done, so a file is landed once even when a run is repeated after a failure.  All
layer steps up to silver are row-wise and can be applied on the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featuremart.sources.tables import SNAPSHOT, ingest_snapshot


def new_raw_rows(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """CSV files appearing in a folder, as an unbounded frame with a real snapshot date."""
    stream = spark.readStream.option("header", True).schema(schema).csv(folder)
    return ingest_snapshot(stream, optional_date=True)


def land_available(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append all rows available now to a snapshot table, then stop."""
    out = step(rows) if step else rows
    writer = out.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if SNAPSHOT in out.columns:
        writer = writer.partitionBy(SNAPSHOT)
    writer.option("checkpointLocation", checkpoint).start(path).awaitTermination()
