"""Helpers that several operators share: byte-level words, Arrow maps, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and nothing else.
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Also turns every ASCII byte that is neither a letter nor a digit into a space.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Runs of anything but ASCII white space; `bytes.split()` finds the same runs.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: Runs of ASCII letters, digits and all non-ASCII characters, of any case.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def spaced_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between ASCII white space; none for null."""
    return text.translate(LOWER_TABLE).split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and all non-ASCII characters; none for null."""
    return text.translate(WORD_TABLE).split() if text else []


def crc_of_id(column: str | Column) -> Column:
    """Unsigned CRC32 of an id's decimal text; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, so that memory stays bounded."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for start, stop in zip(starts, np.r_[starts[1:], len(sizes)], strict=True):
        yield batch.slice(start, stop - start)


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(batch) -> dict of columns or None`` over every Arrow batch of ``df``."""

    def parts(batch: pa.RecordBatch) -> Iterator[dict]:
        out = function(batch)
        if out is not None:
            yield out

    return arrow_parts(df, parts, schema)


def arrow_parts(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """The same for a function that gives the columns of any number of parts, one after another."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in function(batch):
                yield record_batch(out, arrow)

    return df.mapInArrow(run, schema)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        value = columns[field.name]
        if isinstance(value, pa.ChunkedArray):
            value = value.combine_chunks()
        arrays.append(value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the cluster's shared folder and read again.

    Cuts the lineage, so that work is neither repeated by several readers nor lost with
    an executor.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
