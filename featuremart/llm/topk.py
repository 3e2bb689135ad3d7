"""Exact top-k search by integer inner product: columns first, with bounds on what remains.

Candidates lie in blocks, a block column by column.  A query adds up its products one
block of dimensions after the other.  What the dimensions still to come can add is at most
the product of the two remaining lengths; a candidate that can't reach the query's bound
any more leaves, and only those that stay are read further.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, written

K = 10
SCALE = 1024
#: Components of a block of candidates and of a group of queries, at most.
CANDIDATE_CELLS, QUERY_CELLS = 1 << 22, 1 << 18
#: Candidates that give every query its first bound, expected, and their components, at most.
SAMPLE, SAMPLE_CELLS = 1_024, 1 << 18
#: Dimensions that are added before candidates are looked through again.
WIDTH = 8
#: Sums below this are exact in double precision.
EXACT = float(1 << 52)


def quantised(vectors: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(_id, ints) of the vectors that take part: neither null nor with a null or non-finite component."""
    x = F.col(vector)
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ints = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return vectors.where(x.isNotNull() & usable).select(F.col(id_column).cast("long").alias("_id"), ints.alias("ints"))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column as integers; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(column), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def ids_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which of them are null."""
    missing = np.asarray(pa.compute.is_null(column), dtype=bool)
    return np.asarray(pa.compute.fill_null(column, 0), dtype=np.int64), missing


def remaining(values: np.ndarray, width: int) -> np.ndarray:
    """Length of what is left of each column of ``values`` from each block of rows on, and 0; never too small."""
    squares = np.add.reduceat(values.astype(np.float64) ** 2, np.arange(0, len(values), width), axis=0)
    tails = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.vstack([np.sqrt(tails) * (1 + 1e-9), np.zeros((1, values.shape[1]))])


def first_bounds(queries: np.ndarray, ids: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray,
                 sample_null: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among the sample, which no result lies below; -inf with fewer."""
    if len(sample) < k:
        return np.full(len(queries), -np.inf)
    scores = queries.astype(np.float64) @ sample.T.astype(np.float64)
    scores[(ids[:, None] == sample_ids[None, :]) & ~sample_null] = -np.inf
    return np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]


def best_of_block(queries: np.ndarray, ids: np.ndarray, bounds: np.ndarray, values: np.ndarray,
                  candidate_ids: np.ndarray, missing: np.ndarray, k: int = K, width: int = WIDTH,
                  exact: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its best ``k`` in a block, ties to the smaller id, null last.

    ``queries`` has a query a row, ``values`` a candidate a column.  Sums that doubles can't
    hold are added as 64-bit integers without bounds.
    """
    out = []
    if not exact:
        for query, own in zip(queries, ids, strict=True):
            scores = query @ values
            left = np.flatnonzero((candidate_ids != own) | missing)
            out.append(_best(left, scores[left], candidate_ids, missing, k))
        return out
    by_length = np.argsort(-np.sqrt((values.astype(np.float64) ** 2).sum(axis=0)), kind="stable")
    values = np.ascontiguousarray(values[:, by_length], dtype=np.float64)
    block_ids, block_null = candidate_ids[by_length], missing[by_length]
    queries = queries.astype(np.float64)
    rest, query_rest = remaining(values, width), remaining(queries.T, width)
    steps = len(rest) - 1
    together = max(1, (1 << 21) // max(1, values.shape[1]))
    for at in range(0, len(queries), together):
        opened = queries[at:at + together, :width] @ values[:width]
        for i, sums in enumerate(opened, start=at):
            bound = bounds[i]
            # the block is ordered by length, so those that are too short are its end
            reach = int(np.searchsorted(-(query_rest[0, i] * rest[0]), -bound, side="right"))
            left = np.flatnonzero((block_ids[:reach] != ids[i]) | block_null[:reach])
            sums = sums[left]
            for step in range(1, steps + 1):
                if step > 1:
                    rows = slice((step - 1) * width, step * width)
                    sums = sums + queries[i, rows] @ values[rows][:, left]
                room = query_rest[step, i] * rest[step, left]
                if len(left) > k:
                    bound = max(bound, np.partition(sums - room, len(left) - k)[len(left) - k])
                stay = sums + room >= bound
                left, sums = left[stay], sums[stay]
            places, scores = _best(left, sums, block_ids, block_null, k)
            out.append((by_length[places], scores.astype(np.int64)))
    return out


def _best(left: np.ndarray, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int):
    order = np.lexsort((ids[left], missing[left], -scores))[:k]
    return left[order], scores[order]


def _search_block(queries: pa.Table, candidates: pa.Table, dims: int, k: int, exact: bool, schema: pa.Schema) -> pa.Table:
    if not queries.num_rows or not candidates.num_rows:
        return schema.empty_table()
    ids, _ = ids_of(queries.column("_id"))
    candidate_ids, missing = ids_of(candidates.column("_id"))
    values = np.ascontiguousarray(matrix(candidates.column("ints"), dims).T)
    bounds = np.asarray(queries.column("bound"), dtype=np.float64)
    found = best_of_block(matrix(queries.column("ints"), dims), ids, bounds, values, candidate_ids, missing, k,
                          exact=exact)
    counts = [len(places) for places, _ in found]
    places = np.concatenate([p for p, _ in found])
    rows = np.repeat(np.asarray(queries.column("_row")), counts)
    return pa.table([
        pa.array(rows), pa.array(np.repeat(ids, counts)), pa.array(candidate_ids[places], mask=missing[places]),
        pa.array(np.concatenate([s for _, s in found]).astype(np.int64))], schema=schema)


def search(vectors: DataFrame, asked: Callable[[Column], Column], id_column: str = "vec_id",
           vector: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of every row that ``asked`` picks by its id, exactly.

    Vectors are scaled and floored to integers; the score is their inner product.  A vector
    that is null or holds a null or non-finite component takes no part; one shorter than
    others counts as followed by zeros, an empty one scores 0.  All rows but those with the
    query's own id are candidates; fewer than ``k`` give fewer rows.  Ties go to the smaller
    id, a null id last.  An id that repeats names several candidates and several queries.
    Scores beyond 64 bits wrap around, components beyond them are cut to their range.  An
    empty table gives no rows.

    Queries and candidates are dealt by hash into groups and blocks of bounded size that
    meet once each; a query's bound comes from a hash sample of the candidates and only
    decides how soon others leave.
    """
    rows = written(quantised(vectors, id_column, vector, scale).select(
        F.monotonically_increasing_id().alias("_row"), "_id", "ints"), "quantised")
    peak = F.max(F.greatest(F.abs(F.array_max("ints").cast("double")), F.abs(F.array_min("ints").cast("double"))))
    is_query = F.coalesce(asked(F.col("_id")), F.lit(False))
    n, n_queries, dims, peak = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("ints")), peak).first()
    dims = max(1, dims or 0)
    exact = (peak or 0.0) ** 2 * dims < EXACT
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // 2_048))
    blocks = max(1, spread, -(-n * dims // CANDIDATE_CELLS))
    groups = max(1, -(-n_queries * dims // QUERY_CELLS))

    every = max(1, -(-n // min(SAMPLE, max(1, SAMPLE_CELLS // dims))))
    sample = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "_row"), F.lit(every)) == 0).limit(
        max(1, min(2 * SAMPLE, SAMPLE_CELLS // dims))).select("_id", "ints").toArrow()
    sampled = matrix(sample.column("ints"), dims)
    sample_ids, sample_null = ids_of(sample.column("_id"))

    def with_bounds(batch: pa.RecordBatch) -> dict:
        ids, _ = ids_of(batch.column("_id"))
        bounds = [first_bounds(matrix(batch.column("ints").slice(at, 1_024), dims), ids[at:at + 1_024], sampled,
                               sample_ids, sample_null, k) if exact else np.full(len(ids[at:at + 1_024]), -np.inf)
                  for at in range(0, len(ids), 1_024)]
        return {c: batch.column(c) for c in ("_row", "_id", "ints", "_group")} | {
            "bound": np.concatenate(bounds) if bounds else np.empty(0)}

    def dealt(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), "_row"), F.lit(count)).cast("int")

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    queries = arrow_map(rows.where(is_query).select("*", dealt("group", groups).alias("_group")), with_bounds,
                        "_row long, _id long, ints array<long>, _group int, bound double")
    left = queries.select("*", all_of(blocks).alias("_block"))
    right = rows.select("_id", "ints", dealt("block", blocks).alias("_block"), all_of(groups).alias("_group"))
    schema = pa.schema([("_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    met = left.groupBy("_block", "_group").cogroup(right.groupBy("_block", "_group")).applyInArrow(
        partial(_search_block, dims=dims, k=k, exact=exact, schema=schema),
        "_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
