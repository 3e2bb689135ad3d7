"""Exact top-k search against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from featuremart.llm import topk

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("score", T.StringType()), T.StructField("_row", T.StringType())])


def brute(rows, asked, k=10):
    usable = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector]))
    out = []
    for query, a in usable:
        if query is None or not asked(query):
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), c is None, c) for c, b in usable if c != query]
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(query, rank, c, -s) for rank, (s, _, c) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, asked=lambda i: i % 7 == 0, **options):
    df = spark.createDataFrame([(i, v, "old", "old") for i, v in rows], VECTORS)
    found = topk.search(df, asked, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    """Several groups and blocks at any size, a small sample and few dimensions a step."""
    monkeypatch.setattr(topk, "CANDIDATE_CELLS", 400)
    monkeypatch.setattr(topk, "QUERY_CELLS", 100)
    monkeypatch.setattr(topk, "SAMPLE", 40)


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_equal_to_brute_force(spark, small_blocks, dims):
    rows = vectors(1, 160, dims)
    assert run(spark, rows) == brute(rows, lambda i: i % 7 == 0)


def test_odd_rows_and_ties(spark, small_blocks):
    rows = vectors(2, 40, 6) + [
        (100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [math.nan] * 6), (103, [math.inf] * 6), (104, []),
        (105, [2.0]), (None, [3.0] * 6), (None, None), (7, [1.0] * 6), (14, [0.0] * 6)]
    rows += [(1_000 + i, [0.5] * 6) for i in range(60)]  # equal vectors, more than k
    assert run(spark, rows) == brute(rows, lambda i: i % 7 == 0)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 1024 * 2048)]
    assert run(spark, [(1, [1.0]), (2, [2.0])]) == []  # nothing is asked


def test_large_components_are_added_as_integers(spark, small_blocks):
    rows = [(i, [1e6 + i, -3e4 * i, 7.25]) for i in range(30)]
    assert run(spark, rows) == brute(rows, lambda i: i % 7 == 0)


def test_bounds_leave_out_most_products(monkeypatch):
    """With a known bound only few candidates are read to the last dimension."""
    rng = np.random.default_rng(3)
    values = np.floor(1024 * rng.normal(0, 0.2, (64, 3_000))).astype(np.int64)
    query = values[:, :1].T
    scores = (query @ values)[0]
    scores[0] = np.iinfo(np.int64).min
    bound = float(np.sort(scores)[-10])
    left = []
    keep = np.flatnonzero
    monkeypatch.setattr(topk, "_best", lambda l, s, ids, null, k: (left.append(len(l)), (l[:0], s[:0]))[1])
    topk.best_of_block(query, np.array([0]), np.array([bound]), values, np.arange(3_000), np.zeros(3_000, bool))
    assert keep(scores >= bound).size <= left[0] <= 20
