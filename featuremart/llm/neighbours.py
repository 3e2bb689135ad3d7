"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a sample is cut into balanced parts with few edges between them; a
small classifier learns the part of a vector from the vector.  It assigns every row to a
part and routes each query to its most probable parts, where all rows are ranked by
their exact inner product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, written

NEAREST = 20
#: Bound of the sample that partitions are learned from; every row is indexed.
SAMPLE = 8_192
#: Sample rows kept apart to choose how many parts a query visits.
TRIALS = 512
RECALL = 0.97
GRAPH_NEIGHBOURS = 10
HIDDEN = 128
#: Rows and queries that are multiplied at a time.
BLOCK = 2_048


def parts_for(rows: int) -> int:
    """Number of parts: some 1,600 rows each, 32 at least where there are 64 rows for each, 256 at most."""
    return max(1, min(rows // 64, 32), min(rows // 1_600, 256))


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k nearest other vectors of each, by inner product."""
    out = []
    for at in range(0, len(vectors), 128):  # some 8 MB of scores at a time
        scores = vectors[at:at + 128] @ -vectors.T
        scores[np.arange(len(scores)), at + np.arange(len(scores))] = np.inf
        out.append(np.argpartition(scores, k - 1, axis=1)[:, :k].astype(np.int32))
    return np.concatenate(out)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each vector: near-equal sizes, few graph edges between parts.

    Halving along principal directions gives the start; then vectors move to the part
    that most of their neighbours are in, best gains first, while sizes stay within 5 %.
    """
    label = np.zeros(len(vectors), np.int64)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        label[rows] = first
        if count == 1:
            return
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = rows[np.argsort(centred @ axes[:, -1], kind="stable")]
        left = count // 2
        at = len(order) * left // count
        halve(order[:at], first, left)
        halve(order[at:], first + left, count - left)

    halve(np.arange(len(vectors)), 0, parts)
    source = np.repeat(np.arange(len(vectors)), graph.shape[1])
    edges = (np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source]))
    most = int(np.ceil(len(vectors) / parts * 1.05))
    least = int(len(vectors) / parts * 0.95)
    rng = np.random.default_rng(seed)
    for _ in range(20):
        votes = np.zeros((len(vectors), parts), np.int32)
        np.add.at(votes, (edges[0], label[edges[1]]), 1)
        target = votes.argmax(axis=1)
        gain = votes[np.arange(len(label)), target] - votes[np.arange(len(label)), label]
        sizes = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.lexsort((rng.random(len(gain)), -gain)):
            if gain[i] <= 0:
                break
            if sizes[target[i]] < most and sizes[label[i]] > least and rng.random() < 0.7:
                sizes[target[i]] += 1
                sizes[label[i]] -= 1
                label[i] = target[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer; ``probes`` is the number of parts a query visits."""

    weights: list[np.ndarray]
    parts: int
    probes: int = 1

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        w1, b1, w2, b2 = self.weights
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")


def learn(vectors: np.ndarray, parts: int, seed: int = 0, epochs: int = 30) -> Router:
    """Router that predicts in which parts a vector and its graph neighbours lie."""
    dimension = vectors.shape[1]
    rng = np.random.default_rng(seed)
    graph = neighbour_graph(vectors, min(GRAPH_NEIGHBOURS, len(vectors) - 1)) if parts > 1 else None
    weights = [rng.normal(0, (2 / dimension) ** 0.5, (dimension, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    router = Router(weights, parts)
    if parts == 1:
        return router
    label = balanced_parts(vectors, graph, parts, seed)
    goal = np.zeros((len(vectors), parts))
    np.add.at(goal, (np.arange(len(vectors)).repeat(graph.shape[1]), label[graph].ravel()), 0.5 / graph.shape[1])
    goal[np.arange(len(vectors)), label] += 0.5
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs)
        order = rng.permutation(len(unit))
        for at in range(0, len(order), 256):
            rows, step = order[at:at + 256], step + 1
            x = unit[rows]
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            p = np.exp(out - out.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - goal[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            for w, g, m, v in zip(weights, (x.T @ back, back.sum(0), hidden.T @ error, error.sum(0)),
                                  first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return router


def set_probes(router: Router, indexed: np.ndarray, trials: np.ndarray, recall: float) -> None:
    """Fewest parts that hold ``recall`` of the trials' nearest among the indexed sample."""
    if router.parts == 1:
        return
    k = min(NEAREST, len(indexed))
    home = router.ranked(indexed)[:, 0]
    near = np.concatenate([np.argpartition(part @ -indexed.T, k - 1, axis=1)[:, :k]
                           for part in np.array_split(trials, max(1, len(trials) // 128))])
    rank = np.argsort(router.ranked(trials), axis=1)  # place of each part in a trial's ranking
    places = np.take_along_axis(rank, home[near], axis=1).ravel()
    shares = np.cumsum(np.bincount(places, minlength=router.parts)) / len(places)
    router.probes = int(np.searchsorted(shares, recall) + 1)


def routed(router: Router, vectors: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """Parts that each vector visits: ``probes``, and more while they hold fewer than ``least`` entries."""
    ranked = router.ranked(vectors)
    held = np.cumsum(sizes[ranked], axis=1)
    stops = np.maximum(router.probes, (held < least).sum(axis=1) + 1)
    return [parts[:stop] for parts, stop in zip(ranked, stops, strict=True)]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v): different rows with a finite vector that is not zero, of the commonest length."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def fit(different: DataFrame, rows: int, recall: float = RECALL, seed: int = 0) -> Router:
    """Router from at most SAMPLE + TRIALS of the different vectors, those with the smallest hashes."""
    sample = different.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE + TRIALS).toArrow()
    matrix = _matrix(sample.column("v"))
    if not len(matrix):
        return Router([], 1)
    trials = matrix[SAMPLE:] if len(matrix) > SAMPLE + TRIALS // 2 else matrix[-max(1, len(matrix) // 8):]
    indexed = matrix[: len(matrix) - len(trials)] if len(matrix) > 1 else matrix
    router = learn(indexed, parts_for(min(rows, 1_600 * 256) if len(matrix) >= SAMPLE else len(indexed)), seed)
    set_probes(router, indexed, trials, recall)
    return router


def search(vectors: DataFrame, is_query, id_column: str = "vec_id", vector: str = "embedding",
           nearest: int = NEAREST, recall: float = RECALL, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query by inner product.

    Candidates are all rows but those with the query's own id; equal scores go to the
    smaller id.  Equal vectors are one entry of the index with their smallest ids, as
    many as a result can hold, so that a vector shared by very many rows is ranked once
    and exactly.  A query visits more parts while those it visits hold no more entries
    than it asks for.  Large parts and many queries are split into blocks.  Rows whose id or
    vector is null, whose vector is empty or zero, holds a null or a value that isn't
    finite, or has another length than most, take no part; rows equal in id and vector
    are one.  An empty table gives no rows.
    """
    rows = written(usable(vectors, id_column, vector).distinct(), "vectors")
    by_vector = Window.partitionBy("v").orderBy("id")
    entries = written(
        rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= nearest + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    router = fit(entries, entries.count(), recall, seed)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def home(batch: pa.RecordBatch) -> dict | None:
        if not batch.num_rows:
            return None
        return {"ids": batch.column("ids"), "v": batch.column("v"),
                "part": shared.value.ranked(_matrix(batch.column("v")))[:, 0]}

    def routes(batch: pa.RecordBatch) -> dict | None:
        if not batch.num_rows:
            return None
        return {"id": batch.column("id"), "v": batch.column("v"),
                "parts": routed(shared.value, _matrix(batch.column("v")), sizes, nearest + 1)}

    kind = rows.schema["v"].dataType.simpleString()
    indexed = written(arrow_map(entries, home, f"ids array<long>, v {kind}, part int"), "indexed")
    sizes = np.zeros(router.parts, np.int64)
    for r in indexed.groupBy("part").count().collect():  # a row for each part, 256 at most
        sizes[r["part"]] = r["count"]
    asked = arrow_map(rows.where(is_query(F.col("id"))), routes, f"id long, v {kind}, parts array<int>").select(
        "id", "v", F.explode("parts").alias("part"))
    row_blocks = indexed.groupBy("part").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    query_blocks = asked.groupBy("part").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("chunks"))
    blocks = F.broadcast(row_blocks.join(query_blocks, "part"))  # a row for each part, 256 at most
    key = ["part", "block", "chunk"]
    left = indexed.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("v"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "ids", "v")
    right = asked.join(blocks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id", "v"), "chunks").cast("int").alias("chunk"), "id", "v")

    def rank(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if entries.num_rows and queries.num_rows:
            found = _rank(entries, queries, nearest)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


def _rank(entries: pa.Table, queries: pa.Table, nearest: int) -> list[np.ndarray]:
    """Query, candidate and exact score of the nearest candidates of one block."""
    index, asked = _matrix(entries.column("v")), _matrix(queries.column("v"))
    ids = entries.column("ids").combine_chunks()
    offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    query_ids = queries.column("id").to_numpy()
    top = min(nearest + 1, len(index))
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(asked), 256):
        scores = asked[at:at + 256] @ index.T
        limit = np.partition(scores, len(index) - top, axis=1)[:, len(index) - top]
        slack = 1e-9 * (1 + np.abs(scores).max(axis=1))
        rows, columns = np.nonzero(scores >= (limit - slack)[:, None])
        exact = (asked[at + rows] * index[columns]).sum(axis=1)
        members = offsets[columns + 1] - offsets[columns]
        start = np.repeat(offsets[columns] - np.r_[0, np.cumsum(members)[:-1]], members)
        candidate = flat[start + np.arange(len(start))]
        row, exact = np.repeat(rows, members), np.repeat(exact, members)
        other = candidate != query_ids[at + row]
        row, candidate, exact = row[other], candidate[other], exact[other]
        order = np.lexsort((candidate, -exact, row))
        row, candidate, exact = row[order], candidate[order], exact[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < nearest
        for c, x in zip(out, (query_ids[at + row[keep]], candidate[keep], exact[keep]), strict=True):
            c.append(x)
    return [np.concatenate(c) for c in out]
