"""SimHash near-duplicates through deletion-variant signatures.

Two fingerprints that differ in at most two bits agree, in one of their two halves, in
all bits but one.  So every half is indexed 32 times, each time with another bit wiped
out; equal signatures meet in an equality shuffle and the distance is verified there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, as_bytes, slices, spaced_words, written
from featuremart.llm.components import connected_components

DISTANCE = 2
HALF = 32
#: Members of a signature that are compared directly; larger groups are indexed once more.
DIRECT = 512
_HASH = partial(xxhash.xxh64_intdigest, seed=42)
_ALL = (1 << 64) - 1


def fingerprint(words: list[bytes], width: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included; zero without words."""
    n = len(words)
    if not n:
        return 0
    if n < width:
        hashes = [_HASH(b" ".join(words))]
    else:
        hashes = map(_HASH, map(b" ".join, zip(*(words[i:] for i in range(width)))))
    values = np.fromiter(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(values), 1 << 15):
        part = values[start:start + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fp`` (signed 64 bits) of every row; whole texts, null as empty."""
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in source.dtypes if c != "_text") + ", fp long"

    def run(batch: pa.RecordBatch) -> dict:
        values = []
        for part in slices(batch, "_text"):
            values += [fingerprint(spaced_words(t), width) for t in as_bytes(part.column("_text"))]
        return {c: batch.column(c) for c in keep} | {"fp": np.array(values, np.uint64).view(np.int64)}

    return arrow_map(source, run, schema)


def signatures(distinct: DataFrame) -> DataFrame:
    """(signature, fp): 64 rows per fingerprint, one for each half and wiped bit."""
    return distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * HALF - 1))).alias("w")).selectExpr(
        f"""(shiftleft(CAST(w AS BIGINT), {HALF})
             | (shiftrightunsigned(fp, CAST({HALF} * (w DIV {HALF}) AS INT)) & {(1 << HALF) - 1}L
                & ~shiftleft(1L, CAST(w % {HALF} AS INT)))) AS signature""",
        "fp",
    )


def _direct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the smallest of its component, among values compared directly."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= DISTANCE
    label = np.arange(len(values))
    while True:
        smaller = np.where(near, label[None, :], len(values)).min(axis=1)
        smaller = np.minimum(smaller, smaller[smaller])
        if (smaller == label).all():
            break
        label = smaller
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _refine(values: np.ndarray, open_bits: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links in a large group whose members agree outside ``open_bits`` and wiped bits.

    The same step on the open bits: of their two halves one differs in a bit at most.
    The groups shrink to a few hundred members when few bits are left, so that no group
    is ever compared pair by pair.
    """
    if len(values) <= DIRECT or len(open_bits) <= 4:
        yield _direct(values)
        return
    half = len(open_bits) // 2
    for kept, rest in ((open_bits[:half], open_bits[half:]), (open_bits[half:], open_bits[:half])):
        for wiped in kept:
            mask = np.uint64(sum(1 << b for b in kept if b != wiped))
            order = np.argsort(values & mask, kind="stable")
            sub = (values & mask)[order]
            starts = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]])
            stops = np.r_[starts[1:], len(sub)]
            for start, stop in zip(starts, stops, strict=True):
                if stop - start > 1:
                    yield from _refine(np.sort(values[order[start:stop]]), rest)


def links_of_runs(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among fingerprints with equal signatures; keys sorted, fingerprints within them."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    length_of = np.repeat(lengths, lengths)
    few = (length_of > 1) & (length_of <= 8)
    few_keys, few_fps = keys[few], fps[few]
    for step in range(1, 8):
        if len(few_keys) <= step:
            break
        close = (few_keys[step:] == few_keys[:-step]) & (
            np.bitwise_count(few_fps[step:] ^ few_fps[:-step]) <= DISTANCE)
        out.append((few_fps[step:][close], few_fps[:-step][close]))
    for i in np.flatnonzero(lengths > 8):
        run = fps[starts[i]:starts[i] + lengths[i]]
        other = 0 if int(keys[starts[i]]) >> (HALF + 5) else HALF  # bits of the half that is not in the key
        out += _refine(run, list(range(other, other + HALF)))
    if not out:
        return fps[:0], fps[:0]
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*out, strict=True)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links that connect exactly what fingerprints at two or fewer differing bits connect.

    ``distinct`` holds different fingerprints.  Equal signatures come together by a
    shuffle and are read in order, so that a task keeps one signature's members only.
    """
    ordered = signatures(distinct).repartition("signature").sortWithinPartitions("signature", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)

        def out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = links_of_runs(keys, fps.view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows < 1 << 18:
                continue
            keys, fps = (np.concatenate(x) for x in zip(*waiting, strict=True))
            last = np.searchsorted(keys, keys[-1])
            waiting, rows = [(keys[last:], fps[last:])], len(keys) - last
            if last:
                yield out(keys[:last], fps[:last])
        if waiting:
            keys, fps = (np.concatenate(x) for x in zip(*waiting, strict=True))
            if len(keys):
                yield out(keys, fps)

    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fp, component_id) per row; the component's smallest id reachable over links.

    Rows repeat as they are.  Texts that are null, empty or without words have
    fingerprint zero and link like any other.  A null id is never the smallest; a
    component of null ids has a null ``component_id``.  An empty table gives no rows.
    """
    rows = written(
        fingerprints(docs.select(F.col(id_column).alias("_id"), text), ["_id"], text, width), "fingerprints")
    return rows.join(component_of_fingerprint(rows), "fp").select(
        F.col("_id").alias(id_column), "fp", "component_id")


def component_of_fingerprint(rows: DataFrame) -> DataFrame:
    """(fp, root, component_id) of each different fingerprint of ``rows`` (_id, fp)."""
    firsts = written(rows.groupBy("fp").agg(F.min("_id").alias("first_id")), "distinct")
    roots = connected_components(links(firsts.select("fp")))
    members = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return members.join(smallest, "root").select("fp", "root", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    """16 lower-case hexadecimal digits of a signed 64-bit fingerprint."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row of each near-duplicate component, with the columns of ``docs``.

    The row with the smallest id stays, a null id last; rows that share it are ordered
    by a hash of their content, and of rows equal in every column one stays.  Each
    fingerprint's candidate is found before rows meet, so that a large group of copies
    sends one slim row per task.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    key = [F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_key"),
           F.xxhash64(*[docs[c] for c in docs.columns]).alias("_content")]
    rows = written(
        fingerprints(docs.select(F.col(id_column).alias("_id"), *key, F.col(text).alias("_whole")),
                     ["_id", "_key", "_content"], "_whole", width), "fingerprints")
    order = F.struct(F.col("_id").isNull(), "_id", "_key", "_content")
    best = rows.groupBy("fp").agg(F.min(order).alias("best"))
    chosen = (component_of_fingerprint(rows).join(best, "fp").groupBy("root").agg(F.min("best").alias("best"))
              .select("best._key", "best._content"))
    once = Window.partitionBy("_key", "_content").orderBy("_key")
    return (docs.select(row, *key).join(chosen, ["_key", "_content"], "left_semi")
            .withColumn("_n", F.row_number().over(once)).where("_n = 1").select("_row.*"))
