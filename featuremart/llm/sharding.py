"""Sharding by a keyed permutation of global row numbers; DataFrame functions only."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 16
ROUNDS = 6


def _mixed(value: Column, round_number: Column, seed: int, modulus: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), round_number.cast("string"), value.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def sides(rows: int) -> tuple[int, int]:
    """The two moduli of the permutation: their product is the row count or little above it."""
    left = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return left, max(1, -(-rows // left))


def _feistel(number: Column, left: int, right: int, seed: int) -> Column:
    """One pass of the alternating Feistel network over 0 .. left*right-1."""
    a, b = F.lit(left).cast("long"), F.lit(right).cast("long")

    def step(state: Column, k: Column) -> Column:
        x, y = state["x"], state["y"]
        even = (k % 2) == 0
        return F.struct(
            F.when(even, F.pmod(x + _mixed(y, k, seed, a), a)).otherwise(x).alias("x"),
            F.when(even, y).otherwise(F.pmod(y + _mixed(x, k, seed, b), b)).alias("y"),
        )

    start = F.struct(F.pmod(number, a).alias("x"), ((number - F.pmod(number, a)) / a).cast("long").alias("y"))
    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, step, lambda s: s["x"] + s["y"] * a)


def permuted(number: Column, rows: int, seed: int = 0) -> Column:
    """The place of row ``number`` in the shuffled order of 0 .. rows-1.

    The network permutes a domain that exceeds the row count by less than its square
    root.  A value outside is sent through it again until it is inside (cycle walking);
    as a cycle can't meet more outside values than there are, the walk is a fold over
    that many steps, which only those few rows take.
    """
    left, right = sides(rows)
    beyond = left * right - rows
    first = _feistel(number, left, right, seed)
    if not beyond:
        return first
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(beyond)), first,
        lambda at, _: F.when(at >= rows, _feistel(at, left, right, seed)).otherwise(at))
    return F.when(first < rows, first).otherwise(walk)


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with gapless global row numbers from 0, and the row count.

    Rows are dealt by a hash of the columns ``order`` into about as many buckets as the
    square root of the count, numbered inside by hash and columns, and moved by the
    bucket's offset; only one count per bucket is summed in one task and sent to all.
    """
    total = df.count()
    buckets = max(1, math.isqrt(total))
    hashed = df.select(
        F.struct(*[df[c] for c in df.columns]).alias("_row"), F.struct(*[df[c] for c in order]).alias("_order"),
        F.xxhash64(*[df[c] for c in order]).alias("_hash"),
    ).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy("_bucket").count().select(
        "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy("_hash", "_order")
    numbered = hashed.withColumn("_inside", F.row_number().over(inside) - 1)
    number = (F.col("_offset") + F.col("_inside")).alias(name)
    return numbered.join(offsets, "_bucket").select("_row.*", number), total


def shard_rows(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``df`` with row_number, shard and slot, dealt evenly: shard sizes differ by one at most.

    Global row numbers are shuffled by a keyed permutation; a place's remainder is its
    shard, its quotient the slot, gapless from 0 in each shard.  The same rows and seed
    give the same shuffle whatever the partitions.  ``order`` names the columns that
    identify a row; rows equal in all of them are interchangeable, and nulls are values
    like others.  Columns of ``df`` with the names of results are replaced.  An empty
    table gives no rows.
    """
    kept = [c for c in df.columns if c not in ("row_number", "shard", "slot")]
    numbered, total = number_rows(df.select(*kept), order)
    placed = numbered.select(
        F.struct(*[numbered[c] for c in kept]).alias("_row"), "row_number",
        permuted(F.col("row_number"), total, seed).alias("_place"))
    return placed.select(
        "_row.*", "row_number", F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("_place") - F.pmod("_place", F.lit(shards))) / shards).cast("long").alias("slot"))


def place_of(number: int, rows: int, seed: int = 0) -> int:
    """The place of one row number, computed without the data."""
    left, right = sides(rows)
    while True:
        y, x = divmod(number, left)
        for k in range(ROUNDS):
            x, y = ((x + _digest(y, k, seed)) % left, y) if k % 2 == 0 else (x, (y + _digest(x, k, seed)) % right)
        number = x + y * left
        if number < rows:
            return number


def row_number_at(shard: int, slot: int, rows: int, shards: int = SHARDS, seed: int = 0) -> int:
    """The row number that lies in a shard's slot: the permutation backwards."""
    left, right = sides(rows)
    number = slot * shards + shard
    while True:
        y, x = divmod(number, left)
        for k in reversed(range(ROUNDS)):
            x, y = ((x - _digest(y, k, seed)) % left, y) if k % 2 == 0 else (x, (y - _digest(x, k, seed)) % right)
        number = x + y * left
        if number < rows:
            return number


def _digest(value: int, k: int, seed: int) -> int:
    return int(hashlib.md5(f"{seed}:{k}:{value}".encode()).hexdigest()[:15], 16)
