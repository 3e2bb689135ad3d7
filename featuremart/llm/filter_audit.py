"""What quality filters remove together: each order of them, step by step.

Documents count once, by the combination of filters they fail; every order and step is
read from those few counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import SPACED_WORD, written

#: Rows of one hash from which on they are split, at least; never more than SHARE hashes are split.
HOT_ROWS, SHARE, SALTS = 10_000, 1_000, 64


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))


#: Failure condition of a text and its words, by filter name.
FILTERS: Mapping[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 100,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
    "C": lambda text, words: 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 10 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
COPY = "E"


def failures(docs: DataFrame, id_column: str, text: str, part: str,
             filters: Mapping[str, Callable[[Column, Column], Column]] = FILTERS) -> DataFrame:
    """(id, part, hash, bits) of every row; bit i is set where the i-th filter fails."""
    read = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("words", _words(F.col("text")))
    bits = F.lit(0)
    for i, fails in enumerate(filters.values()):
        bits = bits + F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0)
    return read.select("id", "part", F.xxhash64("text").alias("hash"), bits.alias("bits"))


def copies(docs: DataFrame, hashes: DataFrame, id_column: str, text: str, part: str) -> DataFrame:
    """(id, part, hash) of the rows whose text also stands under a smaller id, table-wide.

    A left-semi join on hash, exact text and smaller id against each text's smallest id.
    ``hashes`` (hash) has every row's; a hash of very many rows is split by salt.  There
    are at most SHARE such, so they are broadcast.
    """
    rows = hashes.count()
    hot = F.broadcast(hashes.groupBy("hash").count().where(F.col("count") >= max(HOT_ROWS, rows // SHARE)).select(
        "hash", F.lit(SALTS).alias("salts")))
    read = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    salts = F.coalesce("salts", F.lit(1))
    firsts = read.groupBy("hash", "text").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    right = firsts.join(hot, "hash", "left").select(
        "hash", "text", "first", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    left = read.where("id IS NOT NULL").join(hot, "hash", "left").select(
        "id", "part", "hash", "text", F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt")).alias("l")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("hash", "salt", "text")]
    return left.join(right.alias("r"), [*same, F.col("r.first") < F.col("l.id")], "left_semi").select("id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang",
                 filters: Mapping[str, Callable[[Column, Column], Column]] = FILTERS) -> DataFrame:
    """(part, bits, n, good, toxic): rows by the filters they fail, copies the last bit.

    The copies' ids are united with the other failures; a row is known by id, part and
    hash, so that an id under several texts is several documents.
    """
    facts = written(failures(docs, id_column, text, part, filters), "failures")
    marked = copies(docs, facts.select("hash"), id_column, text, part)
    bit = F.lit(1 << len(filters))
    documents = (facts.select("id", "part", "hash", "bits", F.lit(1).alias("n"))
                 .union(marked.select("id", "part", "hash", bit.alias("bits"), F.lit(0).alias("n")))
                 .groupBy("id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")))
    known = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("id IS NOT NULL")
    # rows without an id match no label; the second key keeps them out of one task
    spread = F.when(F.col("id").isNull(), F.pmod("hash", F.lit(4_096)).cast("int")).otherwise(F.lit(0))
    joined = documents.withColumn("spread", spread).join(
        known.withColumn("spread", F.lit(0)), ["id", "spread"], "left")
    return joined.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang",
          filters: Mapping[str, Callable[[Column, Column], Column]] = FILTERS) -> DataFrame:
    """What each filter removes in each order of the filters, per part.

    One row per part, filter_order and step: kept (after the step), removed (at it),
    redundant (failing its filter, removed before), unique_fails (failing it alone),
    good_lost and toxic_lost (removed at it and labelled so), shapley (what its filter
    removes, over all orders).

    A null text is empty, a null part the empty string.  A row without an id is neither a
    copy nor does it make others copies; rows that share id and text aren't copies of each
    other and count each.  Several label rows of an id count as one that holds what any of
    them says.  A part has rows for all orders, zeros included; no documents give no rows.
    """
    names = "".join(filters) + COPY
    bit = {name: 1 << i for i, name in enumerate(names)}
    steps = [
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(at + 1).alias("step"), F.lit(bit[name]).alias("own"),
                 F.lit(sum(bit[x] for x in order[:at])).alias("before"))
        for order in permutations(names) for at, name in enumerate(order)]
    rows = combinations(docs, labels, id_column, text, part, filters).select(
        "part", "bits", "n", "good", "toxic", F.inline(F.array(*steps)))
    fails = (F.col("bits").bitwiseAND(F.col("own")) != 0)
    earlier = (F.col("bits").bitwiseAND(F.col("before")) != 0)

    def total(condition: Column, count: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(0)).cast("long")

    counted = rows.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"))
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
