"""Mixing sources to target weights: random keys, distributed prefix sums and an exact cut."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import SPACED_WORD, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2.0


def size_in_words(text: str | Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def random_key(text: str, id_column: str, source: str, seed: int) -> Column:
    """Hexadecimal digest of seed, id, source and text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_column, source, text)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            repeats: float = REPEATS) -> DataFrame:
    """(source, source_size, target) for per-source totals (source, source_size).

    Sources by code point, null last, take the weights in turn.  Each gets its weight's
    part of ``share`` times the total, but not more than ``repeats`` times its own size;
    what is above is dealt again by weight.  That ends at one level: with sources in
    order of capacity over weight, the first ones are full and the rest share what is
    left.  The one window without groups runs over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_fill = Window.orderBy("fill", "rank")
    all_before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    dealt = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("capacity", F.col("source_size") * F.lit(float(repeats)))
        .withColumn("fill", F.col("capacity") / F.col("weight"))
    )
    every = Window.partitionBy()
    leveled = dealt.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share))).withColumn(
        "level", (F.col("budget") - F.coalesce(F.sum("capacity").over(all_before), F.lit(0.0)))
        / F.sum("weight").over(rest)
    )
    # the first source that the level of its rest does not fill sets the level of all after it
    level = F.min(F.when(F.col("level") < F.col("fill"), F.struct("fill", "rank", "level"))).over(every)
    return leveled.withColumn("reached", level["level"]).select(
        "source", "source_size",
        F.coalesce(F.least("capacity", F.col("reached") * F.col("weight")), F.col("capacity")).alias("target"),
    )


def taken(docs: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source", seed: int = 0,
          **rules) -> DataFrame:
    """(doc_id, key, size, source, source_size, target, epochs, taken) of every row.

    A row's key is a seeded hash of its id, source and text; rows of a source stand in order of
    their keys.  Whole epochs of the source are taken, then its first rows up to the
    exact budget, rounded down to a word: at most one row of a source is taken in part.
    Keys spread over hash ranges, some square root of the row count, so that neither a
    range nor the sum over ranges is large, however large a source is.  Equal rows share
    a key and are taken one after the other.  Null and empty texts have size 0 and take
    nothing; an empty table gives no rows.
    """
    slim = written(docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size_in_words(F.col(text)).alias("size"),
        random_key(text, id_column, source, seed).alias("key"),
    ), "mixing")
    digits = max(1, math.ceil(math.log(max(2, slim.count()), 16) / 2))
    keyed = slim.withColumn("range", F.substring("key", 1, digits))
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), **rules)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0))).alias("o").join(
        goals.alias("g"), F.expr("o.source <=> g.source")).select("o.source", "range", "offset", "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("key", "size", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("offset") - F.col("inside")))
    return (
        placed.alias("p").join(offsets.alias("s"), F.expr("p.source <=> s.source AND p.range = s.range"))
        .select("p.doc_id", "p.key", "p.size", "p.source", "p.inside", "s.offset", "s.source_size", "s.target")
        .withColumn("epochs", epochs.cast("long"))
        .select("doc_id", "key", "size", "source", "source_size", "target", "epochs",
                (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))
    )


def mix(docs: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source", seed: int = 0,
        **rules) -> DataFrame:
    """The mixed rows with the columns of ``docs``: a row for each epoch, the last cut at the budget.

    Only the row at which a source's budget ends is cut, behind the words it still gets.
    Rows that take nothing go; so do rows without words.
    """
    plan = (
        taken(docs, text, id_column, source, seed, **rules)
        .groupBy(F.col("key").alias("_key"), F.col("source").isNull().alias("_null"))
        .agg(F.first("size").alias("_size"), F.sum("taken").alias("_taken"),
             F.min("epochs").alias("_epochs"), F.count("*").alias("_copies"))
        .where("_taken > 0")
    )
    nth = Window.partitionBy("_key", "_null").orderBy("_content")
    own = F.col("_epochs") * F.col("_size") + F.greatest(F.lit(0), F.least(
        F.col("_size"),
        F.col("_taken") - F.col("_copies") * F.col("_epochs") * F.col("_size") - F.col("_nth") * F.col("_size")))
    rows = (
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col(text).alias("_text"),
                    random_key(text, id_column, source, seed).alias("_key"), F.col(source).isNull().alias("_null"),
                    F.xxhash64(*[docs[c] for c in docs.columns]).alias("_content"))
        .join(plan, ["_key", "_null"])
        .withColumn("_nth", F.row_number().over(nth) - 1)
        .withColumn("_own", own).where("_own > 0")
        .withColumn("_piece", F.explode(F.expr(
            "transform(sequence(0L, (_own - 1) DIV _size), i -> least(_size, _own - i * _size))")))
    )
    words = F.regexp_extract_all(F.col("_text"), F.lit(SPACED_WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    shortened = F.when(F.col("_piece") < F.col("_size"),
                       F.array_join(F.slice(words, F.lit(1), F.col("_piece").cast("int")), "")).otherwise(F.col("_text"))
    return rows.select(*[
        shortened.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
