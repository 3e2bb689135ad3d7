import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featuremart.operators import sampling


def rows(spark, n=4000):
    """Two classes, 30 % positive."""
    return spark.range(n).select("id", (F.col("id") % 10 < 3).cast("int").alias("label"))


def test_split_sizes_are_exact(spark):
    got = sampling.stratified_split(rows(spark, 4003), "label").collect()
    counts = Counter((r["label"], r["split"]) for r in got)
    train = 4003 - math.ceil(4003 * (1 - 0.8))
    assert sum(n for (_, s), n in counts.items() if s == "train") == train
    for label, size in ((1, 1203), (0, 2800)):
        assert abs(counts[(label, "train")] - size * train / 4003) < 1
    assert len({r["id"] for r in got}) == 4003


def test_split_is_repeatable_and_seeded(spark):
    a = {r["id"] for r in sampling.stratified_split(rows(spark), "label").filter("split = 'train'").collect()}
    b = {r["id"] for r in sampling.stratified_split(rows(spark).repartition(7), "label").filter("split = 'train'").collect()}
    c = {r["id"] for r in sampling.stratified_split(rows(spark), "label", seed=1).filter("split = 'train'").collect()}
    assert a == b and a != c


def test_exact_copies_are_divided_exactly(spark):
    """A third or more of all rows are copies of one row; nothing is lost and the cut is exact."""
    df = spark.range(30000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(1).alias("label"))
    got = Counter((r["k"] == -1, r["split"]) for r in sampling.stratified_split(df, "label").collect())
    assert sum(n for (_, s), n in got.items() if s == "train") == 24000
    assert sum(n for (copy, _), n in got.items() if copy) == 15000
    only_copies = spark.range(20000).select(F.lit(5).alias("k"), F.lit(0).alias("label"))
    folds = Counter(r["fold"] for r in sampling.stratified_folds(only_copies, "label", 3).collect())
    assert sorted(folds.values()) == [6666, 6667, 6667]


def test_folds_are_balanced_per_class(spark):
    got = Counter((r["label"], r["fold"]) for r in sampling.stratified_folds(rows(spark, 1003), "label").collect())
    assert {f for _, f in got} == set(range(5))
    for label in (0, 1):
        sizes = [n for (y, _), n in got.items() if y == label]
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_classes(spark, n):
    df = spark.range(n).select("id", F.lit(1).alias("label"))
    assert sampling.stratified_split(df, "label").count() == n
    assert sampling.stratified_folds(df, "label").count() == n


def test_null_class_is_a_class(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, 1).alias("label"))
    got = Counter((r["label"], r["split"]) for r in sampling.stratified_split(df, "label").collect())
    assert got == {(1, "train"): 40, (None, "train"): 40, (1, "test"): 10, (None, "test"): 10}
