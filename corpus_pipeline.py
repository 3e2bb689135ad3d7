"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix and shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm import decontaminate, mixing, sharding, similar, toxicity
from featuremart.llm.common import table
from featuremart.session import removed, scratch, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity lies below the threshold of their language."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("NOT rejected").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-copies.

    Deletion variants of SimHash propose pairs; near-copies have a Jaccard similarity of
    0.8 of their five-word shingles.
    """
    return similar.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them; n_chars follows a cut text."""
    mixed = mixing.mix(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot in a reproducible shuffle."""
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    content = F.xxhash64(*[docs[c] for c in names])
    dealt = sharding.shard_rows(docs.select(*names, content.alias("content_key")), ["doc_id", "content_key"])
    return dealt.select(*names, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("sharding", deal_shards),
]

#: A trained classifier and components of fingerprints have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again.

    What a stage wrote on its way is removed as soon as its rows are there, and its rows
    once the next stage's are.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, name)
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
        if before:
            removed(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
