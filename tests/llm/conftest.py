import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
SYLLABLES = ["ka", "lo", "mi", "ré", "tu", "Va", "ne", "so"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source[, lang]]) as a documents table, with columns that clash with results."""

    def make(rows, clash=True):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            for name in ("score", "shard", "slot", "row_number", "fp", "items", "size", "key", "_row", "_text", "_key", "_content",
                         "_hash", "_bucket", "_order", "_place", "_size", "_taken", "_id", "_n", "_null", "_whole"):
                df = df.selectExpr("*", f"'old' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long, repeated and copied texts, null and repeated ids and sources."""
    rng = random.Random(3)
    base = [(i, " ".join(words(rng, rng.randint(1, 120))), rng.choice(["a", "b", None])) for i in range(60)]
    copy = " ".join(words(rng, 90))
    return [
        *base, (100, None, "a"), (101, "", "b"), (102, " \t\n", None), (None, "so ka", "a"), (None, None, None),
        (103, " ".join(words(rng, 6_000)), "c"), (104, copy, "a"), (105, copy, "b"), (105, copy, "b"), (105, copy, "b"),
        (106, copy.replace(" ", "\n"), "a"), (107, copy + " ka", "a"), (5, "other text of a known id", "a"),
        (108, "a" * 700, "b"), (109, "a" * 450, "b"), (110, "ab" * 300, "b"),
    ]
