"""A benchmark of many blocks is scanned one block at a time."""

import os

from featuremart.llm import decontaminate
from featuremart.session import scratch


def test_one_block_is_live_at_a_time(spark, make_docs):
    items = [(i, " ".join(f"item{i}word{j}" for j in range(12))) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(i, f"before {items[i % 30][1]} after" if i % 2 else "clean text") for i in range(60)])
    with scratch(spark) as folder:
        found = decontaminate.scan(docs, bench, block_words=30)
        left = [n for n in os.listdir(folder.removeprefix("file:")) if n.startswith("scan-")]
        plan = docs._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
        assert plan.count("MapInArrow") == 1 and len(left) == 1  # earlier blocks' rows are gone
        rows = {r.doc_id: r for r in found.collect()}
    whole = {r.doc_id: r for r in decontaminate.scan(docs, bench).collect()}
    assert rows == whole
    assert all(rows[i]["items"] == ([str(i % 30)] if i % 2 else []) for i in range(60))
