"""A labelled text beyond the sample's bound leaves the others to learn from."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from featuremart.llm import toxicity
from tests.llm.conftest import words


def test_a_giant_first_labelled_text_is_left_out(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, 20) + (["zorgon"] if i % 4 == 0 else []))) for i in range(300)]
    first = toxicity.labelled_rows(
        make_docs(rows), spark.createDataFrame([(i, 0) for i in range(300)], "doc_id long, toxic long"))
    first_id = first.orderBy("order").first()["doc_id"]
    rows[first_id] = (first_id, "ka " * 20_000)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic long")
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 10_000)
    docs = make_docs(rows)
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where(F.col("doc_id") != first_id).collect()
    toxic = [r["score"] for r in scored if r.doc_id % 4 == 0]
    clean = [r["score"] for r in scored if r.doc_id % 4]
    assert sum(toxic) / len(toxic) > sum(clean) / len(clean) + 0.5


def test_giant_texts_stay_with_the_executors(spark, make_docs, monkeypatch):
    """However many labelled texts are beyond the bounds, only those that fit are fetched."""
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 500)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 4_000)
    giants = [(i, "ka, " * 600) for i in range(200)] + [(200 + i, "x" * 5_000) for i in range(50)]
    rows = giants + [(300 + i, f"so {i}, LO" * 3) for i in range(60)] + [(300, None), (301, "so 1, LO" * 3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic long")
    found = toxicity.labelled_sample(make_docs(rows), labels)
    texts = [r["text"] or "" for r in found.collect()]
    assert 20 < len(texts) <= 61 and sum(map(len, texts)) <= 4_000
    assert sum(len(toxicity.plain_words(t.encode())) for t in texts) <= 500
    assert toxicity.fit(make_docs(rows), labels, epochs=1).threshold > 0


def test_score_equals_a_naive_forward_pass(spark, make_docs, odd_rows):
    """Every filter at every place of the whole text, word by word."""
    rows = [r for r in odd_rows if len(r[1] or "") < 3_000]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic long")
    model = toxicity.fit(make_docs(odd_rows), labels, epochs=1)

    def vector(word):
        letters = word.decode()
        buckets = [zlib.crc32(word)] + [zlib.crc32(letters[:n].encode(), n) for n in toxicity.PREFIXES if len(letters) >= n]
        return sum(model.embedding[b % toxicity.BUCKETS].astype(float) for b in buckets)

    def naive(text):
        found = [vector(w) for w in toxicity.plain_words((text or "").encode())] or [np.zeros(toxicity.DIMENSIONS)]
        found += [np.zeros(toxicity.DIMENSIONS)] * 2
        pooled = []
        for width, filters in zip(toxicity.WIDTHS, model.filters, strict=True):
            for f in range(toxicity.FILTERS):
                pooled.append(max(sum(float(found[at + k] @ filters[k][:, f]) for k in range(width))
                                  for at in range(len(found) - 2)))
        logit = np.maximum(np.array(pooled) + model.bias, 0) @ model.weight + model.offset
        return 1 / (1 + math.exp(-(model.slope * logit + model.shift)))

    got = sorted((r.n_chars or 0, r["score"]) for r in toxicity.score(make_docs(rows), model).collect())
    want = sorted((len(r[1] or ""), naive(r[1])) for r in rows)
    assert np.allclose(got, want, atol=1e-4)
