"""Every score of the convolutional classifier against a plain pass, word by word."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from featuremart.llm import toxicity
from tests.llm.conftest import words


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[0-9a-z\x80-\U0010ffff]+", lowered)


def vector(model, word):
    total = model.embedding[zlib.crc32(word.encode()) % toxicity.BUCKETS].astype(float).copy()
    for n in toxicity.PREFIXES:
        if len(word) >= n:
            total += model.embedding[zlib.crc32(word[:n].encode(), n) % toxicity.BUCKETS]
    return total


def plain_score(model, text):
    blank = np.zeros(toxicity.DIMENSIONS)
    vectors = [vector(model, w) for w in plain_words(text)] or [blank]
    logit = model.offset
    for w, (width, filters) in enumerate(zip(toxicity.WIDTHS, model.filters, strict=True)):
        for f in range(toxicity.FILTERS):
            best = -math.inf
            for i in range(len(vectors)):
                seen = [*vectors[i:i + width], *[blank] * width][:width]
                best = max(best, sum(float(v @ filters[k, :, f]) for k, v in enumerate(seen)))
            at = w * toxicity.FILTERS + f
            logit += max(best + float(model.bias[at]), 0.0) * float(model.weight[at])
    return 1 / (1 + math.exp(-(model.slope * logit + model.shift)))


def test_scores_are_those_of_a_plain_pass(spark, make_docs, odd_rows):
    rng = random.Random(6)
    bad = ["vile", "vilest", "Öde", "rotten"]
    rows = [(1000 + i, " ".join([*words(rng, rng.randint(1, 40)), *(rng.choices(bad, k=2) if i % 3 == 0 else [])]), "a")
            for i in range(150)] + odd_rows
    labels = spark.createDataFrame(
        [(1000 + i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    docs = make_docs(rows)
    model = toxicity.fit(docs, labels, epochs=2)
    got = [(r.text, r.score) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(rows) and len({round(s, 9) for _, s in got}) > 50
    known = {}
    for text, score in got:
        if text not in known:
            known[text] = plain_score(model, text)
        assert score == pytest.approx(known[text], abs=1e-4)
