"""The language model's final scores against a plain computation, word by word."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from featuremart.llm import lm

A = lm.ALPHA


def h(x):
    return x * math.log(x) if x > 0 else 0.0


def pairs(sequences, of):
    return Counter((of(a), of(b)) for s in sequences for a, b in zip([lm.END, *s], s, strict=False))


def plain_scores(rows):
    train = [t.lower().encode().split() + [lm.END] for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for s in train for w in s)
    common = sorted((w for w in count if w != lm.END), key=lambda w: (-count[w], w))
    frequent = {w: i for i, w in enumerate([lm.END, *common][:lm.FREQUENT])}
    unit = lambda w: frequent.get(w, lm.unit_of_rare(w))
    bigrams = np.zeros((lm.FREQUENT + lm.ENDINGS,) * 2, np.int64)
    for (a, b), n in pairs(train, unit).items():
        bigrams[a, b] = n
    of_unit = lm.exchange(bigrams)
    first = lambda w: int(of_unit[unit(w)])
    table, classes = pairs(train, first), range(lm.CLASSES)
    rows_of, columns_of = Counter(), Counter()
    for (a, b), n in table.items():
        rows_of[a] += n
        columns_of[b] += n
    before, after = {}, {}
    for s in train:
        for a, w, b in zip([lm.END, *s], s, [*s[1:], lm.END], strict=False):
            if w not in frequent:
                before.setdefault(w, Counter())[first(a)] += 1
                after.setdefault(w, Counter())[first(b)] += 1
    own = {}
    for w in before:
        gains, a = [], first(w)
        for k in classes:
            sign = -1 if k == a else 1  # out of its class, or into another
            change = lambda x, n: sign * (h(x + sign * n) - h(x))  # noqa: B023, E731
            gains.append(round(
                sum(change(table[c, k], n) for c, n in before[w].items())
                + sum(change(table[k, c], n) for c, n in after[w].items())
                - change(rows_of[k], count[w]) - change(columns_of[k], count[w]), 9))
        best = int(np.argmax(gains))
        own[w] = a if gains[best] <= gains[a] + 1e-9 else best
    of = lambda w: own.get(w, first(w))
    table = pairs(train, of)
    rows_of, columns_of = Counter(), Counter()
    for (a, b), n in table.items():
        rows_of[a] += n
        columns_of[b] += n
    members = Counter(of(w) for w in count)
    tokens, types = sum(count.values()), len(count)
    weight = min(max(tokens / (tokens + 2 * lm.CLASSES ** 2), 0.01), 0.98)
    scores = []
    for _, text in rows:
        s, total = text.lower().encode().split() + [lm.END], 0.0
        for a, w in zip([lm.END, *s], s, strict=False):
            c, d = of(a), of(w)
            unigram = (count[w] + A) / (tokens + A * (types + 1))
            transition = (table[c, d] + A) / (rows_of[c] + A * lm.CLASSES)
            emission = (count[w] + A) / (columns_of[d] + A * (members[d] + 1))
            total += math.log10(weight * transition * emission + (1 - weight) * unigram)
        scores.append(total)
    return scores


def test_scores_are_those_of_a_plain_computation(make_docs):
    rng = random.Random(11)
    names = [f"w{i}{rng.choice('abcdefgh')}" for i in range(3_000)]
    weights = [1 / (i + 5) for i in range(len(names))]
    rows = [(i, " ".join(rng.choices(names, weights, k=rng.randint(0, 120)))) for i in range(240)]
    rows += [(500, "never seen Before w0x"), (501, ""), (502, rows[3][1].upper())]
    want = plain_scores(rows)
    got = {r.doc_id: r.score for r in lm.perplexity(make_docs(rows)).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(want, abs=1e-6)


def test_endings_of_many_words_at_once():
    words = [b"a", b"\xff", b"ab", b"word", "naïve".encode(), b"x" * 100]
    column = pa.array([b"skipped", *words], pa.binary()).slice(1)
    assert lm.units_of_rare(column).tolist() == [lm.unit_of_rare(w) for w in words]


def test_binary_columns_come_back(spark):
    values = [b"", b"abc", b"", b"de"]
    data, bounds = lm.bytes_of(pa.array([b"zz", *values], pa.binary()).slice(1))
    assert lm.binaries(data, bounds).to_pylist() == values
    assert lm.binaries(*lm.bytes_of(pa.array([], pa.binary()))).to_pylist() == []
    assert lm.binaries(*lm.bytes_of(pa.array([b"", b""], pa.binary()))).to_pylist() == [b"", b""]


def test_a_word_whose_rows_fill_several_batches_is_placed_once(spark, make_docs):
    rng = random.Random(5)
    names = [f"n{i}" for i in range(2_500)]
    rows = [(i, " ".join([*rng.choices(names, k=40), "zq"])) for i in range(200)]
    docs = make_docs(rows).repartition(8)
    counts = lm.word_counts(docs)
    model, table, _ = lm._start(docs, counts, "text", lm.CLASSES)
    want = sorted(map(tuple, lm.placed(docs, model, table).collect()))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = sorted(map(tuple, lm.placed(docs, model, table).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want and len({w for w, _, _ in got}) == len(got)
    n = dict(map(tuple, counts.collect()))
    assert all(n[w] == k for w, k, _ in got)
