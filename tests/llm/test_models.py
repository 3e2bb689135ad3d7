"""Toxicity, neighbours and chat formatting: held-out quality, recall and round trips."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.llm import chat, neighbours, toxicity
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def toxic_docs(spark, make_docs, odd_rows):
    rng = random.Random(8)
    rows, marks = list(odd_rows), []
    for i in range(900):
        text = words(rng, rng.randint(5, 80))
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["Zorgon", "blaxen,", "ZORG" + rng.choice("abcdef") * 3]))
        rows.append((1_000 + i, " ".join(text), "a", rng.choice(["en", "fr", None])))
        if i % 3 < 2 or toxic:
            marks.append((1_000 + i, 1, int(toxic)))
    marks += [(None, 1, 1), (1_000, 0, None), (77_777, 1, 1), (1_005, 1, 1)]
    return make_docs(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), len(rows)


def test_toxicity_on_held_out_rows(toxic_docs):
    docs, labels, count = toxic_docs
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    assert set(docs.columns) - {"score"} <= set(scored.columns)
    rows = scored.collect()
    assert len(rows) == count and all(0 <= r["score"] <= 1 for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r["score"], (r.doc_id - 1_000) % 5 == 0) for r in rows if r.doc_id is not None and r.doc_id >= 1_000]
    toxic, fine = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in toxic for b in fine]) > 0.95
    assert truth and all(r.rejected == (r["score"] >= r.threshold) for r in rows)


def test_score_depends_on_the_text_only(toxic_docs):
    docs, labels, _ = toxic_docs
    model = toxicity.fit(docs, labels, epochs=1)
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 5).withColumn("source", F.lit(None))
    a = sorted(r["score"] for r in toxicity.score(docs, model).select("score").collect())
    b = sorted(r["score"] for r in toxicity.score(changed.repartition(3), model).select("score").collect())
    assert len(a) == len(b) and np.abs(np.subtract(a, b)).max() < 1e-4


def test_chunks_do_not_change_a_score(monkeypatch):
    vocabulary = toxicity.Vocabulary()
    rng = random.Random(1)
    texts = [vocabulary.ids(" ".join(words(rng, n)).encode()) for n in (0, 1, 2, 50, 700)]
    model = toxicity.train(texts * 6, vocabulary.pieces(), np.array([0, 0, 1, 0, 1] * 6), [None] * 30, epochs=2)
    whole = model.scores(texts, vocabulary.pieces())
    monkeypatch.setattr(toxicity, "CHUNK", 16)
    assert np.allclose(whole, model.scores(texts, vocabulary.pieces()), atol=1e-5)


def test_toxicity_without_labels_or_rows(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, None), (2, ""), (3, "ka lo")])
    model = toxicity.fit(docs, labels)
    assert len({round(r["score"], 9) for r in toxicity.score(docs, model).collect()}) == 1
    assert toxicity.score(make_docs([]), model).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    base = centres[rng.integers(0, 12, 4_000)] + 0.5 * rng.normal(size=(4_000, 16))
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(base)]
    rows += [(10_000 + i, rows[0][1], 1) for i in range(60)]  # many copies of a query
    rows += [(20_000, None, 1), (20_020, [0.0] * 16, 1), (20_040, [None] + [1.0] * 15, 1), (20_060, [float("nan")] * 16, 1),
             (20_080, [float("inf")] * 16, 1), (None, rows[3][1], 1), (20_100, [1.0, 2.0], 1), (20_120, [], 1), rows[40], rows[40]]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def test_neighbours_reach_the_recall(vectors):
    rows, df = vectors
    got = neighbours.search(df, lambda x: x % 20 == 0).collect()
    good = {r[0]: r[1] for r in rows if r[0] is not None and (r[0] < 20_000)}
    ids, matrix = np.array(list(good)), np.array(list(good.values()), float)
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    assert set(by_query) == {i for i in good if i % 20 == 0}
    hits = total = 0
    for q, found in by_query.items():
        scores = matrix @ np.array(good[q])
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits += len(set(best) & {v for v, _, _ in found})
        total += len(best)
        assert [n for _, _, n in found] == list(range(1, 21)) and q not in {v for v, _, _ in found}
        assert [(-s, v) for v, s, _ in found] == sorted((-s, v) for v, s, _ in found)
        for v, s, _ in found:
            assert s == pytest.approx(float(np.dot(good[q], good[v])), rel=1e-12, abs=1e-12)
    assert hits / total >= 0.9
    copies = [v for v, _, _ in by_query[10_000]]
    assert copies == [0, *range(10_001, 10_020)] or len(set(copies)) == 20


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(2_000, 8)) + 4 * rng.integers(0, 2, (2_000, 8))
    label = neighbours.balanced_parts(points, neighbours.neighbour_graph(points, 10), 16)
    sizes = np.bincount(label, minlength=16)
    assert sizes.max() <= 1.06 * 125 + 1 and sizes.min() >= 0.9 * 125


def test_neighbours_of_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in neighbours.search(few, lambda x: x % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.search(none, lambda x: x % 20 == 0).count() == 0


RECORDS = [
    ({"prompt": "a", "response": "b"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"response": "b", "prompt": "a", "system": "s"}, "prompt", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"instruction": "i", "input": "n", "output": "o"}, "instruction", [("user", "i\n\nn"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": None}]}, "messages",
     [("user", "x"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]}, "conversations",
     [("user", "x"), ("assistant", "y")]),
    ({"messages": []}, "messages", []),
    ({"data": {"prompt": "p", "response": "r"}}, "nested_prompt", [("user", "p"), ("assistant", "r")]),
    ({"role": "tool", "text": "t"}, "turn", [("tool", "t")]),
    ({"unknown": 1}, None, None),
]


def test_layouts_are_recognised_by_fingerprint(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(90, None), (91, "no json"), (92, "[1]"), (93, "")]
    df = spark.createDataFrame(rows, "id int, payload string").withColumn("turns", F.lit("old"))
    got = {r.id: r for r in chat.canonical_turns(df).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        found = None if got[i].turns is None else [(t.role, t.text) for t in got[i].turns]
        assert (got[i].layout, found) == (layout, turns)
    assert all(got[i].layout is None and got[i].turns is None for i in (90, 91, 92, 93)) and got[8].fingerprint


TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s> [ROLE] [\\ROLE]", "<s><s>", "[/ROLE]<", "</", "a\\", "é\n😀", None]


def test_format_round_trip_and_mask(spark):
    rows = [(i % 3, i, r, t) for i, (r, t) in enumerate((r, t) for t in TEXTS for r in ("user", "assistant", "[/ROLE]", None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(df).collect()
    for r in formatted:
        assert chat.read_turn(r.formatted) == (r.role or "", r.text or "")
        loss = chat.unescape(r.formatted[r.loss_start:r.loss_start + r.loss_length])
        assert loss == ((r.text or "") if r.role == "assistant" else "")
    whole = "".join(r.formatted for r in sorted(formatted, key=lambda r: r.turn))
    assert chat.read_conversation(whole) == [(r[2] or "", r[3] or "") for r in rows]
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df), ["turn"]).collect()}
    for c in range(3):
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_turns(df.limit(0)), ["turn"]).count() == 0
