"""Filter audit against counting document by document."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from featuremart.llm import filter_audit
from tests.llm.conftest import words


def failed(rows):
    """The letters each row fails, in order."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        letters = "A" * (len(found) < 100) + "B" * (100 * len(set(found)) < 80 * len(found))
        letters += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        smaller = doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)
        out.append(letters + "E" * smaller)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = failed(rows)
    out = {}
    for part in {r[3] or "" for r in rows}:
        inside = [(r[0], f) for r, f in zip(rows, fails) if (r[3] or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = inside
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in inside) - len(gone), sum(f == name for _, f in inside),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name]
        for key, value in out.items():
            if key[0] == part:
                value[6] = shapley[value[6]]
    return out


def run(spark, docs, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = filter_audit.audit(docs, known).collect()
    found = {(r["part"], r.filter_order, r.step): [r[c] for c in columns] for r in rows}
    assert len(found) == len(rows)
    return found


def many_rows():
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = words(rng, rng.choice([20, 98, 99, 100, 130, 300]))
        if rng.random() < 0.3:
            text = [w.upper() if rng.random() < 0.4 else w for w in text]
        if rng.random() < 0.3:
            text[0] += rng.choice("#$%&*|")
        if rng.random() < 0.3:
            text = [f"{w}{j}" for j, w in enumerate(text)]
        rows.append((i, " ".join(text), "a", rng.choice(["de", "en", "", None])))
    rows += [(200 + i, rows[rng.randrange(40)][1], "a", rng.choice(["de", None])) for i in range(60)]
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_equal_to_counting(spark, make_docs, odd_rows, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(filter_audit, "HOT_ROWS", 2)
        monkeypatch.setattr(filter_audit, "SHARE", 1_000_000)
    rows = many_rows() + [(*r, "fr") for r in odd_rows] + [(None, None, "a", "fr"), (300, "", "a", "xx")]
    rng = random.Random(6)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 260, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9_999, 1, 1)]
    docs = make_docs(rows)
    for name in ("part", "bits", "hash", "words", "salt", "salts", "good", "toxic", "id", "n", "spread"):
        docs = docs.selectExpr("*", f"'old' AS {name}") if name not in docs.columns else docs
    assert run(spark, docs, labels) == brute(rows, labels)


def test_a_copy_of_a_hash_is_compared_by_text(spark, make_docs, monkeypatch):
    """Different texts of one hash are no copies."""
    real = filter_audit.F.xxhash64
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *c: filter_audit.F.lit(1).cast("long") if c == ("text",) else real(*c))
    rows = [(1, "one", "a", "en"), (2, "two", "a", "en"), (3, "one", "a", "en")]
    found = run(spark, make_docs(rows), [])
    assert found == brute(rows, [])
    assert found["en", "EABCD", 1][1] == 1


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs([(1, "a", "a", "en")]).limit(0), []) == {}
