"""Near copies of the pipeline against brute-force Jaccard similarity of five-word shingles."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from featuremart.llm import similar
from featuremart.llm.common import spaced_words
from tests.llm.conftest import words


def grams(text):
    found = spaced_words((text or "").encode())
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def smallest_of_components(rows):
    """Smallest id of each group, null where it has none."""
    sets = [grams(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return Counter(min((x for x in g if x is not None), default=None) for g in groups.values())


def changed(rng, text, places):
    copy = list(text)
    for place in places:
        copy[place] = f"changed{place}x{rng.randint(0, 9)}"
    return copy


def test_planted_near_copies_go_and_nothing_else(spark, make_docs, odd_rows):
    rng = random.Random(11)
    rows = [*odd_rows, (None, odd_rows[0][1], "z"), (None, "so ka", "a")]  # null and repeated ids, repeated rows
    for i in range(60):  # copies with one to eight changed words, similarities on both sides of the line
        text = words(rng, rng.randint(90, 260))
        rows.append((1000 + 10 * i, " ".join(text)))
        for j in (1, 2):
            rows.append((1000 + 10 * i + j, " ".join(changed(rng, text, rng.sample(range(len(text)), rng.randint(1, 8))))))
    df = make_docs(rows)
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert kept.columns == df.columns
    found, want = Counter(r.doc_id for r in kept.collect()), smallest_of_components(rows)
    assert not want - found  # nothing goes that shouldn't
    assert sum((found - want).values()) <= 0.1 * (len(rows) - sum(want.values()))


@pytest.mark.parametrize("direct", [32, 6])
def test_near_copies_among_texts_that_share_most_of_their_words(make_docs, direct):
    """Texts with a boilerplate just below the line share their signatures; the pairs among them are found."""
    rng = random.Random(12)
    base = words(rng, 400)
    rows = [(i, " ".join([*base, *(f"own{i}x{j}" for j in range(100))])) for i in range(300)]
    pairs = []
    for i in range(40):
        text = [*base, *(f"pair{i}x{j}" for j in range(100))]
        rows += [(1000 + 2 * i, " ".join(text)), (1001 + 2 * i, " ".join(changed(rng, text, range(0, 400, rng.choice([40, 60, 90])))))]
        pairs.append(1001 + 2 * i)
    kept = {r.doc_id for r in similar.keep_one(make_docs(rows), direct=direct).collect()}
    want = set(smallest_of_components(rows))
    assert want == {r[0] for r in rows} - set(pairs)
    assert want <= kept and len(kept - want) <= 4


@pytest.mark.parametrize("direct", [32, 4])
def test_a_large_group_of_near_copies_is_one(make_docs, direct):
    rng = random.Random(13)
    base = words(rng, 200)
    rows = [(i, " ".join(base[:i] + [f"changed{i}"] + base[i + 1:])) for i in range(120)]
    rows += [(500 + i, " ".join([*base[:100], *words(rng, 100)])) for i in range(40)]  # a shared passage only
    kept = Counter(r.doc_id for r in similar.keep_one(make_docs(rows), direct=direct).collect())
    assert kept == smallest_of_components(rows) == Counter([0, *range(500, 540)])


def test_a_chain_of_near_copies_is_one_group(make_docs):
    rng = random.Random(14)
    text = words(rng, 150)
    rows = []
    for i in range(50):  # each differs from the next a little, the ends wholly
        text = changed(rng, text, [(3 * i) % 150, (3 * i + 1) % 150])
        rows.append((i, " ".join(text)))
    assert len(similar.keep_one(make_docs(rows), direct=4).collect()) == 1


@pytest.mark.parametrize("block", [1_024, 7])
def test_exact_comparison_connects_what_is_similar(spark, block):
    """Sets around a common core, some similar, in one group; against all pairs."""
    rng = random.Random(15)
    core = rng.sample(range(10_000), 150)
    rows = []
    for i in range(60):
        own = set(core) | set(rng.sample(range(10_000), 40))
        rows.append((10 * i, sorted(own)))
        for j in range(rng.randint(0, 2)):
            rows.append((10 * i + 1 + j, sorted(set(rng.sample(sorted(own), len(own) - 15)) | set(rng.sample(range(10_000), 25)))))
    rows = [(sig, 0 if sig in (0, 10) else sig, values) for sig, values in rows]
    sets = spark.createDataFrame(rows, "sig long, root long, shingles array<long>")
    found = similar.apart(sets, sets.selectExpr("0L AS first", "sig"), block=block).collect()
    near = [(x, y) for i, (x, rx, a) in enumerate(rows) for y, ry, b in rows[:i]
            if rx != ry and len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))]

    def groups(pairs):
        parent = {sig: root for sig, root, _ in rows}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for x, y in pairs:
            parent[find(x)] = find(y)
        out = {}
        for sig, _, _ in rows:
            out.setdefault(find(sig), set()).add(sig)
        return sorted(map(sorted, out.values()))

    assert near and groups((r.a, r.b) for r in found) == groups(near)
    assert len(found) <= 2 * len(rows) * (1 if block > 100 else 20)


def test_nothing(make_docs):
    assert similar.keep_one(make_docs([])).count() == 0
    assert [r.doc_id for r in similar.keep_one(make_docs([(2, None), (1, ""), (None, " \n")])).collect()] == [1]


def test_proposals_do_not_depend_on_how_rows_arrive():
    """Runs of all lengths over batches of all sizes: pairs of small groups, members of large ones."""
    rng = np.random.default_rng(1)
    lengths = [1, 2, 3, 40, 4, 5, 1, 90, 33, 2, 32, 1, 60]
    key = np.repeat(np.arange(len(lengths)), lengths)
    sig = np.arange(len(key)) * 7
    check = np.where(rng.random(len(key)) < 0.2, -1, rng.integers(0, 8, len(key)))
    columns = [pa.array(x) for x in (key, sig, check, np.full(len(key), 100))]
    whole = pa.RecordBatch.from_arrays(columns, names=["signature", "sig", "check", "size"])

    def run(size):
        parts = [whole.slice(at, size) for at in range(0, len(key), size)]
        rows = [r for b in similar._propose(iter(parts), 0.8, 32) for r in b.to_pylist()]
        pairs = {(max(r["x"], r["y"]), min(r["x"], r["y"])) for r in rows if r["kind"] != 1}
        return pairs, sorted((r["x"], r["y"]) for r in rows if r["kind"] == 1)

    want = set()
    for k in range(len(lengths)):
        at = np.flatnonzero(key == k)
        for i in at if len(at) <= 32 else at[:1]:
            want |= {(sig[j], sig[i]) for j in at if j > i and int(check[i] ^ check[j]) & (2**64 - 1) in range(16)}
    members = sorted((sig[np.flatnonzero(key == k)[0]], s) for k, s in zip(key, sig) if lengths[k] > 32)
    for size in (1, 7, 1_000):
        assert run(size) == (want, members)


def test_proposals_of_a_group_over_many_chunks():
    key = np.sort(np.r_[np.zeros(200_000, int), np.arange(1, 50_000)])
    sig = np.arange(len(key))
    columns = [pa.array(x) for x in (key, sig, np.zeros(len(key), int), np.full(len(key), 9))]
    whole = pa.RecordBatch.from_arrays(columns, names=["signature", "sig", "check", "size"])
    rows = [b for b in similar._propose((whole.slice(at, 10_000) for at in range(0, len(key), 10_000)), 0.8, 32)]
    table = pa.Table.from_batches(rows).to_pydict()
    pairs = [(y, x) for k, x, y in zip(table["kind"], table["x"], table["y"]) if k == 2]
    assert sorted(pairs) == [(i, 0) for i in range(1, 200_000)]
    assert table["kind"].count(1) == 200_000


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_segments_find_pairs_with_the_stated_probability(similarity):
    rng = np.random.default_rng(2)
    for texts in (1_000, 1 << 18, 1 << 24):
        cut, found = similar.layout(texts), 0
        for _ in range(120):
            n = int(rng.integers(60, 500))
            both = round(similarity * n)
            values = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            middle = both + (n - both) // 2
            margins = [similar.votes(x, cut.blocks) for x in (values[:middle], np.r_[values[:both], values[middle:]])]
            used = cut.bits * cut.segments
            apart = ((margins[0] > 0) != (margins[1] > 0))[:used].reshape(cut.segments, -1)
            weak = (similar.weakest(margins[0], cut) & similar.weakest(margins[1], cut))[:used].reshape(cut.segments, -1)
            found += bool(((apart.sum(1) == 0) & weak.any(1) | (apart.sum(1) == 1) & (apart & weak).any(1)).any())
        assert found >= 0.88 * 120


@pytest.mark.parametrize("members", [8, 32])
def test_a_dense_group_lists_no_more_pairs_than_members(members):
    """All members of one signature are close: they are written with their first, not pair by pair."""
    sig = np.arange(members, dtype=np.int64)
    key, same = np.full(members, 7, np.int64), np.zeros(members, np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (key, sig, same, same + 100)], names=["signature", "sig", "check", "size"])
    found = Counter()
    for out in similar._propose(iter([batch]), 0.8, 32, similar.LISTED):
        found.update(zip(*(c.to_pylist() for c in out.columns), strict=True))
    assert found == Counter([(1, 0, i) for i in range(members)] + [(2, 0, i) for i in range(1, members)])


def test_a_group_with_few_close_pairs_lists_them():
    """Pairs of a sparse group, and of two groups of a batch only the dense one's members."""
    sig = np.arange(16, dtype=np.int64)
    key = np.repeat(np.array([3, 9], np.int64), 8)
    check = np.r_[np.zeros(2), np.full(6, -1), np.zeros(8)].astype(np.int64)
    size = np.r_[100, 100, 1000 * 2 ** np.arange(6), np.full(8, 100)].astype(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (key, sig, check, size)], names=["signature", "sig", "check", "size"])
    found = {tuple(r.values()) for out in similar._propose(iter([batch]), 0.8, 32, similar.LISTED) for r in out.to_pylist()}
    assert found == {(0, 1, 0), *((1, 8, i) for i in range(8, 16)), *((2, 8, i) for i in range(9, 16))}


def test_dense_groups_end_as_brute_force_says(make_docs):
    """A cluster in which some pairs are similar and most are only alike."""
    rng = random.Random(16)
    base = words(rng, 200)
    rows = [(i, " ".join(changed(rng, base, rng.sample(range(200), rng.randint(1, 9))))) for i in range(120)]
    found = Counter(r.doc_id for r in similar.keep_one(make_docs(rows)).collect())
    want = smallest_of_components(rows)
    assert not want - found and sum((found - want).values()) <= 0.1 * (len(rows) - sum(want.values()))
