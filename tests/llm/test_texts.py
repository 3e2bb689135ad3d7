"""SimHash, substring repeats, license scans and the language model against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from featuremart.llm import licenses, lm, repeats, simhash
from featuremart.llm.common import plain_words, spaced_words
from featuremart.llm.components import connected_components
from tests.llm.conftest import words


def slow_fingerprint(text, width=3):
    found = spaced_words((text or "").encode())
    grams = [found[i:i + width] for i in range(len(found) - width + 1)] if len(found) >= width else [found] if found else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(fps, ids):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


def test_simhash_equals_brute_force(make_docs, odd_rows):
    rng = random.Random(5)
    near = words(rng, 300)
    rows = [*odd_rows, *((300 + i, " ".join(near[:i] + ["changed"] + near[i + 1:])) for i in range(40))]
    got = simhash.near_duplicates(make_docs(rows)).select(
        "doc_id", simhash.hex_digits().alias("f"), "component_id").collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = zip((r[0] for r in rows), (f"{f:016x}" for f in fps), components(fps, [r[0] for r in rows]))
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize("direct", [512, 4])
def test_links_connect_clouds_of_fingerprints(spark, monkeypatch, direct):
    """A dense cloud around one value, chains and lone values; the index of large groups too."""
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = {centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 14) for b in range(20, 34) for c in (40, 41)}
    values |= {rng.getrandbits(64) for _ in range(300)}
    chain = rng.getrandbits(64)
    for i in range(0, 60, 2):
        chain ^= 3 << i
        values.add(chain)
    values = sorted(values)
    monkeypatch.setattr(simhash, "DIRECT", direct)
    run = np.array(sorted(v for v in values if (v ^ centre) >> 32 & 0xFFFFFFFF in (0, 1 << 8)), np.uint64)
    links = [x for part in simhash._refine(run, list(range(32))) for x in zip(*(p.tolist() for p in part))]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(df)).collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    assert [roots.get(s, s) for s in signed] == components(values, signed)


def test_refined_groups_keep_all_components():
    rng = random.Random(2)
    values = np.array(sorted({(7 << 33) | sum(1 << rng.randrange(32) for _ in range(2)) for _ in range(900)}), np.uint64)
    got = {int(v): int(v) for v in values}

    def find(x):
        while got[x] != x:
            x = got[x]
        return x

    for a, b in ((a, b) for part in simhash._refine(values, list(range(32))) for a, b in zip(*part)):
        got[find(int(a))] = find(int(b))
    ours = {}
    for v in values.tolist():
        ours.setdefault(find(v), []).append(v)
    theirs = {}
    for v, c in zip(values.tolist(), components(values.tolist(), values.tolist()), strict=True):
        theirs.setdefault(c, []).append(v)
    assert sorted(ours.values()) == sorted(theirs.values())


def test_one_of_each_group_stays(make_docs, odd_rows):
    df = make_docs(odd_rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    fps = [slow_fingerprint(r[1]) for r in odd_rows]
    groups = {}
    for row, f in zip(odd_rows, components(fps, list(range(len(fps)))), strict=True):
        groups.setdefault(f, []).append(row)
    got = kept.collect()
    assert len(got) == len(groups)
    smallest = [min((r[0] for r in g if r[0] is not None), default=None) for g in groups.values()]
    assert Counter(r.doc_id for r in got) == Counter(smallest)


def test_simhash_of_nothing(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0 and simhash.keep_one(make_docs([])).count() == 0


def slow_cut(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("together", [4096, 1])
def test_repeats_equal_brute_force(make_docs, odd_rows, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = random.Random(9)
    passages = [" ".join(words(rng, 50)) for _ in range(4)]
    line = " ".join(words(rng, 22))[:150]
    mixed = [(400 + i, " ".join(x for _ in range(4) for x in (
        " ".join(words(rng, rng.randint(0, 30))), rng.choice(passages)[rng.randint(0, 40):rng.randint(180, 400)],
        line))) for i in range(40)]
    rows = [*odd_rows, *mixed]
    got = repeats.remove_repeats(make_docs(rows)).collect()
    want = slow_cut([(r[1] or "").encode() for r in rows], 200)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(
        (r[0], *w) for r, w in zip(rows, want, strict=True))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_maximal_repeats_have_all_occurrences():
    anchor = b"A" * repeats.GRAM
    suffixes = [anchor + b"xyz1", anchor + b"xyz2", anchor + b"xy", anchor + b"q"]
    lefts = [b"cba", b"cbz", b"cba", b"cba"]
    found = {(b, d - repeats.GRAM, tuple(sorted(g))) for b, d, g in repeats.maximal_repeats(suffixes, lefts, repeats.GRAM + 2)}
    # right depth 3 of the first two, 2 of the first three, 0 of all; each with its left extensions
    assert (2, 3, (0, 1)) in found and (2, 2, (0, 1, 2)) in found and (3, 2, (0, 2)) in found
    assert (3, 0, (0, 2, 3)) in found and (2, 0, (0, 1, 2, 3)) in found


@pytest.mark.parametrize("letters, longest, most", [(b"ab", 6, 25), (b"abc", 3, 60), (b"a", 40, 30)])
def test_covered_bytes_equal_every_pair_and_the_groups(letters, longest, most):
    rng = random.Random(11)
    anchor = b"A" * repeats.GRAM
    length = repeats.GRAM + 4

    def side():
        return bytes(rng.choice(letters) for _ in range(rng.randint(0, longest)))

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for _ in range(40):
        kinds = sorted({(side(), side()) for _ in range(rng.randint(2, most))})
        lefts, suffixes = [k[0] for k in kinds], [anchor + k[1] for k in kinds]
        every = [[(common(lefts[i], lefts[j]), common(suffixes[i], suffixes[j])) for j in range(len(kinds)) if j != i]
                 for i in range(len(kinds))]
        long = [[p for p in pairs if sum(p) >= length] for pairs in every]
        want = [(max(p[0] for p in x), max(p[1] for p in x)) if x else None for x in long]
        groups = [[] for _ in kinds]
        for before, behind, group in repeats.maximal_repeats(suffixes, lefts, length):
            for i in group:
                groups[i].append((before, behind))
        of_groups = [(max(p[0] for p in x), max(p[1] for p in x)) if x else None for x in groups]
        assert repeats.covered(suffixes, lefts, length) == want == of_groups


def test_nested_intervals_move_few_members():
    anchor = b"A" * repeats.GRAM
    suffixes = [anchor + b"x" * i for i in range(2_000)]  # every context is an interval of its own, inside the others
    left = [bytes([i % 251, i % 241]) for i in range(2_000)]
    by_left = sorted(range(2_000), key=left.__getitem__)
    pairs = sum(len(p) for _, _, p in repeats.interval_tree(suffixes, repeats._inverse(by_left)))
    assert pairs <= 2 * 2_000 * 11


def test_repeats_of_nothing(make_docs):
    assert repeats.remove_repeats(make_docs([])).count() == 0


def test_licenses_are_found_and_nothing_else(make_docs, odd_rows):
    notice = licenses.TEMPLATES["mit-permission"]
    broken = notice.replace("free of charge", "free of any charge")
    rng = random.Random(4)
    rows = [*odd_rows, (500, f"{' '.join(words(rng, 70))} {notice} {' '.join(words(rng, 33))}"), (501, broken.upper()),
            (502, "Released under the MIT License."), (503, "released under the mit"), (504, notice[:60]),
            (505, " ".join(words(rng, 17)) + "\nLicensed under the Apache License, Version 2.0.\n")]
    got = {(r.doc_id, r.template) for r in licenses.scan(make_docs(rows)).collect()}
    want = set()
    for i, t, *_ in rows:
        have = set(licenses.shingles(plain_words((t or "").encode())))
        for name, text in licenses.TEMPLATES.items():
            s = set(licenses.shingles(plain_words(text.encode())))
            if len(s & have) >= 0.8 * len(s):
                want.add((i, name))
    assert got == want and {(500, "mit-permission"), (501, "mit-permission"), (502, "mit-line")} <= got
    assert licenses.scan(make_docs([])).count() == 0 and licenses.scan(make_docs(rows), {}).count() == 0


def test_bands_guarantee_retrieval():
    for count in (1, 3, 8, 20, 60):
        block = licenses.Templates.block(count)
        shared = math.ceil(0.8 * count - 1e-9)
        similarity = shared / (2 * block + count - shared)
        assert block >= count and (1 - similarity) ** licenses.bands_for(count, block) <= licenses.MISS


@pytest.fixture(scope="module")
def scored(make_docs, odd_rows):
    rng = random.Random(6)
    common = words(rng, 30)
    rows = [*odd_rows, *((600 + i, " ".join(rng.choice(common) for _ in range(60))) for i in range(60))]
    return rows, lm.perplexity(make_docs(rows)).collect()


def test_base_score_and_counts_equal_brute_force(scored, monkeypatch):
    rows, got = scored
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    tokens = [spaced_words((r[1] or "").encode()) + [b"\n"] for r in rows]
    counts = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    total, types = sum(counts.values()), len(counts)
    want = Counter((r[0], h, len(t), sum(w in counts for w in t), total, round(sum(
        math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t), 6))
        for r, h, t in zip(rows, held, tokens, strict=True))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_classes_help_and_are_finite(scored):
    _, got = scored
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_joined(make_docs, odd_rows, monkeypatch):
    whole = lm.perplexity(make_docs(odd_rows)).collect()
    monkeypatch.setattr(lm, "KNOWN", 3)
    joined = lm.perplexity(make_docs(odd_rows)).collect()
    key = lambda r: (str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6))
    assert Counter(map(key, whole)) == Counter(map(key, joined))


def test_exchange_separates_alternating_words():
    bigrams = np.zeros((8, 8), np.int64)
    for a in range(8):
        for b in range(8):
            bigrams[a, b] = 50 if a % 2 != b % 2 else 1
    label = lm.exchange(bigrams, classes=2)
    assert len(set(label[::2])) == 1 and len(set(label[1::2])) == 1 and label[0] != label[1]


def test_model_is_a_distribution(make_docs):
    """Over known tokens and one unseen token per class the class part sums to one at most."""
    docs = make_docs([(1, "ka lo ka mi"), (2, "lo ka"), (3, "mi mi ka so")])
    train = docs.select("text")
    counts = lm.word_counts(train)
    model = lm.fit(train, counts, classes=4)
    n = {bytes(r["word"]): r["n"] for r in counts.collect()}
    units = {w: model.classes[model.units.of(w)] for w in n}
    for before in set(model.classes.tolist()):
        total = sum((n[w] + lm.ALPHA) / model.denominator * 10 ** model.gain[before, units[w]] for w in n)
        assert 0 < total <= 1 + 1e-9


def test_language_model_of_nothing(make_docs):
    assert lm.perplexity(make_docs([])).count() == 0
    only = lm.perplexity(make_docs([(1, None)])).collect()
    assert len(only) == 1 and only[0].n_tokens == 1 and math.isfinite(only[0].score)
