"""Sharding, mixing and decontamination against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from featuremart.llm import decontaminate, mixing, sharding
from featuremart.llm.common import plain_words, spaced_words


def test_feistel_is_a_permutation_and_invertible():
    for rows in (1, 2, 3, 7, 64, 65, 1000, 1025):
        places = [sharding.place_of(i, rows, seed=3) for i in range(rows)]
        assert sorted(places) == list(range(rows))
        assert [sharding.row_number_at(p % 16, p // 16, rows, seed=3) for p in places] == list(range(rows))
    assert [sharding.place_of(i, 1000, 1) for i in range(50)] != [sharding.place_of(i, 1000, 2) for i in range(50)]


def test_shards_follow_the_law_and_the_computed_places(make_docs, odd_rows):
    df = make_docs(odd_rows)
    for parts in (1, 7):
        rows = sharding.shard_rows(df.repartition(parts), ["doc_id", "text", "source"], shards=4).collect()
        assert len(rows) == len(odd_rows)
        assert sorted(r.row_number for r in rows) == list(range(len(rows)))
        sizes = Counter(r["shard"] for r in rows)
        assert max(sizes.values()) - min(sizes.values()) <= 1
        for r in rows:
            place = sharding.place_of(r.row_number, len(rows))
            assert (r.shard, r.slot) == (place % 4, place // 4)
        found = sorted((str(r.doc_id), str(r.text), str(r.source), r.shard, r.slot) for r in rows)
        assert parts == 1 or found == before
        before = found


def test_sharding_of_nothing(make_docs):
    assert sharding.shard_rows(make_docs([]), ["doc_id"]).count() == 0


def level_targets(sizes, share=1.5):
    """Budget dealt by weight; what is above twice a size is dealt again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    target, left = dict.fromkeys(order, 0.0), share * sum(sizes.values())
    while left > 1e-9:
        free = [s for s in order if target[s] < 2 * sizes[s] - 1e-9]
        total = sum(weight[s] for s in free)
        extra = 0.0
        for s in free:
            target[s] += left * weight[s] / total
            if target[s] > 2 * sizes[s]:
                extra += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
        left = extra
    return target


def test_mixture_hits_every_budget(make_docs, odd_rows):
    rows = mixing.taken(make_docs(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    sizes, took = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        took[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    assert Counter(r["size"] for r in rows) == Counter(len(spaced_words((t or "").encode())) for _, t, *_ in odd_rows)
    want = level_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for source, target in want.items():
        assert 0 <= target - took[source] < 1 + 1e-6
    again = mixing.taken(make_docs(odd_rows).repartition(5)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter((r.doc_id, r["size"], r.taken) for r in rows)


def test_mixed_rows_hold_the_taken_words(make_docs, odd_rows):
    df = make_docs(odd_rows)
    plan, mixed = mixing.taken(df).collect(), mixing.mix(df)
    assert mixed.columns == df.columns
    words = defaultdict(int)
    texts = {t for _, t, *_ in odd_rows if t}
    cut = 0
    for r in mixed.collect():
        words[r.source] += len(spaced_words(r.text.encode()))
        if r.text not in texts:
            cut += 1
            assert any(t.startswith(r.text) for t in texts)
    took = defaultdict(int)
    for r in plan:
        took[r.source] += r.taken
    assert words == {s: n for s, n in took.items() if n}
    assert cut <= len(took)


def test_one_source_may_hold_nearly_all(make_docs):
    rows = [(i, "ka lo mi ne so", "big") for i in range(200)] + [(900, "one two", "x"), (901, None, "y"), (902, "", "z")]
    got = {r.source: r.target for r in mixing.taken(make_docs(rows)).collect()}
    assert got["z"] == got["y"] == 0 and got["x"] == 4 and got["big"] == pytest.approx(1.5 * 1002 - 4)
    assert mixing.taken(make_docs([])).count() == 0 and mixing.mix(make_docs([])).count() == 0


BENCHMARK = [
    (7, "one two three four five six seven eight nine ten eleven twelve"), (8, "short item"), (9, None), (10, "... !"),
    (None, "null owner words"), (8, "short item"), (11, "Two THREE four, five six seven eight nine ten eleven"),
]


def brute_hits(text, items):
    words, hit, owners = plain_words((text or "").encode()), set(), set()
    for item, value in items:
        grams = plain_words((value or "").encode())
        n = min(10, len(grams))
        for i in range(len(grams) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == grams[i:i + n]:
                    hit.update(range(j, j + n))
                    owners.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(owners)


@pytest.fixture(scope="module")
def leaky(odd_rows):
    inner = "two three four five six seven eight nine ten eleven"
    return [*odd_rows, (200, f"x {inner} y", "a"), (201, f"{inner} twelve, {inner.upper()}", "a"),
            (202, "a SHORT-item; short  items short", "a"), (203, "null owner words", "b"),
            (204, "one two three four five six seven eight nine", "b"), (205, BENCHMARK[0][1] + " short item", "b")]


@pytest.mark.parametrize("block_words", [2_000_000, 4])
def test_decontamination_equals_brute_force(spark, make_docs, leaky, block_words):
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    rows = decontaminate.scan(make_docs(leaky), bench, block_words=block_words).collect()
    got = Counter((r.doc_id, r.text, r.n_words, sum(b - a for a, b in zip(r.hit_starts, r.hit_ends)), tuple(r["items"]))
                  for r in rows)
    want = Counter()
    for i, t, *_ in leaky:
        n, hit, owners = brute_hits(t, BENCHMARK)
        want[(i, t, n, hit, tuple(owners))] += 1
    assert got == want


def test_many_items_may_share_a_passage():
    passage = b"ka lo mi tu ne so ka ka lo lo"
    found = decontaminate.WindowSet([(str(i), passage) for i in range(20_000)] * 2, 10)
    (owners,) = found.windows[10].values()
    assert list(owners) == [str(i) for i in range(20_000)]


def test_cleaning_drops_or_cuts(spark, make_docs, leaky):
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    df = make_docs(leaky)
    dirty = [t for _, t, *_ in leaky if brute_hits(t, BENCHMARK)[1]]
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and kept.count() == len(leaky) - len(dirty)
    assert not [r for r in kept.collect() if r.text in dirty]
    cut = decontaminate.clean(df, bench, remove="spans").collect()
    assert len(cut) == len(leaky)
    texts = {r.doc_id: r.text for r in cut}
    assert texts[200] == "x \n y" and texts[202] == "a \n; \ns short" or "short items" not in texts[202]
    assert texts[204] == leaky[-2][1] and texts[100] is None and texts[101] == ""
    with pytest.raises(ValueError):
        decontaminate.clean(df, bench, remove="nothing")


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(make_docs([]), none).count() == 0
    rows = decontaminate.scan(make_docs([(1, "ka lo")]), none).collect()
    assert rows[0].n_words == 2 and rows[0].hit_starts == [] and rows[0]["items"] == []


def test_sharding_digest_matches_hashlib(spark):
    value = spark.range(5).select("id", sharding._mixed(F.col("id"), F.lit(2), 9, F.lit(97)).alias("m")).collect()
    assert [r.m for r in value] == [int(hashlib.md5(f"9:2:{i}".encode()).hexdigest()[:15], 16) % 97 for i in range(5)]
