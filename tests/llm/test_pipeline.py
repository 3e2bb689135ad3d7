"""The pipeline's stages on the smallest table, each against brute force on its own input."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from featuremart.llm import mixing, toxicity
from featuremart.llm.common import spaced_words, table
from featuremart.llm.queries import ORACLES, QUERIES
from tests.llm.test_rows import brute_hits, level_targets
from tests.llm.test_similar import smallest_of_components

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_feistel_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op2_licenses": {"doc_id", "template", "containment", "first_word", "last_word"},
    "op3_neighbours": {"query_id", "rank", "vec_id", "score"},
    "op4_class_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op5_chat": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op6_simhash": {"doc_id", "fingerprint", "component_id"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op8_mixture": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_repeats": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op10_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op11_topk": {"query_id", "rank", "vec_id", "score"},
    "op12_filter_audit": {"part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                          "toxic_lost", "shapley"},
    "op13_structure": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
}
PER_DOCUMENT = [q for q in CONTRACT if "doc_id" in CONTRACT[q] and q != "op2_licenses"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before and after each stage; every stage's rows are written and read again."""
    out = {"documents": table(spark, SMALL, "documents")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns(steps):
    want = steps["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name].columns == want
    assert steps["sharding"].columns == [*want, "shard", "slot"]


def test_toxic_documents_go(spark, steps):
    docs = steps["documents"]
    model = toxicity.fit(docs, table(spark, SMALL, "labels"))
    scored = toxicity.score(docs, model).select("doc_id", "rejected").collect()
    kept = {r.doc_id for r in steps["toxicity"].collect()}
    assert kept == {r.doc_id for r in scored if not r.rejected}
    clean = {r.doc_id for r in table(spark, SMALL, "labels").where("toxic = 0").collect()} & {r.doc_id for r in scored}
    assert len(clean - kept) <= 0.1 * len(clean)


def test_one_document_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps["toxicity"].collect()]
    found, want = Counter(r.doc_id for r in steps["simhash"].collect()), smallest_of_components(before)
    assert not want - found  # nothing goes that shouldn't
    assert sum((found - want).values()) <= 0.1 * (len(before) - sum(want.values()))


def test_contaminated_documents_go(spark, steps):
    bench = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    want = {r.doc_id for r in steps["simhash"].collect() if not brute_hits(r.text, bench)[1]}
    assert {r.doc_id for r in steps["decontamination"].collect()} == want


def test_mixture_meets_its_targets(steps):
    sizes, took = defaultdict(int), defaultdict(int)
    for r in steps["decontamination"].collect():
        sizes[r.source] += len(spaced_words((r.text or "").encode()))
    mixed = steps["mixture"].collect()
    for r in mixed:
        took[r.source] += len(spaced_words(r.text.encode()))
        assert r.n_chars == len(r.text)
    assert all(0 <= target - took[s] < 1 + 1e-6 for s, target in level_targets(sizes).items())
    assert mixing.SHARE == 1.5


def test_shards_are_even_and_gapless(steps):
    rows = steps["sharding"].collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in steps["mixture"].collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_queries_return_their_columns(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert CONTRACT[name] <= set(df.columns)
    if name in PER_DOCUMENT:
        assert df.count() == table(spark, SMALL, "documents").count()


def test_queries_and_sql_are_registered():
    assert set(CONTRACT) | {"pipeline"} == set(QUERIES) and set(ORACLES) <= set(QUERIES)
