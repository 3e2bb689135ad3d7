"""Queries of the operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from featuremart.llm import (
    chat, decontaminate, filter_audit, licenses, lm, mixing, neighbours, repeats, sharding, simhash, structure, topk,
    toxicity,
)
from featuremart.llm.common import crc_of_id, table

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("content"))
    dealt = sharding.shard_rows(rows, ["doc_id", "size", "text_crc32", "content"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query
def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.perplexity(table(spark, sf_dir, "documents"))


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.to_json(F.struct(*(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))).alias("payload"))
    words = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct(words.alias("prompt"), words.alias("response"))).alias("payload"))
    turns = chat.canonical_turns(rows.union(extra)).select("conv_id", "turn", F.posexplode("turns").alias("part", "t"))
    return chat.digests(chat.format_turns(turns.select("conv_id", "turn", "part", "t.role", "t.text")), ["turn", "part"])


_ESCAPED = r"length(regexp_replace({}, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g'))"
ORACLES["op5_chat"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length('<s>[ROLE][/ROLE]</s>') + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id
"""


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", (crc_of_id("doc_id") % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "rejected")


@query
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op8_mixture"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':'
             || coalesce(text, '')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS capacity FROM r),
f AS (SELECT *, capacity / weight AS fill FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
        - coalesce(sum(capacity) OVER (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY fill, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, coalesce(least(capacity, weight * (
        SELECT level FROM l WHERE level < fill ORDER BY fill, rank LIMIT 1)), capacity) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size,
       CAST(floor(target - epochs * source_size) AS BIGINT) - before)) AS BIGINT) AS taken FROM p
"""


@query
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "removed")


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
    return found.select(
        "doc_id", "n_words", hits.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_starts") > 0).alias("contaminated"))


_PLAIN = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLES["op10_decontaminate"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_PLAIN} AS words FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_PLAIN} AS words FROM benchmark),
n AS (SELECT item, words, least(10, len(words)) AS n FROM b WHERE len(words) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS gram
      FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM n)),
v AS (SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram
      FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM n) WHERE len(words) >= n)),
h AS (SELECT row, i, v.n, item FROM v JOIN g ON v.n = g.n AND v.gram = g.gram),
k AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM h) GROUP BY row),
m AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT row, item FROM h) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (row) LEFT JOIN m USING (row)
"""


@query
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


ORACLES["op11_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)) AS ints FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
e AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
f AS (
  SELECT part, CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
         + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(e.first < d.doc_id, false) AS INT) AS bits,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d JOIN e USING (text) LEFT JOIN l ON d.doc_id = l.doc_id),
n AS (SELECT part, bits, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY part, bits),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT v.name || w.name || x.name || y.name || z.name AS filter_order,
             [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
      FROM b v, b w, b x, b y, b z WHERE v.bit | w.bit | x.bit | y.bit | z.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
c AS (
  SELECT part, filter_order, step, own,
         CAST(coalesce(sum(n) FILTER (bits & (before | own) = 0), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before = 0), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before <> 0), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (bits = own), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n.good) FILTER (bits & own <> 0 AND bits & before = 0), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n.toxic) FILTER (bits & own <> 0 AND bits & before = 0), 0) AS BIGINT) AS toxic_lost
  FROM n, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM c
"""


@query
def op13_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    audits, turns = structure.repair(structure.damage(rows), rows)
    hashes = structure.digests(turns)
    return audits.join(hashes.alias("h"), audits["conv_id"].eqNullSafe(hashes["conv_id"]), "left").select(
        audits["conv_id"], *[c for c in audits.columns if c != "conv_id"],
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


ORACLES["op13_structure"] = r"""
WITH RECURSIVE
z AS (SELECT list(c ORDER BY i) AS crc FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                        lambda c, x: xor(c // 2, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) AS c
  FROM (SELECT unnest(range(256)) AS i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda b: ascii(b)::BIGINT)),
        lambda c, b: xor(c // 256, crc[(xor(c, b) & 255) + 1]))) % 20 AS hurt FROM k, z),
d AS (SELECT conv_id, turn, CASE WHEN hurt = 4 THEN 'user' ELSE role END AS role,
             CASE hurt WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN hurt = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM h WHERE hurt <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
             coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1), 'ua') AS pair FROM n),
c AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
             count_if(blank) AS blank, count_if(NOT blank AND again) AS duplicate,
             count_if(NOT blank AND NOT again AND cut) AS truncated,
             count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
ins(a, b, cost, letters, said) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 2, 3, 'I', chr(10) || 'user:')),
nxt(a, r, b, name) AS (VALUES (0, 's', 1, ''), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'),
                              (3, 'u', 2, 'user')),
ed AS (SELECT a, b, 'K' AS letter, 0 AS cost, r, name FROM nxt UNION ALL SELECT a, b, 'R', 3, r, name FROM nxt WHERE r <> 's'
       UNION ALL SELECT DISTINCT a, a, 'D', 4, '', '' FROM ins),
rec AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0, 'audit': '', 'said': ''} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT rec.conv_id, f.i, ed.b, min({
    'cost': rec.best.cost + ins.cost + ed.cost + CASE WHEN ed.letter <> 'D' AND f.cut THEN 3 ELSE 0 END,
    'audit': rec.best.audit || ins.letters || ed.letter,
    'said': rec.best.said || ins.said || CASE ed.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
                                         ELSE chr(10) || ed.name || ':' || f.text END})
  FROM rec JOIN f ON f.conv_id IS NOT DISTINCT FROM rec.conv_id AND f.i = rec.i + 1
  JOIN ins ON ins.a = rec.s
  JOIN ed ON ed.a = ins.b AND (ed.letter = 'D' OR NOT (f.blank OR f.again) AND (ed.letter = 'R' OR ed.r = f.initial))
  GROUP BY rec.conv_id, f.i, ed.b),
e AS (SELECT rec.conv_id, rec.i, min({'cost': best.cost + ins.cost, 'audit': best.audit || ins.letters,
                                      'said': best.said || ins.said}) AS best
      FROM rec JOIN ins ON ins.a = rec.s AND ins.b IN (0, 3) GROUP BY rec.conv_id, rec.i)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost,
       best.audit AS audit, sha256(substr(best.said, 2)) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(c.n, 0)
"""
