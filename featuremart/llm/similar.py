"""Near copies by exact Jaccard similarity of word shingles; deletion variants of SimHash propose the pairs.

Shingle sets at similarity J differ in arccos(2J / (1 + J)) / pi of their SimHash bits: 15 %
at 0.8, which is ten of 64 bits, so that few segments of 64 bits either miss such pairs or
tell nothing apart.  The fingerprint here is as long as it takes: it is cut into so many
segments that one of them differs by at most one bit with the wanted probability, and a
segment has as many bits as the number of texts.  A segment is indexed with one of its
weakest bits wiped out, those whose votes were closest: a bit that differs between similar
texts is nearly always one of them.  Equal signatures meet in an equality shuffle, and the
similarity is verified on the shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, as_bytes, slices, spaced_words, written
from featuremart.llm.components import connected_components

WIDTH = 5
SIMILARITY = 0.8
#: Probability with which a pair at exactly the similarity is to be proposed.
RECALL = 0.95
#: Bits of a segment that are wiped out, one at a time.
WEAK = 8
#: Members of a signature whose close pairs are looked for; larger groups go through a representative and an exact index.
DIRECT = 32
#: Close pairs per member that such a group lists; one with more goes the same way as larger ones.
LISTED = 1
#: Bits beside the segments that proposed pairs are held against, and how many may differ (ten do on average at 0.8).
CHECK, CHECK_DISTANCE = 64, 21
#: First members of large groups that a set is held against before the exact comparison.
FIRSTS = 2
#: Sets of a block of the exact comparison, about.
BLOCK = 1_024
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted different hashes of the runs of ``width`` words; a shorter text is one run, none without words."""
    words = spaced_words(text)
    if not words:
        return np.empty(0, np.uint64)
    of_word = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    run = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        run = run * _ODD + of_word[i:len(words) - size + 1 + i]
    return np.unique(_mixed(run))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of different values; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


@dataclass(frozen=True)
class Layout:
    """Segments of a fingerprint; the check bits come after them."""

    bits: int
    segments: int

    @property
    def blocks(self) -> int:
        """64-bit words that hold segments and check bits."""
        return -(-(self.bits * self.segments) // 64) + CHECK // 64


def layout(texts: int, similarity: float = SIMILARITY, recall: float = RECALL) -> Layout:
    """Segments as long as the logarithm of the number of texts, as many as the recall takes.

    The share of single differing bits that are among both texts' WEAK weakest falls as the
    root of the segment's length (simulated: 0.76 at 20 bits, 0.69 at 24, 0.43 to 0.6 at 32).
    """
    bits = max(16, math.ceil(math.log2(max(2, texts))))
    apart = math.acos(2 * similarity / (1 + similarity)) / math.pi
    none, one = (1 - apart) ** bits, bits * apart * (1 - apart) ** (bits - 1)
    chance = none + one * min(1.0, WEAK / bits) ** 0.5
    return Layout(bits, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def votes(values: np.ndarray, blocks: int) -> np.ndarray:
    """For each bit the number of hashes that have it, twice, less their number."""
    total = np.zeros((blocks, 64), np.int64)
    seeds = (np.arange(1, blocks + 1, dtype=np.uint64) * _ODD)[:, None]
    for at in range(0, len(values), 255 * 16):
        mixed = _mixed(values[None, at:at + 255 * 16] + seeds)
        bits = np.unpackbits(mixed.view(np.uint8).reshape(blocks, -1, 8), axis=2, bitorder="little")
        for start in range(0, bits.shape[1], 255):  # sums of 255 ones fit a byte
            total += bits[:, start:start + 255].sum(axis=1, dtype=np.uint8)
    return (2 * total - len(values)).ravel()


def packed(flags: np.ndarray) -> list[int]:
    """Flags as signed 64-bit words."""
    return np.packbits(flags, bitorder="little").view("<i8").tolist()


def weakest(margins: np.ndarray, cut: Layout) -> np.ndarray:
    """Flags of each segment's WEAK bits with the closest votes."""
    inside = np.abs(margins[:cut.bits * cut.segments]).reshape(cut.segments, cut.bits)
    flags = np.zeros((cut.segments, cut.bits), bool)
    count = min(WEAK, cut.bits)
    np.put_along_axis(flags, np.argsort(inside, axis=1, kind="stable")[:, :count], True, axis=1)
    out = np.zeros(len(margins), bool)
    out[:flags.size] = flags.ravel()
    return out


def sketches(docs: DataFrame, keep: list[str], text: str, cut: Layout, width: int = WIDTH) -> DataFrame:
    """``keep`` and sig (equal for equal shingle sets), size, fp and weak (bits) of every row."""
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in source.dtypes if c != "_text")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"sig": [], "size": [], "fp": [], "weak": []}
        for part in slices(batch, "_text"):
            for value in as_bytes(part.column("_text")):
                found = shingles(value, width)
                margins = votes(found, cut.blocks)
                out["sig"].append(xxhash.xxh3_64_intdigest(found.tobytes()))
                out["size"].append(len(found))
                out["fp"].append(packed(margins > 0))
                out["weak"].append(packed(weakest(margins, cut)))
        out["sig"] = np.array(out["sig"], np.uint64).view(np.int64)
        return {c: batch.column(c) for c in keep} | out

    return arrow_map(source, run, schema + ", sig long, size long, fp array<long>, weak array<long>")


def signatures(sets: DataFrame, cut: Layout) -> DataFrame:
    """(signature, sig, check, size): a row for every segment and each of its weak bits, wiped out."""

    def expanded(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, weak = (np.asarray(batch.column(c).flatten(), dtype=np.int64).reshape(-1, cut.blocks) for c in ("fp", "weak"))

        def by_segment(x: np.ndarray) -> np.ndarray:
            bits = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little")[:, :cut.bits * cut.segments]
            return bits.reshape(-1, cut.segments, cut.bits)

        values = by_segment(words) @ (np.int64(1) << np.arange(cut.bits, dtype=np.int64))
        row, segment, place = np.nonzero(by_segment(weak))
        key = (values[row, segment] & ~(np.int64(1) << place)) | (place << 48) | (segment << 54)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key, np.asarray(batch.column("sig"))[row], words[row, -1],
                                   np.asarray(batch.column("size"))[row])], names=["signature", "sig", "check", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                yield expanded(batch.slice(at, 1_024))

    return sets.select("sig", "size", "fp", "weak").mapInArrow(run, "signature long, sig long, check long, size long")


def _close(check_a, check_b, size_a, size_b, similarity: float) -> np.ndarray:
    """Which pairs may have the similarity by size and check bits."""
    return (np.minimum(size_a, size_b) >= similarity * np.maximum(size_a, size_b)) & (
        np.bitwise_count((check_a ^ check_b).view(np.uint64)) <= CHECK_DISTANCE)  # of signed words it counts the absolute value's


def _together(rows: tuple[np.ndarray, ...], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (later, earlier) of the close pairs of the members of equal keys; ``rows`` are key, sig, check and size, sorted."""
    key, _, check, size = rows
    found: list = [[], []]
    step = 1
    while (same := key[step:] == key[:-step]).any():
        near = np.flatnonzero(same)
        near = near[_close(check[near + step], check[near], size[near + step], size[near], similarity)]
        found[0].append(near + step)
        found[1].append(near)
        step += 1
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in found)


def _propose(batches: Iterator[pa.RecordBatch], similarity: float, direct: int,
             listed: float = math.inf) -> Iterator[pa.RecordBatch]:
    """Close pairs (kind 0: a, b) of small groups; first and member of others, all (kind 1) and close ones (kind 2).

    A small group with more than ``listed`` close pairs per member is dense: of it, the
    members that are in such a pair are written, with the smallest of them as their first.
    So no group writes more rows per member than ``listed``, or two.
    """
    waiting: list[tuple[np.ndarray, ...]] = []
    count, open_ = 0, None  # the large group that the rows before ended in: its key and first member

    def out(kind: int, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        if kind == 0:
            x, y = np.maximum(x, y), np.minimum(x, y)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)], names=["kind", "x", "y"])

    def large(rows: tuple, first: tuple) -> Iterator[pa.RecordBatch]:
        key, sig, check, size = rows
        near = (sig != first[1]) & _close(check, first[2], size, first[3], similarity)
        yield out(2, np.full(near.sum(), first[1]), sig[near])
        yield out(1, np.full(len(sig), first[1]), sig)

    def small(rows: tuple) -> Iterator[pa.RecordBatch]:
        key, sig = rows[:2]
        later, earlier = _together(rows, similarity)
        group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
        members = np.bincount(group)
        dense = (np.bincount(group[later], minlength=len(members)) > listed * members)[group[later]]
        yield out(0, sig[later[~dense]], sig[earlier[~dense]])
        later, earlier = later[dense], earlier[dense]
        inside = np.unique(np.r_[later, earlier])
        _, start, of = np.unique(group[inside], return_index=True, return_inverse=True)
        first = np.zeros(len(key), np.int64)
        first[inside] = inside[start][of]
        yield out(1, sig[first[inside]], sig[inside])
        near = first[later] == earlier
        yield out(2, sig[earlier[near]], sig[later[near]])

    def handle(rows: tuple, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal waiting, count, open_
        waiting, count = [], 0
        if open_ is not None and len(rows[0]):
            goes_on = int(np.searchsorted(rows[0], open_[0], side="right"))
            if goes_on:
                yield from large(tuple(x[:goes_on] for x in rows), open_)
                rows = tuple(x[goes_on:] for x in rows)
            if len(rows[0]):
                open_ = None
        key = rows[0]
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lengths = np.diff(np.r_[starts, len(key)])
        if not last and lengths[-1] <= direct:  # may go on in the next rows
            waiting = [tuple(x[starts[-1]:] for x in rows)]
            count = int(lengths[-1])
            rows = tuple(x[:starts[-1]] for x in rows)
            starts, lengths = starts[:-1], lengths[:-1]
        of_row = np.repeat(lengths, lengths)
        few = (of_row > 1) & (of_row <= direct)
        if few.any():
            yield from small(tuple(x[few] for x in rows))
        for start, length in zip(starts[lengths > direct], lengths[lengths > direct], strict=True):
            member = tuple(x[start:start + length] for x in rows)
            first = tuple(x[0] for x in member)
            yield from large(member, first)
            if not last and start + length == len(rows[0]) and not waiting:
                open_ = first

    for batch in batches:
        waiting.append(tuple(c.to_numpy() for c in batch.columns))
        count += batch.num_rows
        if count >= 1 << 16:
            yield from handle(tuple(np.concatenate(x) for x in zip(*waiting, strict=True)), False)
    if waiting:
        yield from handle(tuple(np.concatenate(x) for x in zip(*waiting, strict=True)), True)


def proposed(sets: DataFrame, cut: Layout, similarity: float = SIMILARITY, direct: int = DIRECT) -> DataFrame:
    """(kind, x, y): pairs of sets that share a signature (0), first and members of large or dense groups (1), close ones (2).

    A task reads its signatures in order and keeps one small group.
    """
    ordered = signatures(sets.where("size > 0"), cut).repartition("signature").sortWithinPartitions("signature", "sig")
    return ordered.mapInArrow(partial(_propose, similarity=similarity, direct=direct, listed=LISTED), "kind int, x long, y long")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): the different pairs (x, y) whose sets (sig, shingles) have at least the similarity."""
    both = pairs.select("x", "y").distinct().join(
        sets.select(F.col("sig").alias("x"), F.col("shingles").alias("p")), "x").join(
        sets.select(F.col("sig").alias("y"), F.col("shingles").alias("q")), "y").select("x", "y", "p", "q")

    def run(batch: pa.RecordBatch) -> dict:
        p, q = batch.column("p"), batch.column("q")
        alike = np.array([jaccard(np.asarray(p[i].values), np.asarray(q[i].values)) >= similarity
                          for i in range(batch.num_rows)], bool)
        return {"a": batch.column("x").filter(pa.array(alike)), "b": batch.column("y").filter(pa.array(alike))}

    return arrow_map(both, run, "a long, b long")


def shingles_of(docs: DataFrame, key: list, text: str, places: DataFrame, width: int) -> DataFrame:
    """(sig, shingles) of the rows at ``places`` (sig, _key, _content), one row each."""
    found = docs.select(*key, F.col(text).alias("_text")).join(places, ["_key", "_content"]).select("sig", "_text")

    def run(batch: pa.RecordBatch) -> dict:
        values = [shingles(t, width).view(np.int64) for part in slices(batch, "_text") for t in as_bytes(part.column("_text"))]
        return {"sig": batch.column("sig"), "shingles": values}

    return arrow_map(found, run, "sig long, shingles array<long>").dropDuplicates(["sig"])


def _compared(block: pa.Table, similarity: float, schema: pa.Schema) -> pa.Table:
    """Links of the sets (sig, root, shingles) of a block that aren't of one root yet; as many as there are sets, at most.

    Sizes of intersections are products of the sets' rows of zeros and ones.
    """
    root, sig = (np.asarray(block.column(c)) for c in ("root", "sig"))
    if len(root) < 2 or root.min() == root.max():
        return schema.empty_table()
    lists = block.column("shingles").combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(lists), dtype=np.int64)
    _, column, count = np.unique(np.asarray(lists.flatten()), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # what one set has alone counts for no intersection
    shared = count[column] > 1
    column, row = number[column[shared]], np.repeat(np.arange(len(sizes)), sizes)[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((len(sizes), len(sizes)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4_096):
        part = slice(*np.searchsorted(column, [at, at + 4_096]))
        marks = np.zeros((len(sizes), 4_096), np.float32)
        marks[row[part], column[part] - at] = 1
        both += marks @ marks.T
    all_of = sizes[:, None] + sizes[None, :] - both.astype(np.float64)
    near = (both >= similarity * all_of) & (root[:, None] != root[None, :]) | np.eye(len(sizes), dtype=bool)
    label = np.arange(len(sizes))
    while True:
        least = np.where(near, label[None, :], len(sizes)).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(sizes))
    return pa.table([pa.array(sig[moved]), pa.array(sig[label[moved]])], schema=schema)


def apart(sets: DataFrame, groups: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(a, b): what links sets (sig, root, shingles) of different roots within ``groups`` (first, sig), exactly.

    Two sets at the similarity share one of their rarest shingles, of which a share of
    1 - similarity and one more are looked at.  So sets that share none of these with a set
    of another root leave first: a passage that many texts have in common is not rare and
    keeps nobody.  Those that stay are compared in blocks of bounded size.
    """
    long = sets.select("sig", F.explode("shingles").alias("shingle"))
    counts = long.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    size = F.size("shingles")
    kept = size - F.ceil(size * F.lit(similarity) - 1e-9) + 1
    # shingles of one set alone come first in the order of rareness
    shared = long.join(counts, "shingle").groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("rare"))
    rare = sets.select("sig", "root", size.alias("size"), kept.alias("kept")).join(shared, "sig")
    first = F.greatest(F.lit(0), F.col("kept") - (F.col("size") - F.size("rare"))).cast("int")
    # two steps read them: written, neither counts and sorts the shingles again
    rare = written(rare.select("sig", "root", F.explode(F.slice("rare", F.lit(1), first)).alias("s")).select(
        "sig", "root", "s.shingle"), "rare")
    split = rare.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most")).where(
        "least < most").select("shingle")
    members = written(groups.join(rare.join(split, "shingle", "left_semi").select("sig").distinct(), "sig"), "members")
    blocks = members.groupBy("first").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")
    dealt = members.join(blocks, "first").select("first", "sig", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "first", "sig", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return dealt.join(sets.select("sig", "root", "shingles"), "sig").groupBy("first", "low", "high").applyInArrow(
        lambda block: _compared(block, similarity, schema), "a long, b long")


def near_copy_roots(docs: DataFrame, sets: DataFrame, key: list, text: str, cut: Layout, width: int,
                    similarity: float, direct: int = DIRECT) -> DataFrame:
    """(node, root) of the sets that are linked to others, directly or not.

    Small groups of a signature list their close pairs while these are no more than the members.
    Members of large and dense ones are held against the first members of FIRSTS of them; where
    that leaves members apart, ``apart`` compares them exactly, so that no pair is lost to the
    size of a group, and none lists pairs by the square of it.
    """
    found = written(proposed(sets, cut, similarity, direct), "proposed")
    # a set is in up to WEAK such groups per segment; it is held against the smallest of their first members
    held = found.where("kind = 2").groupBy("y").agg(F.array_sort(F.collect_set("x")).alias("firsts")).select(
        F.explode(F.slice("firsts", F.lit(1), F.lit(FIRSTS))).alias("x"), "y")
    pairs = written(found.where("kind = 0").select("x", "y").union(held.select("x", "y")).distinct(), "pairs")
    members = written(found.where("kind = 1").select(F.col("x").alias("first"), F.col("y").alias("sig")).distinct(), "large")
    asked = pairs.select(F.col("x").alias("sig")).union(pairs.select("y")).union(members.select("sig")).distinct()
    places = sets.join(asked, "sig").select("sig", "best._key", "best._content")
    texts = written(shingles_of(docs, key, text, places, width), "shingles")
    roots = connected_components(verified(pairs, texts, similarity))
    of_member = members.join(roots.withColumnRenamed("node", "sig"), "sig", "left").select(
        "first", "sig", F.coalesce("root", "sig").alias("root"))
    split = of_member.groupBy("first").agg(F.min("root").alias("least"), F.max("root").alias("most")).where(
        "least < most").select("first")
    open_ = written(of_member.join(split, "first", "left_semi"), "open")
    if open_.isEmpty():
        return roots
    root_of = open_.select("sig", "root").distinct()
    linked = apart(written(texts.join(root_of, "sig"), "compared"), open_.select("first", "sig"), similarity)
    of = [root_of.select(F.col("sig").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")]
    over = connected_components(linked.join(of[0], "a").join(of[1], "b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))).select(
        F.col("node").alias("root"), F.col("root").alias("over"))
    alone = root_of.where("sig = root").select(F.col("sig").alias("node"), "root")
    return roots.union(alone).distinct().join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH,
             similarity: float = SIMILARITY, recall: float = RECALL, direct: int = DIRECT) -> DataFrame:
    """One row of each component of similar texts, with the columns of ``docs``.

    Texts are linked at Jaccard similarity ``similarity`` or more of their different
    lower-cased shingles; texts without words are equal.  A pair at exactly the similarity
    is found with probability ``recall``, closer ones more often; no other pair is linked.
    The row with the smallest id stays, a null id last; rows that share it are ordered by a
    hash of their content, and of rows equal in every column one stays.  An empty table
    gives no rows.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    key = [F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_key"),
           F.xxhash64(*[docs[c] for c in docs.columns]).alias("_content")]
    cut = layout(docs.count(), similarity, recall)
    rows = written(
        sketches(docs.select(F.col(id_column).alias("_id"), *key, F.col(text).alias("_whole")),
                 ["_id", "_key", "_content"], "_whole", cut, width), "sketches")
    order = F.struct(F.col("_id").isNull(), "_id", "_key", "_content")
    sets = written(rows.groupBy("sig").agg(
        F.min(order).alias("best"), *[F.first(c).alias(c) for c in ("size", "fp", "weak")]), "sets")
    roots = near_copy_roots(docs, sets, key, text, cut, width, similarity, direct)
    chosen = sets.join(roots.withColumnRenamed("node", "sig"), "sig", "left").groupBy(
        F.coalesce("root", "sig").alias("root")).agg(F.min("best").alias("best")).select("best._key", "best._content")
    once = Window.partitionBy("_key", "_content").orderBy("_key")
    return (docs.select(row, *key).join(chosen, ["_key", "_content"], "left_semi")
            .withColumn("_n", F.row_number().over(once)).where("_n = 1").select("_row.*"))
