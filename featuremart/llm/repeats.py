"""Exact substring deduplication over an enhanced suffix array of anchored suffixes.

Every string of ``length`` bytes holds an anchor: the window's k-gram with the smallest
hash, which depends on the string alone.  So equal strings hold equal anchors at the same
place, and it is enough to sort the suffixes that start at anchors, each with the bytes
before it.  Anchors with equal k-grams meet in a shuffle; there a stack scan over the
common prefixes of neighbouring suffixes gives the tree of common-prefix intervals, and
a second scan over the bytes before them tests each interval's left extensions.  The
result are all maximal repeats with all their occurrences.

A suffix is sorted with LENGTH - GRAM bytes on either side of its anchor: no string of
LENGTH bytes that holds the anchor reaches further.  Longer repeats have several anchors,
and their pieces join when ranges are merged.  Suffixes that are equal in that whole
context are one leaf of the tree with a count; such a leaf is an interval by itself, so
only leaves whose anchor has other contexts too are sorted against those.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, as_bytes, slices, written

LENGTH = 200
#: Bytes of an anchor; a window has LENGTH - GRAM + 1 of them.
GRAM = 64
#: Different contexts of one anchor that are sorted together; more are split by half contexts first.
TOGETHER = 4_096
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = [(1 << i, np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF | 1)) for i in range(6)]


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Smallest or largest value of every ``width`` neighbours."""
    have, out = 1, values
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    return best(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, k-gram hash) of the anchors of texts of ``length`` bytes or more."""
    numbers = [i for i, t in enumerate(texts) if len(t) >= length]
    nothing = np.empty(0, np.int64)
    if not numbers:
        return nothing, nothing, np.empty(0, np.uint64)
    sizes = np.array([len(texts[i]) for i in numbers])
    ends = np.cumsum(sizes)
    whole = np.frombuffer(b"".join([texts[i] for i in numbers]), np.uint8)
    rolled = _TABLE[whole]
    for step, factor in _STEPS:
        rolled = rolled[:-step] * factor + rolled[step:]
    mixed = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed |= np.uint64(1)
    least = _sliding(mixed, length - GRAM + 1, np.minimum)
    for end in ends[:-1]:  # windows that reach into the next text are none
        least[max(0, end - length + 1):end] = 0
    padded = np.concatenate([np.zeros(length - GRAM, np.uint64), least, np.zeros(length - GRAM, np.uint64)])
    places = np.flatnonzero(_sliding(padded, length - GRAM + 1, np.maximum) == mixed)
    owner = np.searchsorted(ends, places, side="right")
    return np.array(numbers)[owner], places - (ends - sizes)[owner], mixed[places]


def _text_key(text: str) -> list[Column]:
    """Two columns that identify a text: equal texts are treated alike."""
    value = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return [F.xxhash64(value).alias("t"),
            F.shiftleft(F.crc32(value), 31).bitwiseXOR(F.octet_length(value).cast("long")).alias("c")]


def occurrences(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(h, g, places) of all anchors: hash of the k-gram, of its context, and t, c, place of each.

    Equal contexts of one slice of a task are one row, so that very frequent passages
    shrink before the shuffle.  A place is position * 2^18 + bytes before * 2^9 + bytes behind.
    """
    reach = length - GRAM

    def run(batch: pa.RecordBatch) -> dict:
        hs, gs, rows, flat = [], [], [0], []
        for part in slices(batch, "_text", 1 << 20):
            texts = [x or b"" for x in as_bytes(part.column("_text"))]
            t, c = part.column("t").to_pylist(), part.column("c").to_pylist()
            met: dict[tuple[int, int], list[int]] = {}
            owners, positions, hashes = anchors(texts, length)
            for i, q, h in zip(owners.tolist(), positions.tolist(), hashes.view(np.int64).tolist(), strict=True):
                value = texts[i]
                before, behind = min(q, reach), min(len(value) - q - GRAM, reach)
                g = xxhash.xxh64_intdigest(value[q - before:q + GRAM + behind], before)
                met.setdefault((h, g), []).extend((t[i], c[i], q << 18 | before << 9 | behind))
            for (h, g), places in met.items():
                hs.append(h)
                gs.append(g)
                flat += places
                rows.append(len(flat))
        return {"h": np.array(hs, np.int64), "g": np.array(gs, np.uint64).view(np.int64),
                "places": pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(flat, pa.int64()))}

    inner = docs.select(*_text_key(text), F.col(text).alias("_text"))
    return arrow_map(inner, run, "h long, g long, places array<long>")


def repeated(found: DataFrame) -> DataFrame:
    """Occurrences of k-grams that occur again, with n (of this context) and contexts (more than one)."""
    of_gram, of_context = Window.partitionBy("h"), Window.partitionBy("h", "g")
    count = F.size("places") / 3
    return (
        found.withColumn("all", F.sum(count).over(of_gram))
        .withColumn("contested", F.min("g").over(of_gram) != F.max("g").over(of_gram))
        .withColumn("n", F.sum(count).over(of_context))
        .where("all > 1").select("h", "g", "places", "n", "contested")
    )


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, depth) of the common-prefix intervals of a sorted list, by a stack scan.

    ``common[i]`` is the common prefix of entries i and i + 1.  Only depths of ``least``
    or more are reported.
    """
    stack: list[tuple[int, int]] = []  # depth, first
    for i, depth in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            if top >= least:
                yield first, i, top
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))


def _ordered(values: list[bytes]) -> tuple[list[int], list[int]]:
    """Indices in sorted order, and the common prefix of each with the next one."""
    order = sorted(range(len(values)), key=values.__getitem__)
    return order, [_common(values[a], values[b]) for a, b in zip(order, order[1:])]


def interval_tree(suffixes: list[bytes], ranks: list[int]) -> Iterator[tuple[int, list[int], list[tuple[int, int]]]]:
    """(depth, ranks, pairs) of each common-prefix interval of GRAM bytes or more, inner ones first.

    The stack holds, besides each open interval's depth, the ranks of its members in
    order.  Where two intervals meet, the shorter list is inserted into the longer one, so
    that a member moves at most as often as its list doubles; ``pairs`` are the ranks that
    became neighbours by that.  The list is only valid until the next interval.
    """
    order, common = _ordered(suffixes)
    stack: list[tuple[int, list[int], list[tuple[int, int]]]] = []

    def met(a: list[int], b: list[int], pairs: list[tuple[int, int]]) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for rank in b:
            at = bisect_left(a, rank)
            if at:
                pairs.append((a[at - 1], rank))
            if at < len(a):
                pairs.append((rank, a[at]))
            a.insert(at, rank)
        return a

    for i, depth in enumerate([*common, -1]):
        members = [ranks[order[i]]]
        while stack and stack[-1][0] > depth:
            top, waiting, pairs = stack.pop()
            members = met(waiting, members, pairs)
            if top >= GRAM:
                yield top, members, pairs
        if stack and stack[-1][0] == depth:
            top, waiting, pairs = stack.pop()
            stack.append((top, met(waiting, members, pairs), pairs))
        else:
            stack.append((depth, members, []))


def maximal_repeats(suffixes: list[bytes], lefts: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes from the anchor on, members) of repeats of ``length`` bytes or more.

    ``lefts`` are the bytes before each suffix, backwards.  A group holds all occurrences
    of a string that neither a byte before nor behind extends for all of them.
    """
    by_left, _ = _ordered(lefts)
    for depth, ranked, _ in interval_tree(suffixes, _inverse(by_left)):
        members = [by_left[r] for r in ranked]
        before = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        need = max(0, length - depth)
        if max(before) < need:
            continue
        for low, high, reach in intervals(before, need):
            group = members[low:high + 1]
            if len(group) < len(members):  # does the part still differ behind?
                if min(len(suffixes[i]) for i in group) > depth and len({suffixes[i][depth] for i in group}) == 1:
                    continue  # no: it is a group of a deeper interval
            yield reach, depth, group


def _inverse(order: list[int]) -> list[int]:
    ranks = [0] * len(order)
    for rank, i in enumerate(order):
        ranks[i] = rank
    return ranks


def covered(suffixes: list[bytes], lefts: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """Bytes before and behind (from the anchor on) of each member that its maximal repeats cover.

    Of the groups that an interval gives a member, the one with the longest left extension
    joins it with a neighbour in left order.  Neighbours of an inner interval were tested
    there, with more bytes behind; so only the pairs that meet in an interval are tested,
    and no group is spelled out.
    """
    by_left, _ = _ordered(lefts)
    out: list[tuple[int, int] | None] = [None] * len(suffixes)
    for depth, _, pairs in interval_tree(suffixes, _inverse(by_left)):
        need = max(0, length - depth)
        for pair in pairs:
            a, b = by_left[pair[0]], by_left[pair[1]]
            if lefts[a][:need] != lefts[b][:need] or len(lefts[a]) < need:
                continue
            reach = _common(lefts[a], lefts[b])
            for i in (a, b):
                old = out[i]
                if old is None:
                    out[i] = (reach, depth)
                elif old[0] < reach or old[1] < depth:
                    out[i] = (max(old[0], reach), max(old[1], depth))
    return out


def contexts(docs: DataFrame, again: DataFrame, text: str, length: int) -> DataFrame:
    """(h, side, part, g, before, whole): one context of each kind, for k-grams in several contexts.

    Contexts of very frequent k-grams are split by their half contexts: two of them with
    a common string of ``length`` bytes share the half behind or the half before.
    """
    reach = length - GRAM
    half = reach // 2
    one = (
        again.where("contested").select("h", "g", F.struct(
            F.col("places")[0].alias("t"), F.col("places")[1].alias("c"), F.col("places")[2].alias("place")).alias("at"))
        .groupBy("h", "g").agg(F.min("at").alias("at"))
    )
    kinds = one.withColumn("kinds", F.count("*").over(Window.partitionBy("h")))
    wanted = kinds.select("at.t", "at.c", F.struct("h", "g", "at.place", "kinds").alias("a")).groupBy("t", "c").agg(
        F.collect_list("a").alias("wanted"))
    once = Window.partitionBy("t", "c").orderBy("c")
    texts = docs.select(*_text_key(text), F.col(text).alias("_text")).join(wanted, ["t", "c"]).withColumn(
        "_n", F.row_number().over(once)).where("_n = 1").select("_text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("h", "side", "part", "g", "before", "whole")}
            for value, asked in zip(as_bytes(batch.column("_text")), batch.column("wanted").to_pylist(), strict=True):
                for a in asked:
                    q, before, behind = a["place"] >> 18, a["place"] >> 9 & 511, a["place"] & 511
                    whole = value[q - before:q + GRAM + behind]
                    keys = [(0, 0)]
                    if a["kinds"] > TOGETHER:
                        keys = []
                        if behind >= half:
                            keys.append((1, xxhash.xxh64_intdigest(whole[before:before + GRAM + half]) >> 1))
                        if before >= half:
                            keys.append((2, xxhash.xxh64_intdigest(whole[before - half:before + GRAM]) >> 1))
                    for side, part in keys:
                        for c, x in zip(out, (a["h"], side, part, a["g"], before, whole), strict=True):
                            out[c].append(x)
                if len(out["h"]) > 20_000:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out = {c: [] for c in out}
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("h", pa.int64()), ("side", pa.int32()), ("part", pa.int64()), ("g", pa.int64()),
                        ("before", pa.int32()), ("whole", pa.binary())])
    return texts.mapInArrow(run, "h long, side int, part long, g long, before int, whole binary")


def partial_matches(found: DataFrame, length: int) -> DataFrame:
    """(h, g, before, behind): what repeats with other contexts cover of each kind of context."""
    ordered = found.repartition("h", "side", "part").sortWithinPartitions("h", "side", "part", "g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        out: dict[str, list] = {c: [] for c in ("h", "g", "before", "behind")}

        def flush() -> None:
            if len(members) < 2:
                return
            spans = covered([w[b:] for _, b, w in members], [w[:b][::-1] for _, b, w in members], length)
            for (g, _, _), span in zip(members, spans, strict=True):
                if span:
                    for c, x in zip(out, (key[0], g, span[0], span[1] - GRAM), strict=True):
                        out[c].append(x)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "side", "part", "g", "before", "whole")]
            for h, side, part, g, before, whole in zip(*columns, strict=True):
                if (h, side, part) != key:
                    flush()
                    key, members = (h, side, part), []
                members.append((g, before, whole))
            if len(out["h"]) > 50_000:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out = {c: [] for c in out}
        flush()
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("before", pa.int32()), ("behind", pa.int32())])
    return ordered.mapInArrow(run, "h long, g long, before int, behind int").groupBy("h", "g").agg(
        F.max("before").alias("before"), F.max("behind").alias("behind"))


def repeat_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(t, c, spans): covered byte ranges (first, end) of each text that has some, not yet merged."""
    again = written(repeated(occurrences(docs, text, length)), "anchors")
    partial = partial_matches(contexts(docs, again, text, length), length)
    whole = again.where("n > 1").select("places")
    single = again.where("n = 1 AND contested").join(partial, ["h", "g"]).select(
        "places", "before", "behind")

    def placed(df: DataFrame, before: str, behind: str) -> DataFrame:
        triples = F.expr("transform(sequence(0, size(places) - 1, 3), i -> "
                         "struct(places[i] AS t, places[i + 1] AS c, places[i + 2] AS place))")
        return (
            df.withColumn("p", F.explode(triples))
            .selectExpr("p.t", "p.c", "shiftright(p.place, 18) AS q", f"{before} AS before", f"{behind} AS behind")
            .where(f"before + behind >= {length - GRAM}")
            .selectExpr("t", "c", "struct(CAST(q - before AS INT) AS first, "
                        f"CAST(q + {GRAM} + behind AS INT) AS end) AS span")
        )

    spans = placed(whole, "(shiftright(p.place, 9) & 511)", "(p.place & 511)").union(
        placed(single, "before", "behind"))
    return spans.groupBy("t", "c").agg(F.collect_set("span").alias("spans"))


def cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal removed ranges."""
    merged: list[tuple[int, int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans or ()):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    kept, at = [], 0
    for first, end in merged:
        kept.append(text[at:first])
        at = end
    return b"".join([*kept, text[at:]]), merged


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept, removed) of every row.

    Removed is each byte that a string of ``length`` bytes covers which starts anywhere
    else too, in the same text or another; ranges are (first, end) byte positions of the
    input.  ``kept`` are the remaining bytes.  Null texts are empty, texts shorter than
    ``length`` keep everything, and rows with equal texts, repeated rows included, repeat
    each other.
    """
    keyed = docs.select(F.col(id_column).alias("_id"), *_text_key(text), F.col(text).alias("_text"))
    joined = keyed.join(repeat_spans(docs, text, length), ["t", "c"], "left").select("_id", "_text", "spans")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed")}
        for value, spans in zip(as_bytes(batch.column("_text")), batch.column("spans").to_pylist(), strict=True):
            value = value or b""
            kept, removed = cut(value, spans)
            for c, x in zip(out, (len(value), len(value) - len(kept), len(removed), hashlib.sha256(kept).hexdigest(),
                                  kept, [{"first": a, "end": b} for a, b in removed]), strict=True):
                out[c].append(x)
        return {id_column: batch.column("_id")} | out

    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(
        joined, run, f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "kept binary, removed array<struct<first: int, end: int>>")
