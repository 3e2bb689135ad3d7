"""Benchmark decontamination: a broadcast set of test n-grams against windows of training words."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm.common import WORD_TABLE, arrow_map, as_bytes, plain_words, slices
from featuremart.session import removed, shared_folder

WINDOW = 10
#: Words of benchmark items in one broadcast; a larger benchmark is scanned in several passes.
BLOCK_WORDS = 2_000_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WindowSet:
    """All windows of some items, as numbers of the items' own words."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, dict[str, None]]] = {}
        for item, text in items:
            words = plain_words(text)
            if not words:
                continue
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32)
            length = min(window, len(ids))
            of_length = self.windows.setdefault(length, {})
            for i in range(len(ids) - length + 1):
                of_length.setdefault(ids[i:i + length].tobytes(), {})[item] = None
        self.hashes = {
            length: np.unique(np.concatenate([_rolling(np.frombuffer(w, np.int32), length) for w in found]))
            for length, found in self.windows.items()
        }

    def find(self, ids: np.ndarray):
        """(start, length, items) of every window in word numbers; 0 is any other word."""
        blanks = np.r_[0, np.cumsum(ids == 0)]
        for length, hashes in self.hashes.items():
            if len(ids) < length:
                continue
            starts = np.flatnonzero(blanks[length:] == blanks[:-length])
            if not len(starts):
                continue
            values = _rolling(ids, length)[starts]
            at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
            for start in starts[hashes[at] == values]:
                items = self.windows[length].get(ids[start:start + length].tobytes())
                if items:
                    yield int(start), length, items


def _rolling(ids: np.ndarray, length: int) -> np.ndarray:
    values = np.zeros(len(ids) - length + 1, np.uint64)
    wide = ids.astype(np.uint64)
    for i in range(length):
        values = values * _BASE + wide[i:len(ids) - length + 1 + i]
    return values


def _blocks(benchmark: DataFrame, id_column: str, text: str, block_words: int):
    """The items, some two million words at a time, so that no broadcast grows with the benchmark."""
    items = benchmark.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(r["item"], r["text"].encode() if r["text"] is not None else None) for r in part.collect()]


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, hit_starts and hit_ends (word positions of merged hit runs) and items.

    Every run of ``window`` words of an item is a window; an item of fewer words, but
    not none, is one window.  Null and empty texts have no words; an item without words
    has no window.  A null item id is listed as ``null``.  Repeated items are one item.
    An empty benchmark hits nothing.  Columns of ``docs`` with the names of results are
    replaced.  Documents are not shuffled.  A benchmark of several blocks is scanned block
    by block: each holds one broadcast, and the rows are written in between.
    """
    spark: SparkSession = docs.sparkSession
    names = ("n_words", "hit_starts", "hit_ends", "items")
    base = [c for c in docs.columns if c not in names]
    state = docs.select(*base).withColumns({
        "n_words": F.lit(0).cast("long"), "hit_starts": F.lit(None).cast("array<int>"),
        "hit_ends": F.lit(None).cast("array<int>"), "items": F.lit(None).cast("array<string>")})
    schema = state.schema
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    shared, folder = None, None
    for items in _blocks(benchmark, item_id, item_text, block_words):
        if shared is not None:  # one block is live at a time: what the last one found is written
            before, folder = folder, shared_folder(spark, "scan")
            state.write.parquet(folder)
            state = spark.read.schema(schema).parquet(folder)
            shared.destroy()
            if before is not None:
                removed(spark, before)
        shared = spark.sparkContext.broadcast(items)
        state = arrow_map(state, _scanner(shared, window, text, base, names), declared)
    return state


def _scanner(shared, window: int, text: str, base: list[str], names: tuple[str, ...]) -> Callable:
    """Adds what one block's items hit to each batch."""
    made: list[WindowSet] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(WindowSet(shared.value, window))
        out: dict[str, list] = {c: [] for c in names}
        for part in slices(batch, text):
            _scan_part(made[0], as_bytes(part.column(text)), part, out)
        return {c: batch.column(c) for c in base} | out

    return run


def _scan_part(windows: WindowSet, texts: list[bytes | None], part: pa.RecordBatch, out: dict[str, list]) -> None:
    number = windows.numbers.get
    ids, ends = [], []
    for value in texts:
        ids += [number(w, 0) for w in plain_words(value)]
        ends.append(len(ids))
        ids.append(0)  # windows never cross documents
    ids = np.array(ids, np.int32)
    ends = np.array(ends)
    starts = np.r_[0, ends[:-1] + 1]
    found: dict[int, tuple[list, set]] = {}
    for start, length, items in windows.find(ids):
        row = int(np.searchsorted(ends, start, side="right"))
        spans, owners = found.setdefault(row, ([], set()))
        first = start - int(starts[row])
        spans.append((first, first + length))
        owners.update(items)
    before = [part.column(c).to_pylist() for c in ("hit_starts", "hit_ends", "items")]
    for row in range(len(texts)):
        spans, owners = found.get(row, ([], set()))
        old = [x[row] or [] for x in before]
        merged: list[list[int]] = []
        for first, last in sorted([*zip(old[0], old[1]), *spans]):
            if merged and first <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        out["n_words"].append(int(ends[row] - starts[row]))
        out["hit_starts"].append([m[0] for m in merged])
        out["hit_ends"].append([m[1] for m in merged])
        out["items"].append(sorted(owners.union(old[2])))


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """``docs`` without benchmark passages, with the columns of ``docs``.

    ``remove="documents"`` drops every document with a hit, ``remove="spans"`` cuts the
    hit words out and leaves a line break for each run.  Documents without a hit, null
    and empty texts included, stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[text].alias("_text"))
    found = scan(inner, benchmark, text="_text", **options)
    if remove == "documents":
        return found.where(F.size("hit_starts") == 0).select("_row.*")

    def run(batch: pa.RecordBatch) -> dict:
        spans = zip(*(batch.column(c).to_pylist() for c in ("hit_starts", "hit_ends")), strict=True)
        return {"_row": batch.column("_row"),
                "_text": [cut_words(t, *s) for t, s in zip(as_bytes(batch.column("_text")), spans, strict=True)]}

    kind = inner.schema["_row"].dataType.simpleString()
    out = arrow_map(found.select("_row", "_text", "hit_starts", "hit_ends"), run, f"_row {kind}, _text string")
    return out.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def cut_words(text: bytes | None, starts: list[int], ends: list[int]) -> str | None:
    """The text without the bytes from the first to the last word of each run."""
    if text is None or not starts:
        return None if text is None else text.decode()
    places = [m.span() for m in _WORD.finditer(text.translate(WORD_TABLE))]
    out, at = [], 0
    for first, last in zip(starts, ends, strict=True):
        out.append(text[at:places[first][0]])
        at = places[last - 1][1]
    return b"\n".join([*out, text[at:]]).decode()
