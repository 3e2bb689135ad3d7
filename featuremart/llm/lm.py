"""Brown class-based n-grams: exchange clustering of words, smoothed class bigrams.

A token's probability given the one before is

    L * P(class | class before) * P(token | class)  +  (1 - L) * P(token)

with additive smoothing of every part.  Both token probabilities hold the token's count
as the same factor, so that a text's score is its unigram score plus a sum over class
bigrams.  The driver exchanges frequent words, and groups of others by ending, from a
matrix of bounded size; then every other word moves on its own to the class that its
neighbours' classes make most likely, from counts that stay in a distributed table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, arrow_parts, as_bytes, crc_of_id, slices, spaced_words, written

ALPHA = 0.1
CLASSES = 64
#: Words that the driver clusters one by one; all others start from groups of equal endings.
FREQUENT = 1_500
ENDINGS = 256
#: Words whose counts and classes every task knows; those of all others are joined.
KNOWN = 50_000
ROUNDS = 6
#: A token that no text holds: white space.
END = b"\n"


def unit_of_rare(word: bytes) -> int:
    """Group of a word outside the frequent ones: CRC32 of its last two bytes."""
    return FREQUENT + zlib.crc32(word[-2:]) % ENDINGS


@cache
def _units_of_endings() -> np.ndarray:
    """Groups of the endings of two bytes, in order, then of one."""
    every = range(256)
    return np.array([unit_of_rare(bytes(e)) for e in [*((a, b) for a in every for b in every), *((b,) for b in every)]])


def units_of_rare(words: pa.Array) -> np.ndarray:
    """`unit_of_rare` of each of an array of words."""
    data, bounds = bytes_of(words)
    last, before = data[bounds[1:] - 1].astype(np.int64), data[np.maximum(bounds[1:] - 2, 0)].astype(np.int64)
    return _units_of_endings()[np.where(np.diff(bounds) > 1, 256 * before + last, 65_536 + last)]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the bounds of its values in them."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The binary values that lie one after another in an array, in bytes cut at ``bounds``."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).cast(pa.binary())


def numbered(texts: list[bytes | None], number: Mapping[bytes, int], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the texts' words, ``end`` before the first and after each text, and the places of the ends."""
    ids = [np.array([end], np.int64)]
    places = [0]
    for value in texts:
        words = spaced_words(value)
        ids += (np.fromiter(map(number.__getitem__, words), np.int64, len(words)), ids[0])
        places.append(places[-1] + len(words) + 1)
    return np.concatenate(ids), np.array(places)


@dataclass
class Units:
    """Numbers that stand for words: one for each frequent word, one for each group of the others."""

    frequent: dict[bytes, int]

    def of(self, word: bytes) -> int:
        number = self.frequent.get(word)
        return unit_of_rare(word) if number is None else number


@dataclass
class Model:
    units: Units
    classes: np.ndarray  # of each unit
    gain: np.ndarray  # (classes, classes): log10 of a bigram's factor on the unigram probability
    known: dict[bytes, float]  # log10(count + alpha) of common words
    train_tokens: int
    types: int
    own_class: dict[bytes, int] = field(default_factory=dict)  # of common words that are not frequent

    @property
    def denominator(self) -> float:
        return self.train_tokens + ALPHA * (self.types + 1)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each token occurs; an end follows every text, null and empty ones too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for part in slices(batch, text):
                for value in as_bytes(part.column(text)):
                    counts.update(spaced_words(value))
                counts[END] += part.num_rows
                if len(counts) > 500_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _unit_memo(units: Units) -> dict[bytes, int]:
    class Memo(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) > 400_000:
                self.clear()
                self.update(units.frequent)
            self[word] = number = units.of(word)
            return number

    return Memo(units.frequent)


def unit_bigrams(docs: DataFrame, units: Units, text: str = "text") -> np.ndarray:
    """Counts of neighbouring units over all texts, the end before and after each."""
    size = FREQUENT + ENDINGS
    shared = docs.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _unit_memo(shared.value)
        end = memo[END]
        counts = np.zeros(size * size, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                ids, _ = numbered(as_bytes(part.column(text)), memo, end)
                counts += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        cells = np.flatnonzero(counts)
        for at in range(0, len(cells), 1 << 17):
            some = cells[at:at + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["cell", "n"])

    cells = docs.select(text).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    matrix = np.zeros(size * size, np.int64)
    found = cells.toArrow()  # as many rows as there are pairs of units at most
    matrix[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return matrix.reshape(size, size)


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit: units move one by one to the class that raises the likelihood most.

    The class bigram likelihood changes by the row and the column of the two classes
    that a unit leaves and enters; all entries are evaluated at once.
    """
    units = len(bigrams)
    total = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-total, kind="stable")
    label = np.empty(units, np.int64)
    label[order] = np.arange(units) % classes
    table = np.zeros((classes, classes))
    np.add.at(table, (label[:, None].repeat(units, 1), label[None, :].repeat(units, 0)), bigrams)

    def h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    forward = np.zeros((units, classes))  # counts from a unit to classes, kept up to date
    backward = np.zeros((units, classes))
    for c in range(classes):
        forward[:, c] = bigrams[:, label == c].sum(1)
        backward[:, c] = bigrams[label == c].sum(0)
    own = np.diag(bigrams).astype(float)
    after, before = bigrams.sum(1).astype(float), bigrams.sum(0).astype(float)
    rows, columns = table.sum(1), table.sum(0)
    members = np.bincount(label, minlength=classes)
    for _ in range(rounds):
        moved = 0
        for u in order:
            a = label[u]
            if not total[u] or members[a] == 1:
                continue
            f, b, s = forward[u].copy(), backward[u].copy(), own[u]
            f[a] -= s  # to other members of its class
            b[a] -= s
            table[a, :] -= f
            table[:, a] -= b
            table[a, a] -= s
            rows[a] -= after[u]
            columns[a] -= before[u]
            gain = (h(table + f[None, :]) - h(table)).sum(1) + (h(table + b[:, None]) - h(table)).sum(0)
            diagonal = np.diag(table)
            gain += (h(diagonal + f + b + s) - h(diagonal + f) - h(diagonal + b) + h(diagonal))
            gain -= h(rows + after[u]) - h(rows) + h(columns + before[u]) - h(columns)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            table[best, :] += f
            table[:, best] += b
            table[best, best] += s
            rows[best] += after[u]
            columns[best] += before[u]
            if best != a:
                moved += 1
                label[u] = best
                members[a] -= 1
                members[best] += 1
                forward[:, a] -= bigrams[:, u]
                forward[:, best] += bigrams[:, u]
                backward[:, a] -= bigrams[u]
                backward[:, best] += bigrams[u]
        if not moved:
            break
    return label


def fit(train: DataFrame, counts: DataFrame, text: str = "text", classes: int = CLASSES) -> Model:
    """Model of the texts of ``train``, whose (word, n) are ``counts``; words that aren't frequent go by ending."""
    return _start(train, counts, text, classes)[0]


def _start(train: DataFrame, counts: DataFrame, text: str, classes: int) -> tuple[Model, np.ndarray, np.ndarray]:
    """The model, its class bigrams and the different words of each class."""
    whole = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, types = int(whole[0] or 0), int(whole[1])
    is_end = F.col("word") == F.lit(END)
    common = counts.where(~is_end).orderBy(F.desc("n"), "word").limit(KNOWN).collect() + counts.where(is_end).collect()
    words = [(bytes(r["word"]), r["n"]) for r in common]
    units = Units({w: i for i, w in enumerate(
        dict.fromkeys([END, *(w for w, _ in words if w != END)][:FREQUENT]))})
    bigrams = unit_bigrams(train, units, text)
    label = exchange(bigrams, classes)
    size = len(label)
    table = _by_class(bigrams, label, classes)
    # different words of each class: frequent ones, and the rare ones of each ending
    last = F.expr("substring(word, greatest(1, octet_length(word) - 1), 2)")
    frequent = [bytes(w) for w in units.frequent]
    rare = counts.withColumn("unit", F.lit(FREQUENT) + F.crc32(last) % ENDINGS).groupBy("unit").count().collect()
    per_unit = np.zeros(size)
    for r in rare:
        per_unit[r["unit"]] = r["count"]
    counted = {w for w, _ in words}
    for w in frequent:
        if w in counted:
            per_unit[unit_of_rare(w)] -= 1
            per_unit[units.frequent[w]] += 1
    members = np.bincount(label, weights=per_unit, minlength=classes)
    model = Model(units, label, np.empty((classes, classes)), {w: math.log10(n + ALPHA) for w, n in words}, tokens, types)
    return replace(model, gain=_gain(model, table, members)), table, members


def _by_class(bigrams: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    by_row = np.zeros((classes, len(label)))
    np.add.at(by_row, label, bigrams)
    table = np.zeros((classes, classes))
    for c in range(classes):
        table[:, c] = by_row[:, label == c].sum(1)
    return table


def _gain(model: Model, table: np.ndarray, members: np.ndarray) -> np.ndarray:
    """log10 of a class bigram's factor, from the class bigrams and the different words of each class."""
    classes = len(table)
    weight = _held_in(table)
    transition = (table + ALPHA) / (table.sum(1, keepdims=True) + ALPHA * classes)
    factor = transition * model.denominator / (table.sum(0) + ALPHA * (members + 1))[None, :]
    return np.log10(weight * factor + (1 - weight))


def _held_in(table: np.ndarray) -> float:
    """Weight of the class part: near 1 with many counts per class pair, small with few."""
    return float(np.clip(table.sum() / (table.sum() + 2 * table.size), 0.01, 0.98))


def contexts(train: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(word, cells, times): how often classes stand before (c) and after (classes + c) words that aren't frequent.

    A row holds what one task has seen of a word: cells as bytes, times as 32-bit numbers.
    """
    shared = train.sparkSession.sparkContext.broadcast(model)
    sides = 2 * len(model.gain)
    assert sides <= 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        frequent, of_unit = model.units.frequent, model.classes.tolist()
        words, classes = list(frequent), bytearray(of_unit[u] for u in frequent.values())

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = number = len(words)
                words.append(word)
                classes.append(of_unit[unit_of_rare(word)])
                return number

        numbers = Numbers({w: i for i, w in enumerate(words)})
        end, first = numbers[END], len(words)
        keys, times, held = [], [], 0

        def merged() -> None:
            every = np.concatenate(keys)
            order = np.argsort(every, kind="stable")  # sorted runs, which a stable sort merges
            every = every[order]
            starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            keys[:], times[:] = [every[starts]], [np.add.reduceat(np.concatenate(times)[order], starts)]

        def out() -> Iterator[pa.RecordBatch]:
            merged()
            number, cell = np.divmod(keys[0], sides)
            starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
            bounds = np.r_[starts, len(number)]
            cell, n = cell.astype(np.uint8), times[0].astype("<i4").view(np.uint8)
            for at in range(0, len(starts), 1 << 16):
                some = bounds[at:at + (1 << 16) + 1]
                low, high = some[0], some[-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([words[i] for i in number[some[:-1]].tolist()], pa.binary()),
                    binaries(cell[low:high], some - low), binaries(n[4 * low:4 * high], 4 * (some - low))],
                    names=["word", "cells", "times"])

        for batch in batches:
            for part in slices(batch, text):
                ids, _ = numbered(as_bytes(part.column(text)), numbers, end)
                of = np.frombuffer(bytes(classes), np.uint8)[ids]
                rare = np.flatnonzero(ids >= first)
                own = ids[rare] * sides
                found, n = np.unique(np.concatenate([own + of[rare - 1], own + sides // 2 + of[rare + 1]]), return_counts=True)
                keys.append(found)
                times.append(n)
                held += len(found)
                if held > 4_000_000:
                    merged()
                    held = len(keys[0])
                if (held > 3_000_000 or len(words) > 400_000) and held:
                    yield from out()
                    keys, times, held = [], [], 0
                    for w in words[first:]:
                        del numbers[w]
                    del words[first:], classes[first:]
        if held:
            yield from out()

    return train.select(text).mapInArrow(run, "word binary, cells binary, times binary")


class Placement:
    """Most likely class of words from their context counts, the classes of all others as they are.

    A word's counts are taken out of the class it starts from.  All words are placed
    at once, by the change of the class bigram likelihood that each makes alone.
    """

    def __init__(self, table: np.ndarray) -> None:
        self.cells = np.concatenate([table, table.T]).astype(float)  # (before or after, class): bigrams
        self.ends = (table.sum(1).astype(float), table.sum(0).astype(float))
        self.few = np.stack([self._h(self.cells + n) - self._h(self.cells) for n in range(65)])

    @staticmethod
    def _h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    def of(self, start: np.ndarray, word: np.ndarray, cell: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Class of each word; ``word`` numbers them, in order, for every cell, and ``start`` is their class so far."""
        h, out = self._h, []
        for at, end in _cuts(word, 50_000):
            w, c, k = word[at:end], cell[at:end], n[at:end]
            gain = self.few[np.minimum(k, 64), c]
            many = np.flatnonzero(k > 64)
            gain[many] = h(self.cells[c[many]] + k[many, None]) - h(self.cells[c[many]])
            own = self.cells[c, start[w]]
            gain[np.arange(len(w)), start[w]] = h(own) - h(np.maximum(own - k, 0))
            starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            gain = np.add.reduceat(gain, starts, axis=0)
            ids = w[starts]
            total = np.add.reduceat(k, starts)[:, None] / 2.0  # as often before as after
            rows = np.arange(len(ids))
            for marginal in self.ends:
                change = h(marginal[None, :] + total) - h(marginal)[None, :]
                mine = marginal[start[ids]]
                change[rows, start[ids]] = h(mine) - h(np.maximum(mine - total[:, 0], 0))
                gain -= change
            best = gain.argmax(axis=1)
            stay = gain[rows, best] <= gain[rows, start[ids]] + 1e-9
            out.append(np.where(stay, start[ids], best))
        return np.concatenate(out)


def _cuts(word: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` cells that hold whole words."""
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else word
    at = 0
    while at < len(word):
        later = np.searchsorted(starts, at + limit)
        end = int(starts[later]) if later < len(starts) else len(word)
        yield at, end
        at = end


def placed(train: DataFrame, model: Model, table: np.ndarray, text: str = "text") -> DataFrame:
    """(word, n, class) of every word of the texts that isn't frequent."""
    ordered = contexts(train, model, text).repartition("word").sortWithinPartitions("word")
    shared = train.sparkSession.sparkContext.broadcast((model.classes, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_unit, table = shared.value
        placement, sides = Placement(table), 2 * len(table)

        def out(words: pa.Array, word: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            start = of_unit[units_of_rare(words)]
            total = np.bincount(word, weights=n, minlength=len(words)).astype(np.int64) // 2
            return pa.RecordBatch.from_arrays(
                [words, pa.array(total), pa.array(placement.of(start, word, cell, n), pa.int32())],
                names=["word", "n", "class"])

        # the last word of a batch may go on in the next one: its counts are carried, a number for each cell
        last, carried = pa.array([], pa.binary()), np.zeros(sides, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_arrays([last, batch.column("word").cast(pa.binary())])
            fresh = np.r_[True, pc.not_equal(rows.slice(1), rows.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)]
            words, number = rows.filter(pa.array(fresh)), np.cumsum(fresh) - 1
            cell, bounds = bytes_of(batch.column("cells"))
            held = np.flatnonzero(carried)
            keys = np.concatenate([held, np.repeat(number[len(last):], np.diff(bounds)) * sides + cell])
            n = np.concatenate([carried[held], bytes_of(batch.column("times"))[0].view("<i4")])
            order = np.argsort(keys, kind="stable")
            starts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
            word, cell = np.divmod(keys[order][starts], sides)
            n = np.add.reduceat(n[order], starts)
            whole = int(np.searchsorted(word, len(words) - 1))
            carried[:] = 0
            carried[cell[whole:]] = n[whole:]
            last = words.slice(len(words) - 1)
            if whole:
                yield out(words.slice(0, len(words) - 1), word[:whole], cell[:whole], n[:whole])
        if len(last):
            cell = np.flatnonzero(carried)
            yield out(last, np.zeros(len(cell), np.int64), cell, carried[cell])

    return ordered.mapInArrow(run, "word binary, n long, class int")


def tagged(docs: DataFrame, model: Model, words: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_tokens, n_known, base_score and classes (a byte for each token) of every whole text.

    Common words are looked up where the text is read.  Of all others a row's different
    words are joined with the counts and classes of the corpus; words that it doesn't
    hold have the class of their ending.  Equal rows of ``docs`` stay apart, as each row
    has a number of its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = math.log10(ALPHA)
    made: list[_Tagger] = []

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        if not made:
            made.append(_Tagger(shared.value))
        for part in slices(batch, "_text"):
            yield {c: part.column(c) for c in [*keep, "_row"]} | made[0].of(as_bytes(part.column("_text")))

    def resolve(batch: pa.RecordBatch) -> dict:
        flat, bounds = bytes_of(batch.column("classes"))
        places, cuts = bytes_of(batch.column("places"))
        at, order = places.view("<i4").reshape(-1, 2).T.astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), np.diff(cuts) // 8)
        # a row's different words get numbers that go on through the batch
        sizes = np.zeros(batch.num_rows, np.int64)
        np.maximum.at(sizes, row, order + 1)
        first = np.cumsum(sizes) - sizes
        found = batch.column("found")
        owner = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
        inner = found.flatten()
        of = np.full(int(sizes.sum()), -1, np.int64)
        of[first[owner] + inner.field("place").to_numpy(zero_copy_only=False)] = inner.field("class").to_numpy(zero_copy_only=False)
        own = of[first[row] + order]
        flat = flat.copy()
        flat[(bounds[row] + at)[own >= 0]] = own[own >= 0]
        rest = {c: batch.column(c) for c in batch.schema.names if c not in ("places", "found")}
        return rest | {"classes": binaries(flat, bounds)}

    inner = docs.select(*keep, F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in inner.dtypes if c != "_text")
    parts = written(arrow_parts(
        inner, run, schema + ", n_tokens long, n_common long, common double, classes binary, places binary, "
        "rare array<struct<word: binary, n: int>>"), "tagged")
    rare = parts.select("_row", F.posexplode("rare").alias("place", "r")).select(
        "_row", "place", "r.word", F.col("r.n").alias("times"))
    found = rare.join(words, "word").groupBy("_row").agg(
        F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(ALPHA))).alias("rare_sum"),
        F.collect_list(F.struct("place", "class")).alias("found"))  # a row's different words at most
    logs = F.col("common") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(base) * (
        F.col("n_tokens") - F.col("n_known") - F.col("end_unseen"))
    joined = (
        parts.drop("rare").join(found, "_row", "left")
        .withColumn("n_known", F.col("n_common") + F.coalesce("n_rare", F.lit(0)))
        .withColumn("end_unseen", F.lit(0 if END in model.known else 1))
        .withColumn("base_score", logs - F.col("n_tokens") * F.lit(math.log10(model.denominator)))
        .select(*keep, "n_tokens", "n_known", "base_score", "classes", "places", "found")
    )
    kept = ", ".join(f"`{c}` {t}" for c, t in joined.dtypes if c not in ("places", "found"))
    return arrow_map(joined, resolve, kept)


class _Tagger:
    """Reads texts with what a task knows of words: counts of common ones, classes of all by their ending at least."""

    def __init__(self, model: Model) -> None:
        of_unit = model.classes.tolist()
        own = {w: of_unit[u] for w, u in model.units.frequent.items()} | model.own_class
        self.of_end = model.known.get(END)
        self.end_class = own[END]
        self.words = list(model.known)  # common ones; others follow as they come
        self.common = len(self.words)
        self.logs = np.array(list(model.known.values()))
        classes = self.classes = bytearray(own[w] if w in own else of_unit[unit_of_rare(w)] for w in self.words)
        words = self.words

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = number = len(words)
                words.append(word)
                classes.append(of_unit[unit_of_rare(word)])
                return number

        self.numbers = Numbers({w: i for i, w in enumerate(words)})

    def of(self, texts: list[bytes | None]) -> dict:
        """Columns n_tokens, n_common, common, classes, places and rare of some texts."""
        if len(self.words) > self.common + 400_000:
            for w in self.words[self.common:]:
                del self.numbers[w]
            del self.words[self.common:], self.classes[self.common:]
        ids, ends = numbered(texts, self.numbers, 0)
        ids, ends = ids[1:], ends[1:] - 1  # an end stands after each text only
        starts = np.r_[0, ends[:-1] + 1]
        row = np.repeat(np.arange(len(texts)), ends - starts + 1)
        flat = np.frombuffer(bytes(self.classes) or b"\0", np.uint8)[ids]
        flat[ends] = self.end_class
        word = np.ones(len(ids), bool)
        word[ends] = False
        usual = np.flatnonzero(word & (ids < self.common))
        other = np.flatnonzero(word & (ids >= self.common))
        pairs, order, times = np.unique(
            row[other] * len(self.words) + ids[other], return_inverse=True, return_counts=True)
        bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * len(self.words))  # of a text's different rare words
        places = np.stack([other - starts[row[other]], order - bounds[row[other]]], axis=1).astype("<i4")
        rare = pa.StructArray.from_arrays([
            pa.array([self.words[i] for i in (pairs % max(len(self.words), 1)).tolist()], pa.binary()),
            pa.array(times, pa.int32())], names=["word", "n"])
        sums = np.bincount(row[usual], weights=self.logs[ids[usual]], minlength=len(texts))
        return {
            "n_tokens": pa.array(ends - starts + 1),
            "n_common": pa.array(np.bincount(row[usual], minlength=len(texts)) + (self.of_end is not None)),
            "common": pa.array(sums + (math.log10(ALPHA) if self.of_end is None else self.of_end)),
            "classes": binaries(flat, np.r_[starts, len(flat)]),
            "places": binaries(places.reshape(-1).view(np.uint8), 8 * np.searchsorted(other, np.r_[starts, len(ids)])),
            "rare": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rare),
        }


def class_bigrams(rows: DataFrame, end: int, classes: int) -> np.ndarray:
    """Counts of neighbouring classes over all rows' ``classes``, the end before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for part in slices(batch, "classes"):
                # every text closes with the end, so that the texts in a row count as one
                ids = np.frombuffer(bytes([end]) + b"".join(part.column("classes").to_pylist()), np.uint8).astype(np.int64)
                counts += np.bincount(ids[:-1] * classes + ids[1:], minlength=classes * classes)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])

    found = rows.select("classes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(classes * classes, np.int64)
    table[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(classes, classes).astype(float)


def with_gain(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with score in the place of classes."""
    shared = rows.sparkSession.sparkContext.broadcast((model.gain, int(model.classes[model.units.of(END)])))

    def run(batch: pa.RecordBatch) -> dict:
        gain, end = shared.value
        sums = []
        for own in batch.column("classes").to_pylist():
            ids = np.frombuffer(bytes([end]) + own, np.uint8)
            sums.append(float(gain[ids[:-1], ids[1:]].sum()))
        return {c: batch.column(c) for c in batch.schema.names if c != "classes"} | {"gain": sums}

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "classes")
    return arrow_map(rows, run, schema + ", gain double").withColumn(
        "score", F.col("base_score") + F.col("gain")).drop("gain")


def perplexity(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Learns from rows whose CRC32 of the id modulo 10 is not 0.  Null texts are empty; an
    empty text is its end alone.  Without training rows every token is unknown.
    """
    crc = crc_of_id(id_column)
    train = docs.where(crc % 10 != 0).select(text)
    counts = written(word_counts(train, text), "counts")
    model, table, _ = _start(train, counts, text, CLASSES)
    words = written(placed(train, model, table, text), "words")
    common = words.orderBy(F.desc("n"), "word").limit(KNOWN).collect()
    model = replace(model, own_class={w: r["class"] for r in common if (w := bytes(r["word"])) in model.known})
    slim = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_whole"))
    rows = written(tagged(slim, model, words, ["_id"], "_whole"), "classes")
    end = int(model.classes[model.units.of(END)])
    table = class_bigrams(rows.where(crc_of_id("_id") % 10 != 0), end, CLASSES)
    members = np.zeros(CLASSES)
    np.add.at(members, model.classes[[u for w, u in model.units.frequent.items() if w in model.known]], 1)
    for r in words.groupBy("class").count().collect():
        members[r["class"]] += r["count"]
    model = replace(model, gain=_gain(model, table, members))
    scored = with_gain(rows, model)
    return scored.select(
        F.col("_id").alias(id_column), (crc_of_id(F.col("_id")) % 10 == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
