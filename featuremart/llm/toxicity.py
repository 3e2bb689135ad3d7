"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first letters, so
that unseen forms of a word resemble it.  Filters of several widths slide over a text's
words, each keeps its largest response, and a linear layer turns those into a score.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import PLAIN_WORD, arrow_map, as_bytes, crc_of_id, plain_words, slices

BUCKETS = 1 << 17
DIMENSIONS = 16
FILTERS = 12
WIDTHS = (1, 2, 3)
PREFIXES = (3, 4, 5, 6, 7)
PAD = BUCKETS
#: Bounds of the labelled sample that the model is fitted on; scores cover all rows.
SAMPLE_ROWS = 8_000
SAMPLE_WORDS = 5_000_000
SAMPLE_BYTES = 64 << 20
EPOCHS = 8
CHUNK = 1 << 16


class Vocabulary:
    """Numbers words as they come and keeps their buckets; word 0 is padding."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.buckets = array("i", [PAD] * (1 + len(PREFIXES)))
        self.built = np.empty((0, 1 + len(PREFIXES)), np.int32)

    def __len__(self) -> int:
        return len(self.index) + 1

    def ids(self, text: bytes | None) -> np.ndarray:
        index, out = self.index, []
        for word in plain_words(text):
            number = index.get(word)
            if number is None:
                number = index[word] = len(index) + 1
                letters = word.decode()
                self.buckets.extend((zlib.crc32(word) % BUCKETS, *(
                    zlib.crc32(letters[:n].encode(), n) % BUCKETS if len(letters) >= n else PAD for n in PREFIXES)))
            out.append(number)
        return np.array(out, np.int32)

    def pieces(self) -> np.ndarray:
        if len(self.built) < len(self):
            self.built = np.array(self.buckets, np.int32).reshape(len(self), -1)
        return self.built


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other with padding between them, and where each starts.

    A filter applied at any of a text's words sees this text and padding only; a text
    without words is one padding word.
    """
    gap = np.zeros(max(WIDTHS) - 1, np.int32)
    blank = np.zeros(1, np.int32)
    parts, starts, at = [], [], 0
    for words in texts:
        words = words if len(words) else blank
        starts.append(at)
        at += len(words) + len(gap)
        parts += [words, gap]
    return np.concatenate(parts), np.array(starts)


@dataclass
class Model:
    """Fitted weights; ``thresholds`` by language, ``threshold`` for other languages."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, dimensions, filters)
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def logits(self, texts: list[np.ndarray], pieces: np.ndarray) -> np.ndarray:
        """Whole texts; long ones in overlapping chunks, of which the largest response counts."""
        best = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        group, counted, owner, size = [], [], [], 0
        for i, words in enumerate(texts):
            for start in range(0, max(1, len(words)), CHUNK):
                group.append(words[start:start + CHUNK + max(WIDTHS) - 1])
                counted.append(max(1, min(CHUNK, len(words) - start)))
                owner.append(i)
                size += len(group[-1]) + 2
                if size >= CHUNK:
                    np.maximum.at(best, owner, self._pooled(group, counted, pieces))
                    group, counted, owner, size = [], [], [], 0
        if group:
            np.maximum.at(best, owner, self._pooled(group, counted, pieces))
        return np.maximum(best + self.bias, 0) @ self.weight + self.offset

    def _pooled(self, texts: list[np.ndarray], counted: list[int], pieces: np.ndarray) -> np.ndarray:
        """Largest response of every filter at the first ``counted`` words of each text.

        Responses are computed by different word and looked up.
        """
        words, starts = laid_out(texts)
        position = np.arange(len(words)) - np.repeat(starts, np.diff(np.r_[starts, len(words)]))
        outside = (position >= np.repeat(counted, np.diff(np.r_[starts, len(words)])))[: len(words) - max(WIDTHS) + 1]
        different, words = np.unique(words, return_inverse=True)
        vectors = self.embedding[pieces[different]].sum(axis=1)
        valid = len(words) - max(WIDTHS) + 1
        found = []
        for width, places in zip(WIDTHS, self.filters, strict=True):
            response = (vectors @ places[0])[words[:valid]]
            for k in range(1, width):
                response += (vectors @ places[k])[words[k:valid + k]]
            response[outside] = -np.inf
            found.append(np.maximum.reduceat(response, starts, axis=0))
        return np.concatenate(found, axis=1)

    def scores(self, texts: list[np.ndarray], pieces: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.logits(texts, pieces).astype(np.float64) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _start(texts: list[np.ndarray], pieces: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> Model:
    """Random weights; one embedding dimension starts at a bucket's shrunken log odds of the label."""
    seen, toxic = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for words, label in zip(texts, labels, strict=True):
        different = np.unique(pieces[np.unique(words)])
        seen[different] += 1
        toxic[different] += label
    prior = (labels.sum() + 1) / (len(labels) + 2)
    embedding = rng.normal(0, 0.02, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    embedding[:, 0] = np.log((toxic + 30 * prior) / (seen + 30) / prior)
    embedding[PAD] = 0
    filters = []
    for width in WIDTHS:
        f = rng.normal(0, 0.2, (width, DIMENSIONS, FILTERS)).astype(np.float32)
        f[0, 0, : FILTERS // 2] = 1.0
        filters.append(f)
    total = len(WIDTHS) * FILTERS
    return Model(embedding, filters, np.full(total, -0.3, np.float32), np.full(total, 0.1, np.float32),
                 float(np.log(prior / (1 - prior))))


def _calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn logits into probabilities (Platt scaling with smoothed targets)."""
    n1 = labels.sum()
    n0 = len(labels) - n1
    if not n0 or not n1:
        return 1.0, 0.0
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logits + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * logits).sum(), (p - target).sum()])
        h = np.array([[(w * logits * logits).sum() + 1e-6, (w * logits).sum()],
                      [(w * logits).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def best_threshold(scores: np.ndarray, labels: np.ndarray, default: float) -> float:
    """Middle of the widest stretch of cuts with the best F1, between 0.2 and 0.95."""
    if labels.sum() < 5 or (labels == 0).sum() < 5:
        return default
    cuts = np.linspace(0.2, 0.95, 151)
    hit = scores[None, :] >= cuts[:, None]
    right = (hit & (labels == 1)[None, :]).sum(1)
    f1 = 2 * right / np.maximum(hit.sum(1) + labels.sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    longest = max(runs, key=len)
    return float(cuts[longest[len(longest) // 2]])


def train(texts: list[np.ndarray], pieces: np.ndarray, labels: np.ndarray, languages: list[str | None],
          seed: int = 0, epochs: int = EPOCHS, batch: int = 64) -> Model:
    """Fit on texts of word numbers, of which ``pieces`` has the buckets: most rows for the weights, the rest to stop, calibrate and set thresholds.

    Without rows of both classes the score is the constant share of the label.
    """
    labels = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    if len(labels) == 0 or labels.min() == labels.max():
        model = _start(texts, pieces, labels, rng)
        model.weight[:] = 0
        return model
    held = np.zeros(len(labels), bool)
    for value in (0, 1):
        of_class = rng.permutation(np.flatnonzero(labels == value))
        held[of_class[: max(1, len(of_class) // 5)]] = True
    use = np.flatnonzero(~held)
    fit_on = [texts[i] for i in use]
    model = _start(fit_on, pieces, labels[use], rng)
    held_texts, held_labels = [texts[i] for i in np.flatnonzero(held)], labels[held]
    dense = [model.weight, model.bias, *model.filters]
    first, second = [np.zeros_like(x) for x in dense], [np.zeros_like(x) for x in dense]
    squares = np.full(BUCKETS + 1, 1e-6, np.float32)
    offset = np.array([model.offset])
    first_o, second_o = np.zeros(1), np.zeros(1)
    best, kept, step = np.inf, None, 0
    for _ in range(epochs):
        order = rng.permutation(len(use))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            step += 1
            words, starts = laid_out([fit_on[r] for r in rows])
            dropped = rng.random(len(words)) < 0.1
            different, words = np.unique(np.where(dropped, 0, words), return_inverse=True)
            buckets = pieces[different]
            vectors = model.embedding[buckets].sum(axis=1)[words]
            valid = len(words) - max(WIDTHS) + 1
            stops = np.r_[starts[1:], len(words)] - max(WIDTHS) + 1
            places, responses = [], []
            for width, f in zip(WIDTHS, model.filters, strict=True):
                response = vectors[:valid] @ f[0]
                for k in range(1, width):
                    response += vectors[k:valid + k] @ f[k]
                top = np.stack([response[s:e].argmax(axis=0) + s for s, e in zip(starts, stops, strict=True)])
                places.append(top)
                responses.append(np.take_along_axis(response, top, axis=0))
            pooled = np.concatenate(responses, axis=1) + model.bias
            active = np.maximum(pooled, 0)
            p = _sigmoid(active @ model.weight + offset[0])
            error = ((p - labels[use][rows]) / len(rows)).astype(np.float32)
            back = error[:, None] * model.weight[None, :] * (pooled > 0)
            grads = [active.T @ error, back.sum(0)]
            touched, slopes = [], []
            for w, (width, f) in enumerate(zip(WIDTHS, model.filters, strict=True)):
                own = back[:, w * FILTERS:(w + 1) * FILTERS]
                grad = np.empty_like(f)
                for k in range(width):
                    grad[k] = np.einsum("bfd,bf->df", vectors[places[w] + k], own)
                    touched.append(words[places[w] + k].ravel())
                    slopes.append((own[:, :, None] * f[k].T[None]).reshape(-1, DIMENSIONS))
                grads.append(grad)
            for x, g, m, v in zip(dense, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= (0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
            g = error.sum()
            first_o += 0.1 * (g - first_o)
            second_o += 0.001 * (g * g - second_o)
            offset -= 0.01 * (first_o / (1 - 0.9 ** step)) / (np.sqrt(second_o / (1 - 0.999 ** step)) + 1e-7)
            index = buckets[np.concatenate(touched)]
            slope = np.repeat(np.concatenate(slopes), index.shape[1], axis=0)
            index = index.ravel()
            rows_touched, inverse = np.unique(index, return_inverse=True)
            total = np.zeros((len(rows_touched), DIMENSIONS), np.float32)
            np.add.at(total, inverse, slope)
            total[rows_touched == PAD] = 0
            squares[rows_touched] += (total * total).mean(axis=1)
            model.embedding[rows_touched] -= 0.02 * total / np.sqrt(squares[rows_touched])[:, None]
        model.offset = float(offset[0])
        logits = model.logits(held_texts, pieces)
        p = np.clip(_sigmoid(logits), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(held_labels == 1, np.log(p), np.log(1 - p)))
        if loss < best:
            best = loss
            kept = (model.embedding.copy(), [f.copy() for f in model.filters], model.bias.copy(),
                    model.weight.copy(), model.offset)
    model.embedding, model.filters, model.bias, model.weight, model.offset = kept
    model.slope, model.shift = _calibrate(model.logits(held_texts, pieces).astype(np.float64), held_labels)
    scores = model.scores(held_texts, pieces)
    model.threshold = best_threshold(scores, held_labels, 0.5)
    spoken = np.array([x or "" for x in languages], object)[held]
    for language in {x for x in languages if x}:
        own = spoken == language
        model.thresholds[language] = best_threshold(scores[own], held_labels[own], model.threshold)
    return model


def labelled_rows(docs: DataFrame, labels: DataFrame, text: str = "text", language: str = "lang",
                  rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, order, toxic, language, text, hash) of the labelled training rows with the smallest id hashes.

    At most ``rows`` ids.  Rows whose CRC32 of the id modulo 3 is 1 are held out.  Null
    labels are none; of several labels of an id the largest counts.
    """
    chosen = (
        labels.where((crc_of_id("doc_id") % 3 != 1) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(rows)
    )
    spoken = F.col(language).cast("string") if language in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", F.col(text).alias("text"), spoken.alias("language")).join(
        F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("text"))  # at most ``rows`` rows are broadcast


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str = "text", language: str = "lang",
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """(order, toxic, language, text) of the rows to learn from, in order.

    The words and bytes of at most ``rows`` rows are counted first.  In their order every
    row that still fits SAMPLE_WORDS and SAMPLE_BYTES is taken, and only those texts are
    fetched.  Rows of one id and text count once.
    """
    found = labelled_rows(docs, labels, text, language, rows)
    sizes = found.groupBy("order", "hash", "doc_id").agg(
        F.max(F.regexp_count("text", F.lit(PLAIN_WORD))).alias("words"),
        F.max(F.octet_length("text")).alias("bytes")).orderBy("order", "hash", "doc_id").limit(rows).collect()
    taken, words, size = [], 0, 0
    for row in sizes:
        if words + (row["words"] or 0) <= SAMPLE_WORDS and size + (row["bytes"] or 0) <= SAMPLE_BYTES:
            words, size = words + (row["words"] or 0), size + (row["bytes"] or 0)
            taken.append((row["doc_id"], row["hash"]))
    fits = docs.sparkSession.createDataFrame(taken, found.select("doc_id", "hash").schema)
    return (found.join(F.broadcast(fits), ["doc_id", "hash"]).groupBy("order", "hash", "doc_id")
            .agg(F.first("toxic").alias("toxic"), F.min("language").alias("language"), F.first("text").alias("text"))
            .orderBy("order", "hash", "doc_id").select("order", "toxic", "language", "text"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", language: str = "lang", **options) -> Model:
    """Model of the labelled sample.

    At most SAMPLE_ROWS rows, SAMPLE_WORDS words and SAMPLE_BYTES bytes reach the driver; a
    text that doesn't fit any more is left out, and shorter ones after it still count.
    """
    vocabulary, texts, marks, languages = Vocabulary(), [], [], []
    for row in labelled_sample(docs, labels, text, language).toLocalIterator():
        texts.append(vocabulary.ids(row["text"].encode() if row["text"] is not None else None))
        marks.append(int(row["toxic"] > 0))
        languages.append(row["language"])
    pieces = vocabulary.pieces()
    del vocabulary  # its words aren't needed any more
    return train(texts, pieces, np.array(marks, np.int64), languages, **options)


def score(docs: DataFrame, model: Model, text: str = "text", language: str = "lang") -> DataFrame:
    """``docs`` with score (0 to 1), threshold of its language and rejected (score at or above it).

    Only the text enters the score.  Null and empty texts get the score of a text
    without words.  Columns of ``docs`` with the names of results are replaced; rows
    repeat as they are.
    """
    kept = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made: list = []

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.extend([shared.value, Vocabulary()])
        model, words = made
        values = []
        for part in slices(batch, "_text", 1 << 20):
            if len(words) > 200_000:
                words.clear()
            texts = [words.ids(t) for t in as_bytes(part.column("_text"))]
            values.append(model.scores(texts, words.pieces()))
        return {c: batch.column(c) for c in batch.schema.names if c != "_text"} | {
            "score": np.concatenate(values) if values else np.empty(0)}

    inner = docs.select(F.struct(*[docs[c] for c in kept]).alias("_row"), docs[text].alias("_text"))
    scored = arrow_map(inner, run, f"_row {inner.schema['_row'].dataType.simpleString()}, score double")
    limit = F.lit(model.threshold)
    if language in kept and model.thresholds:
        pairs = [x for k, v in sorted(model.thresholds.items()) for x in (F.lit(k), F.lit(v))]
        limit = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(f"_row.`{language}`").cast("string")), limit)
    return scored.withColumn("threshold", limit).select("_row.*", "score", "threshold").withColumn(
        "rejected", F.col("score") >= F.col("threshold"))
