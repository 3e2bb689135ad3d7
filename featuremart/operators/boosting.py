"""Gradient-boosted trees with second-order splits and penalties on leaf weights, fitted from histograms.

The tasks add up gradient and curvature by node, feature and bin; only these sums reach the
driver, whose size is set by the settings and not by the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.operators.passes import few_tasks, summed, vectors
from featuremart.session import materialise

# --- fixed values: search ranges of the regularised trees -----------------------------
BOOSTED_SEARCH = {
    "n_estimators": (100, 400, "int"),
    "max_depth": (3, 6, "int"),
    "learning_rate": (0.03, 0.15, "log"),
    "subsample": (0.6, 1.0, "linear"),
    "colsample_bytree": (0.6, 1.0, "linear"),
    "gamma": (0.0, 0.3, "linear"),
    "min_child_weight": (1, 6, "int"),
    "reg_alpha": (0.0, 1.0, "linear"),
    "reg_lambda": (1.0, 2.0, "linear"),
}
#: Trees after which the rows' margins are written anew.
WRITTEN_EVERY = 8


@dataclass(frozen=True)
class Settings:
    """Names and meanings as in BOOSTED_SEARCH; ``bins`` is the number of cuts looked at per feature."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    bins: int = 64
    seed: int = fixed.SEED


@dataclass
class Tree:
    """Nodes in order; a row goes left where its bin of ``feature`` is at most ``cut``; leaves have feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for x, blank in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            x += [blank, blank]
        return self.left[node], self.right[node]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node in which every row of bins ends."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (inner := feature[at] >= 0).any():
            own = bins[rows[inner], feature[at[inner]]] <= cut[at[inner]]
            at[inner] = np.where(own, left[at[inner]], right[at[inner]])
        return at


def shrunk(gradient, alpha: float):
    """The gradient sum moved towards zero by the first-order penalty."""
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0)


def weight_of(gradient, curvature, s: Settings):
    """Value of a leaf before the learning rate."""
    return -shrunk(gradient, s.reg_alpha) / (curvature + s.reg_lambda)


def worth(gradient, curvature, s: Settings):
    return shrunk(gradient, s.reg_alpha) ** 2 / np.maximum(curvature + s.reg_lambda, 1e-300)


def best_split(gradient: np.ndarray, curvature: np.ndarray, features: np.ndarray, s: Settings) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the best split of a node from its histograms (feature, bin), or None.

    The gain is half what both sides are worth beyond their parent, less ``gamma``; a side
    needs a curvature of ``min_child_weight``.  Ties go to the first feature and cut.
    """
    left_g, left_h = (np.cumsum(x[features], axis=1)[:, :-1] for x in (gradient, curvature))
    if not left_g.size:
        return None
    all_g, all_h = gradient[features[0]].sum(), curvature[features[0]].sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = (worth(left_g, left_h, s) + worth(right_g, right_h, s) - worth(all_g, all_h, s)) / 2 - s.gamma
    least = max(s.min_child_weight, 1e-12)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    i, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return (float(gain[i, cut]), int(features[i]), int(cut)) if gain[i, cut] > 1e-9 else None


@dataclass
class BoostedModel:
    """``edges`` of the bins of every feature, trees, and the margin of no trees."""

    edges: list[list[float]]
    trees: list[Tree]
    start: float
    settings: Settings

    def margins(self, x: np.ndarray) -> np.ndarray:
        return add_trees(np.full(len(x), self.start), binned(x, self.edges), self.trees)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``probability`` of the positive class in the place of its features vector."""
        kept = [c for c in df.columns if c not in ("probability", features)]
        plain = df.select(F.struct(F.lit(0).alias("_none"), *[df[c] for c in kept]).alias("_row"),
                          vector_to_array(features).alias("_x"))
        shared = df.sparkSession.sparkContext.broadcast(self)  # its size is set by the settings

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    score = 1 / (1 + np.exp(-shared.value.margins(vectors(batch.column("_x")))))
                    yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(score)], names=["_row", "probability"])

        ddl = f"_row {plain.schema['_row'].dataType.simpleString()}, probability double"
        return plain.mapInArrow(run, ddl).select(*[F.col(f"_row.`{c}`") for c in kept], "probability")


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Number of edges below every value."""
    out = np.zeros(x.shape, np.uint8)
    for f, of_feature in enumerate(edges):
        out[:, f] = np.searchsorted(np.array(of_feature), x[:, f], side="left")
    return out


def add_trees(margin: np.ndarray, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.leaves(bins)]
    return margin


def cuts(rows: DataFrame, size: int, bins: int) -> list[list[float]]:
    """Edges of each feature: all its values but the largest, or evenly spread ones where there are more than ``bins``."""
    shares = [i / bins for i in range(1, bins + 1)]
    found = rows.select(F.posexplode("features").alias("feature", "value")).groupBy("feature").agg(
        F.percentile_approx("value", shares, 10_000).alias("spread"))
    spread = {r["feature"]: sorted(set(r["spread"])) for r in found.collect()}
    return [spread.get(f, [])[:-1] for f in range(size)]


def fit_boosted(rows: DataFrame, settings: Settings = Settings(), features: str = "features", label: str = "label",
                weight: str = "weight") -> BoostedModel:
    """Trees on rows with a features vector, a 0/1 label and a weight.

    Logistic loss, starting from no preference.  A tree takes the rows that a hash picks
    and columns drawn by the seed, so that runs repeat.  Rows are binned and written once;
    a level of a tree is one pass that brings the sums of its nodes, and margins are
    written anew every few trees.  Without rows there are no trees.
    """
    s = settings
    if s.bins > 255:
        raise ValueError("bins must be below 256")
    plain = rows.select(vector_to_array(features).alias("features"), F.col(label).cast("double").alias("label"),
                        F.col(weight).cast("double").alias("weight"))
    size = plain.agg(F.max(F.size("features"))).first()[0] or 0
    edges = cuts(plain, size, s.bins)
    model = BoostedModel(edges, [], 0.0, s)
    if not size:
        return model

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = binned(vectors(batch.column("features")), edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.tobytes() for b in bins], pa.binary()), batch.column("label"), batch.column("weight"),
                     pa.array(np.zeros(len(bins))), batch.column("hash")], names=["bins", "label", "weight", "margin", "hash"])

    ddl = "bins binary, label double, weight double, margin double, hash long"
    state = materialise(plain.withColumn("hash", F.xxhash64("features", "label")).mapInArrow(start, ddl), "binned")
    few = few_tasks(state)
    rng, recent = np.random.default_rng(s.seed), []
    for number in range(s.n_estimators):
        columns = np.sort(rng.permutation(size)[:max(1, round(s.colsample_bytree * size))])
        tree, open_ = Tree(), [0]
        for depth in range(s.max_depth + 1):
            sums = summed(state, _histograms(recent, tree, open_, size, s, number), few)
            grown = []
            for node in open_:
                if node not in sums:
                    continue
                gradient, curvature = sums[node].reshape(2, size, s.bins + 1)
                tree.value[node] = s.learning_rate * float(
                    weight_of(gradient[0].sum(), curvature[0].sum(), s))
                split = best_split(gradient, curvature, columns, s) if depth < s.max_depth else None
                if split:
                    grown += tree.grow(node, split[1], split[2])
            open_ = grown
            if not open_:
                break
        recent.append(tree)
        model.trees.append(tree)
        if len(recent) == WRITTEN_EVERY and number + 1 < s.n_estimators:
            state, recent = materialise(_moved(state, recent, ddl), "margins"), []
    return model


def _bins(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, size)


def _histograms(recent: list[Tree], tree: Tree, nodes: list[int], size: int, s: Settings, number: int):
    """Sums of gradient and curvature by feature and bin for each of the open ``nodes``."""
    wide = s.bins + 1

    def partial(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        if not batch.num_rows:
            return {}
        bins = _bins(batch, size)
        label, weight, margin, key = (np.asarray(batch.column(c)) for c in ("label", "weight", "margin", "hash"))
        if s.subsample < 1:
            mixed = (key.view(np.uint64) ^ np.uint64(number + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            weight = np.where((mixed >> np.uint64(11)) < np.uint64(s.subsample * (1 << 53)), weight, 0.0)
        p = 1 / (1 + np.exp(-add_trees(margin, bins, recent)))
        gradient, curvature = weight * (p - label), weight * np.maximum(p * (1 - p), 1e-16)
        at, out = tree.leaves(bins), {}
        for node in nodes:
            inside = np.flatnonzero((at == node) & (weight > 0))
            if len(inside):
                place = (np.arange(size) * wide + bins[inside]).ravel()
                out[node] = np.concatenate([
                    np.bincount(place, np.repeat(x[inside], size), size * wide) for x in (gradient, curvature)])
        return out

    return partial


def _moved(state: DataFrame, trees: list[Tree], ddl: str) -> DataFrame:
    """The rows with the trees' values in their margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                margin = add_trees(np.asarray(batch.column("margin")), bins, trees)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("bins"), batch.column("label"), batch.column("weight"), pa.array(margin), batch.column("hash")],
                    names=batch.schema.names)

    return state.mapInArrow(run, ddl)


@dataclass
class BoostedTrees:
    """Learner of the tuning functions: ``fit`` gives a model whose ``transform`` adds rawPrediction and probability."""

    settings: Settings

    def fit(self, rows: DataFrame) -> FittedTrees:
        return FittedTrees(fit_boosted(rows, self.settings))


@dataclass
class FittedTrees:
    model: BoostedModel

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        scored = self.model.transform(df)
        vector = array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))
        return scored.withColumn("rawPrediction", vector).withColumn("probability", vector)


def boosted_trial(draw: Mapping[str, float], rows: int) -> BoostedTrees:
    """Learner of one draw from BOOSTED_SEARCH."""
    return BoostedTrees(Settings(**{**asdict(Settings()), **draw}))
