"""A query's route goes on until its parts hold enough candidates."""

import numpy as np

from featuremart.llm import neighbours


class ByFirst(neighbours.Router):
    """Part 0 for positive first coordinates, part 1 for all others."""

    def logits(self, vectors):
        return np.stack([vectors[:, 0], -vectors[:, 0]], axis=1)


def test_small_parts_are_extended():
    sizes = np.array([3, 500])
    parts = neighbours.routed(ByFirst([], 2), np.array([[1.0], [-1.0]]), sizes, 21)
    assert [p.tolist() for p in parts] == [[0, 1], [1]]
    short = neighbours.routed(ByFirst([], 2), np.array([[1.0]]), np.array([3, 4]), 21)  # all there are
    assert [p.tolist() for p in short] == [[0, 1]]


def test_a_query_in_a_small_part_has_all_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "fit", lambda *a, **k: ByFirst([], 2))
    rows = [(i, [1.0, float(i)]) for i in range(3)] + [(i, [-1.0, float(i)]) for i in range(100, 200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.search(df, lambda x: x == 0).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 21))
