"""Every word has a class of its own making, also beyond those that the driver clusters."""

import random
import zlib

import numpy as np

from featuremart.llm import lm


def test_rare_words_of_one_ending_go_where_their_neighbours_say(make_docs):
    """Two rare words with one ending: before, they shared a class and scored alike in any place."""
    rng = random.Random(2)
    even, odd = [f"e{i}" for i in range(800)], [f"o{i}" for i in range(800)]
    sides = [even * 10 + ["evzz"] * 5, odd * 10 + ["odzz"] * 5]
    for side in sides:
        rng.shuffle(side)
    flat = [w for pair in zip(*sides, strict=True) for w in pair]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(2000) if not zlib.crc32(str(i).encode()) % 10]
    rows = [(ids[i], " ".join(flat[at:at + 40])) for i, at in enumerate(range(0, len(flat), 40))]
    rows += [(held[0], "e1 odzz e2 o3 evzz o4"), (held[1], "e1 evzz e2 o3 odzz o4")]
    gain = {r.doc_id: r.score - r.base_score for r in lm.perplexity(make_docs(rows)).collect() if r.held_out}
    assert gain[held[0]] > gain[held[1]] + 0.1


def test_placement_is_the_most_likely_class():
    rng = np.random.default_rng(4)
    table = rng.integers(50, 500, (6, 6)).astype(float)
    start, n = np.array([2, 0, 5]), np.array([[3, 0, 9, 0, 1, 0, 0, 4, 0, 9, 0, 0], [0, 1] + [0] * 6 + [1] + [0] * 3,
                                              [40, 0, 0, 0, 0, 30, 0, 0, 0, 70, 0, 0]])
    word, cell = np.nonzero(n)
    h = lambda x: x * np.log(np.maximum(x, 1e-300))
    want = []
    for w, a in enumerate(start):
        gains = []
        for k in range(6):
            sign = -1 if k == a else 1  # out of its class, or into another
            parts = [(table[c, k], n[w, c]) for c in range(6)] + [(table[k, c], n[w, 6 + c]) for c in range(6)]
            ends = [(table[k].sum(), n[w, 6:].sum()), (table[:, k].sum(), n[w, :6].sum())]
            gains.append(sum(sign * (h(x + sign * d) - h(x)) for x, d in parts)
                         - sum(sign * (h(x + sign * d) - h(x)) for x, d in ends))
        want.append(int(np.argmax(gains)))
    assert lm.Placement(table).of(start, word, cell, n[word, cell]).tolist() == want
