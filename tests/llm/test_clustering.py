"""Clusters against a plain version in Python numbers."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tapeline.llm import clustering


def plain(rows, size, k, rounds, seed=3):
    kept = [
        (i, [math.floor(x * 1024) if abs(x) < 1e300 else int(x) * 1024 for x in v], v)
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    luck = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, luck(r[0]), r[2]))
    means = [v for _, v, _ in order[:k]]

    def assign():
        out = []
        for _, v, _ in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in means]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(means)):
            mine = [v for (_, v, _), (n, _) in zip(kept, found) if n == c]
            if mine:
                means[c] = [sum(col) // len(mine) for col in zip(*mine)]
    found = assign()
    short = lambda x: x if x < 1 << 63 else None
    total = Counter()
    for c, d in found:
        total[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return Counter(
        (i, c, short(d), short(total[c]), short(sum(total.values())), digest[c]) for (i, _, _), (c, d) in zip(kept, found)
    )


def run(spark, rows, size, k, rounds):
    data = [(i, v, 1) for i, v in rows]
    df = spark.createDataFrame(data, "vec_id long, vector array<double>, cluster int").repartition(3)
    out = clustering.clusters(df, size, k, rounds)
    return Counter(tuple(r) for r in out.collect())


def test_clusters(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK", 16)
    luck = random.Random(2)
    centres = [[luck.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + luck.gauss(0, 0.2) for x in luck.choice(centres)]) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(200, 260)] + [(7, rows[7][1]), (None, rows[9][1])]
    nan = float("nan")
    rows += [(300, None), (301, []), (302, [0.0] * 5), (303, [None] + [0.0] * 5), (304, [nan] * 6), (305, [float("inf")] + [0.0] * 5)]
    assert run(spark, rows, 6, 4, 5) == plain(rows, 6, 4, 5)


def test_large_numbers(spark):
    luck = random.Random(4)
    rows = [(i, [luck.uniform(-1, 1) * 10 ** luck.choice([0, 3, 5, 9, 200]) for _ in range(3)]) for i in range(60)]
    rows += [(80, [1.7e308, -1.7e308, 0.0])]
    assert run(spark, rows, 3, 3, 3) == plain(rows, 3, 3, 3)


def test_ties_few_and_no_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0]), (4, [0.5, 0.5])]
    assert run(spark, rows, 2, 3, 2) == plain(rows, 2, 3, 2)
    assert run(spark, rows[:2], 2, 8, 2) == plain(rows[:2], 2, 8, 2)
    assert not run(spark, [], 2, 8, 2)
    assert not run(spark, [(1, None)], 2, 8, 2)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_curve_goes_from_neighbour_to_neighbour(bits):
    points = np.array(np.meshgrid(*[np.arange(1 << bits)] * 3)).reshape(3, -1).T
    keys = clustering.hilbert_keys(points, bits)
    assert len(set(keys)) == len(keys)
    walk = points[np.argsort(np.array(keys, dtype=object), kind="stable")]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_the_nearest_in_and_others_out():
    luck = np.random.default_rng(1)
    left_out = 0
    for _ in range(300):
        cells = (luck.normal(size=8) + luck.normal(size=(20, 8)) * luck.choice([0.05, 0.5])).round(1)
        centroids = luck.normal(size=(6, 8)).round(1)
        some = clustering.candidates(cells.min(axis=0), cells.max(axis=0), centroids)
        full, _ = clustering.nearest(cells, centroids)
        assert set(full.tolist()) <= set(some.tolist())
        left_out += 6 - len(some)
    assert left_out > 600
