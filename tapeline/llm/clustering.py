"""Centroid clustering of vectors of whole numbers, with zone maps along a Hilbert curve.

Vectors are laid out once in the order of a Hilbert curve and kept in blocks, each with
the box of its smallest and largest components.  For every centroid the box bounds the
distances that vectors of the block can have; centroids that some other one beats for
every point of the box are left out, and the rest are compared exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored

#: Whole numbers per unit of a component.
UNIT = 1024
#: Vectors of a block.
BLOCK = 512
#: Bits of each component that the curve sees.
BITS = 4
#: Below this size all sums of products of components are exact in doubles.
EXACT = 1 << 21
BLOCKS = "ids binary, no_id binary, low binary, high binary, cells binary"


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has so many components, all finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.coalesce((F.size(vector) == size) & ~F.exists(vector, odd), F.lit(False))


def whole(values: np.ndarray) -> np.ndarray:
    """floor(UNIT * x): as int64 where all are below EXACT, as Python numbers elsewhere."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(UNIT))
    if not len(scaled) or np.abs(scaled).max() < EXACT:
        return scaled.astype(np.int64)
    exact = [[int(y) if math.isfinite(y) else int(x) * UNIT for x, y in zip(*r)] for r in zip(values.tolist(), scaled.tolist())]
    return np.array(exact, dtype=object)


def hilbert_keys(levels: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of points of ``bits`` bits per component, as bytes that
    sort like them."""
    x = levels.astype(np.uint32).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] & np.uint32(1 << b)) != 0, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)
    return [row.tobytes() for row in packed]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values.reshape(-1, size)


def curve_order(vectors: DataFrame, size: int) -> DataFrame:
    """The vectors (vec_id, vector) by ranges of the curve, each range in its order.

    Vectors of one place on the curve are dealt by their place in the input, so that many
    equal ones are no large task."""
    spans = vectors.agg(F.min(F.array_min("vector")).alias("a"), F.max(F.array_max("vector")).alias("b")).first()
    low, high = (spans.a, spans.b) if spans.a is not None else (0.0, 0.0)
    top = (1 << BITS) - 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), size)
            width = max(high / 2 - low / 2, 5e-324)
            level = np.clip((x / 2 - low / 2) / width * top, 0, top)
            keys = pa.array(hilbert_keys(level, BITS), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "place"])

    rows = vectors.withColumn("turn", F.monotonically_increasing_id())
    rows = rows.mapInArrow(keyed, "vec_id bigint, vector array<double>, turn bigint, place binary")
    return rows.repartitionByRange("place", "turn").sortWithinPartitions("place", "turn")


def zone_maps(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of vectors along the curve with their boxes, kept in the shared folder."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        cells: list = []
        for batch in batches:
            values = batch.column("vec_id").to_pylist()
            rows = matrix(batch.column("vector"), size)
            for i in range(0, len(values), BLOCK):
                ids += values[i : i + BLOCK]
                cells.append(rows[i : i + BLOCK])
                if len(ids) >= BLOCK:
                    yield block(ids, np.concatenate(cells))
                    ids, cells = [], []
        if ids:
            yield block(ids, np.concatenate(cells))

    ordered = curve_order(vectors, size).select("vec_id", "vector")
    return stored(ordered.mapInArrow(blocks, BLOCKS), "zones")


def block(ids: list, cells: np.ndarray) -> pa.RecordBatch:
    """Boxes and cells are kept as the doubles they came from; ``whole`` is monotone."""
    columns = {
        "ids": np.array([i or 0 for i in ids], np.int64),
        "no_id": np.array([i is None for i in ids]),
        "low": cells.min(axis=0),
        "high": cells.max(axis=0),
        "cells": cells,
    }
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in columns.values()], list(columns))


def squared(x: np.ndarray, axis: int) -> np.ndarray:
    return (x * x).sum(axis=axis)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a point of the box.

    A centroid is out if its least distance to the box is more than the largest that
    another one can have; or if another is nearer at every point: the difference of two
    squared distances is linear in the point, so its least value is at a corner."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    least, most = squared(outside, 1), squared(farthest, 1)
    near = np.flatnonzero(least <= most.min())
    best = near[np.argmin(most[near])]
    slope = 2 * (centroids[best] - centroids[near])
    lead = np.where(slope > 0, slope * low, slope * high).sum(axis=1)
    lead = lead + squared(centroids[near], 1) - squared(centroids[best], 0)
    return near[lead <= 0]


def nearest(cells: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and squared distance."""
    distance = squared(cells, 1)[:, None] - 2 * (cells @ centroids.T) + squared(centroids, 1)
    if distance.dtype == object:
        found = np.array([min(range(len(row)), key=row.__getitem__) for row in distance], np.int64)
    else:
        found = distance.argmin(axis=1)
    return found, distance[np.arange(len(found)), found]


def assigned(row: dict, size: int, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells of a block as whole numbers, their clusters and squared distances.

    Numbers below EXACT are compared as doubles, whose sums of products are then exact;
    larger ones as Python numbers."""
    cells = whole(np.frombuffer(row["cells"]).reshape(-1, size))
    box = whole(np.stack([np.frombuffer(row["low"]), np.frombuffer(row["high"])]))
    large = max(abs(x) for c in centroids for x in c) >= EXACT
    kind = object if large or cells.dtype == object else np.float64
    means = np.array(centroids, dtype=kind)
    box = box.astype(kind)
    some = candidates(box[0], box[1], means)
    cluster, distance = nearest(cells.astype(kind), means[some])
    return cells, some[cluster], distance


def totals(zones: DataFrame, size: int, centroids: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """Vectors, squared distances and sums of components of each cluster that has any.

    A task hands on one row per cluster; sums travel as decimal texts where they may not
    fit a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        n, far, sums = [0] * k, [0] * k, [[0] * size for _ in range(k)]
        for row in (r for batch in batches for r in batch.to_pylist()):
            cells, cluster, distance = assigned(row, size, centroids)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                n[c] += int(mine.sum())
                far[c] += int(distance[mine].sum())
                sums[c] = [a + int(b) for a, b in zip(sums[c], cells[mine].sum(axis=0))]
        used = [c for c in range(k) if n[c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([n[c] for c in used], pa.int64()),
                pa.array([[str(far[c]), *map(str, sums[c])] for c in used], pa.list_(pa.string())),
            ],
            ["cluster", "n", "sums"],
        )

    parts = zones.mapInArrow(run, "cluster int, n bigint, sums array<string>")
    return {c: (n, sums[0], sums[1:]) for c, (n, sums) in added(parts).items()}


def added(parts: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Sums per cluster over tasks: a row per cluster comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for row in (r for batch in batches for r in batch.to_pylist()):
            c, more = row["cluster"], [int(x) for x in row["sums"]]
            n[c] = n.get(c, 0) + row["n"]
            sums[c] = [a + b for a, b in zip(sums[c], more)] if c in sums else more
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(n), pa.int32()),
                pa.array(list(n.values()), pa.int64()),
                pa.array([[str(x) for x in v] for v in sums.values()], pa.list_(pa.string())),
            ],
            ["cluster", "n", "sums"],
        )

    rows = parts.repartition("cluster").mapInArrow(run, parts.schema)
    return {r.cluster: (r.n, [int(x) for x in r.sums]) for r in rows.collect()}


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors whose hash of seed and id is smallest, at most k; rows of one id follow
    by their components, rows without an id come last."""
    luck = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("vector", luck.alias("luck"))
    rows = rows.orderBy(F.asc_nulls_last("luck"), "vector").limit(k).collect()
    return [[int(x) for x in whole(np.array([r.vector]))[0]] for r in rows]


def long(x) -> int | None:
    return int(x) if abs(x) < 1 << 63 else None


def clusters(
    vectors: DataFrame, size: int = 64, k: int = 8, rounds: int = 10, seed: int = 3,
    id_col: str = "vec_id", vector_col: str = "vector",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every
    vector of ``size`` finite components; others are left out.

    Components become floor(1024 * x).  Centroids start as the k vectors of the smallest
    hashes; each round gives every vector to the nearest centroid (the smaller number of
    equals) and moves centroids to the floor of the mean; one without vectors stays.
    Everything is computed in whole numbers.  Rows that repeat an id are vectors of their
    own; fewer than k vectors make fewer clusters, none give no rows.  A distance or sum
    beyond 2^63 is null.  Other columns are ignored.

    Vectors are shuffled once; a round reads the blocks and hands on a row per cluster and
    task.
    """
    vectors = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).filter(usable(F.col("vector"), size))
    centroids = first_centroids(vectors, k, seed)
    zones = zone_maps(vectors, size)
    if centroids:
        for _ in range(rounds):
            for c, (n, _, sums) in totals(zones, size, centroids).items():
                centroids[c] = [x // n for x in sums]
        final = totals(zones, size, centroids)
    else:
        final = {}
    inertia = {c: far for c, (_, far, _) in final.items()}
    whole_inertia = long(sum(inertia.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            _, cluster, distance = assigned(row, size, centroids)
            ids = np.frombuffer(row["ids"], np.int64)
            numbers = cluster.tolist()
            columns = {
                "vec_id": pa.array(ids, mask=np.frombuffer(row["no_id"], bool)),
                "cluster": pa.array(numbers, pa.int32()),
                "distance": pa.array([long(d) for d in distance.tolist()], pa.int64()),
                "cluster_inertia": pa.array([long(inertia[c]) for c in numbers], pa.int64()),
                "inertia": pa.array([whole_inertia] * len(numbers), pa.int64()),
                "centroid_sha256": pa.array([digest[c] for c in numbers]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return zones.mapInArrow(
        run,
        "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint,"
        " centroid_sha256 string",
    )
