"""Contiguous shards of equal bytes, cut from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm.common import stored, utf8, without

ROW_OVERHEAD = 8  # bytes a row counts beside its text


def row_size(text_col: str = "text") -> Column:
    return (F.octet_length(utf8(text_col)) + ROW_OVERHEAD).cast("bigint")


def text_crc32(text_col: str = "text") -> Column:
    return F.crc32(utf8(text_col)).cast("bigint")


def in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows written as files that follow the order of the keys, one after the
    other.  Ties go to several files by the place of the row in the input, so a
    key of many rows is no large task."""
    place = F.monotonically_increasing_id()
    ranged = rows.withColumn("_place", place).repartitionByRange(*keys, "_place")
    return stored(ranged.sortWithinPartitions(*keys, "_place").drop("_place"), "ordered")


def shards_in_stored_order(rows: DataFrame, n_shards: int, size: str) -> DataFrame:
    """rows with the columns shard and slot; rows must come straight from files,
    whose order (part number, then place in the file) is kept.

    A shard takes the rows whose middle byte falls into its n-th of all bytes, so
    no cut is further from its target than half a row.  Slots count from 0 within
    a shard.  The column named by ``size`` holds positive bytes per row.  Input
    columns named shard or slot are replaced.

    The prefix sums need no shuffle: the totals of each input split (one entry per
    split reach the driver) give each split its first byte and row; a running sum
    within the split does the rest.  Only splits with a cut are read once more, to
    see which row the cut falls on.
    """
    columns = without(rows, "shard", "slot").columns
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
    marked = rows.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.coalesce(part.try_cast("bigint"), F.lit(-1)).alias("_part"),
    )
    totals = sorted(
        tuple(row)
        for row in marked.groupBy("_part", "_file", "_start")
        .agg(F.sum(size), F.count("*"))
        .collect()
    )
    marked = marked.drop("_part")
    first, total, count = {}, 0, 0
    for _, file, start, in_split, n in totals:
        first[file, start] = (total, count)
        total, count = total + in_split, count + n
    # A row of bytes a to b is in shard k if 2 * total * k <= n_shards * (a + b) < 2 * total * (k + 1).
    cuts = np.array([-(-2 * total * k // n_shards) for k in range(1, n_shards)], dtype=np.int64)

    # The first row of each shard: the first of a split that no cut is in, or a
    # row of one of the few others.
    starts: dict[int, int] = {}
    crossing = []
    for _, file, start, in_split, _ in totals:
        a, n = first[file, start]
        low = int(np.searchsorted(cuts, 2 * a, side="left"))
        if low < np.searchsorted(cuts, 2 * (a + in_split), side="right"):
            crossing.append(file)
        else:
            starts[low] = min(n, starts.get(low, n))
    if crossing:
        found = (
            marked.filter(F.col("_file").isin(sorted(set(crossing))))
            .select("_file", "_start", F.col(size).alias("_size"))
            .mapInArrow(first_rows("_size", first, cuts), "shard bigint, row bigint")
            .groupBy("shard")
            .agg(F.min("row"))
            .collect()
        )
        for k, n in found:
            starts[k] = min(n, starts.get(k, n))
    origin = np.array([starts.get(k, 0) for k in range(n_shards)], dtype=np.int64)
    schema = T.StructType([marked.schema[c] for c in columns])
    schema = schema.add("shard", T.IntegerType()).add("slot", T.LongType())
    return marked.mapInArrow(placed(columns, size, first, cuts, origin), schema)


def pieces(
    batches: Iterator[pa.RecordBatch], size: str, first: dict, cuts: np.ndarray
) -> Iterator[tuple[tuple, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The rows of one split after the other, with their shards and row numbers."""
    seen: dict = {}
    for batch in batches:
        files = batch.column("_file").dictionary_encode()
        code = files.indices.to_numpy(zero_copy_only=False)
        start = batch.column("_start").to_numpy(zero_copy_only=False)
        turns = np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1
        edges = [0, *turns.tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            if i == j:
                continue
            split = (files.dictionary[int(code[i])].as_py(), int(start[i]))
            piece = batch.slice(i, j - i)
            sizes = piece.column(size).to_numpy(zero_copy_only=False)
            a, n = seen.get(split) or first[split]
            ends = a + np.cumsum(sizes)
            seen[split] = (int(ends[-1]), n + len(sizes))
            shard = np.searchsorted(cuts, 2 * ends - sizes, side="right")
            yield split, piece, shard, n + np.arange(len(sizes))


def first_rows(size: str, first: dict, cuts: np.ndarray):
    """The first row of each shard in each split read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict = {}
        for split, _, shard, row in pieces(batches, size, first, cuts):
            new = np.flatnonzero(np.diff(shard, prepend=last.get(split, -1)))
            last[split] = int(shard[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[new].astype(np.int64)), pa.array(row[new])], ["shard", "row"]
            )

    return run


def placed(columns: list[str], size: str, first: dict, cuts: np.ndarray, origin: np.ndarray):
    """The rows with their shard and slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, piece, shard, row in pieces(batches, size, first, cuts):
            yield pa.RecordBatch.from_arrays(
                [
                    *(piece.column(c) for c in columns),
                    pa.array(shard.astype(np.int32)),
                    pa.array(row - origin[shard]),
                ],
                [*columns, "shard", "slot"],
            )

    return run


def byte_shards(
    docs: DataFrame, n_shards: int, order_by: Sequence[str] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """docs by the given order, in shards of equal bytes: the columns named by
    ``order_by`` and size, text_crc32, shard, slot.

    A null text has no bytes; a null key comes first.  Rows of equal keys follow
    in the order of size and CRC-32, so that the result is the same for any layout
    of the input; rows equal in all of these are interchangeable.  A text larger
    than a shard's share leaves some shards without rows.  No rows give no rows.
    Only the narrow columns are sorted and written, never the texts.
    """
    keys = [*order_by, "size", "text_crc32"]
    narrow = docs.select(
        *order_by, row_size(text_col).alias("size"), text_crc32(text_col).alias("text_crc32")
    )
    return shards_in_stored_order(in_order(narrow, *keys), n_shards, "size")
