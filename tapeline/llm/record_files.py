"""Token ids as length-delimited binary records, with an offset index beside each file.

A record is framed as

    length of the data   8 bytes, little-endian
    its checksum         4 bytes, masked CRC-32C of the 8 bytes
    data
    its checksum         4 bytes, masked CRC-32C of the data

and its data is a header (id of the document 8 bytes, width of a token id 2 bytes, flags
2 bytes) and the ids, little-endian.  The index of a file is a table of whole numbers of
8 bytes, one row per record: see ``ENTRY``.  With it a reader takes any run of records,
or single ones in any order, without reading the rest.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.checksums import crc32c, masked
from tapeline.llm.common import cut, new_folder
from tapeline.llm.tokens import pieces, tokens_of

HEADER = struct.Struct("<qHH")
NO_ID = 1  # flag of a record whose document has no id
#: A row of the index: place of the record in the file, bytes of its data, document,
#: flags, ids of the file before it, ids of its own.
ENTRY = np.dtype([(name, "<i8") for name in ("at", "length", "doc_id", "flags", "before", "n")])
FILES = "part int, file string, records bigint, ids bigint, bytes bigint"
#: A writer goes on in a new file behind so many bytes.
FILE_BYTES = 1 << 29
#: A reading task takes so many records at a time, and so many bytes.
BLOCK_RECORDS = 1 << 15
READ_BYTES = 8 << 20


class BadRecord(ValueError):
    """A record or an index that does not hold what it says."""


def framed(data: list[bytes]) -> list[bytes]:
    """Data with lengths and checksums around it."""
    sizes = [struct.pack("<Q", len(d)) for d in data]
    heads, tails = masked(crc32c(sizes)).tolist(), masked(crc32c(data)).tolist()
    return [
        b"".join((size, struct.pack("<I", head), d, struct.pack("<I", tail)))
        for size, head, d, tail in zip(sizes, heads, data, tails)
    ]


def unframed(raw: bytes, where: str) -> list[bytes]:
    """The data of the records that lie one behind the other in raw."""
    sizes, heads, data, tails, at = [], [], [], [], 0
    while at < len(raw):
        size, head = raw[at : at + 8], raw[at + 8 : at + 12]
        n = int.from_bytes(size, "little")
        if len(head) < 4 or at + 16 + n > len(raw):
            raise BadRecord(f"{where}: a record is cut off")
        sizes.append(size)
        heads.append(head)
        data.append(raw[at + 12 : at + 12 + n])
        tails.append(raw[at + 12 + n : at + 16 + n])
        at += 16 + n
    for strings, found, what in ((sizes, heads, "length"), (data, tails, "data")):
        stated = np.frombuffer(b"".join(found), "<u4")
        if not np.array_equal(masked(crc32c(strings)), stated):
            raise BadRecord(f"{where}: checksum of a {what}")
    return data


def packed(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"id {ids.max()} does not fit {width} bytes")
    flags = NO_ID if doc_id is None else 0
    return HEADER.pack(doc_id or 0, width, flags) + ids.astype(f"<u{width}").tobytes()


def unpacked(data: bytes, where: str) -> tuple[int | None, np.ndarray]:
    if len(data) < HEADER.size:
        raise BadRecord(f"{where}: no header")
    doc_id, width, flags = HEADER.unpack_from(data)
    if width not in (1, 2, 4) or (len(data) - HEADER.size) % width:
        raise BadRecord(f"{where}: {len(data)} bytes of ids of {width}")
    ids = np.frombuffer(data, f"<u{width}", offset=HEADER.size).astype(np.uint32)
    return (None if flags & NO_ID else doc_id), ids


def write_records(
    docs: DataFrame,
    folder: str,
    encoder: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]],
    end_id: int = 0,
    width: int = 2,
) -> DataFrame:
    """Writes docs (doc_id, text) in the order of doc_id as record files under folder;
    the files written: part, file, records, ids, bytes, in the order of part and file.

    ``encoder`` makes a task's function from texts to ids and their numbers; ``width``
    is the bytes of an id.  ``end_id`` ends each document.  A null text is empty and
    becomes the end alone; a null doc_id comes first.  Rows of equal doc_id follow by the
    CRC-32 of their text, then in any order, and are spread like others.  Other columns
    are ignored; no rows give no files.

    Texts are dealt once, by ranges; a task encodes what it got and writes files of its
    own under names that no other attempt uses, so a file of a lost attempt is never read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"_crc": F.crc32("text"), "_place": F.monotonically_increasing_id()})
    order = ["doc_id", "_crc", "_place"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        encode = encoder()
        runs = encoded_runs(batches, encode, end_id, width)
        run, file_no = next(runs, None), 0
        while run is not None:
            name = f"part-{part:06d}-{file_no:06d}-{uuid.uuid4().hex}"
            entries, at, before = [], 0, 0
            with store.open_output_stream(f"{top}/{name}.records") as sink:
                while run is not None and at < FILE_BYTES:
                    for doc_id, n, record in run:
                        entries.append((at, len(record) - 16, doc_id or 0, NO_ID if doc_id is None else 0, before, n))
                        sink.write(record)
                        at, before = at + len(record), before + n
                    run = next(runs, None)
            with store.open_output_stream(f"{top}/{name}.index") as sink:
                sink.write(np.array(entries, ENTRY).tobytes())
            values = {"part": part, "file": f"{folder}/{name}", "records": len(entries), "ids": before, "bytes": at}
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int32() if k == "part" else None) for k, v in values.items()], list(values)
            )
            file_no += 1

    return cut(ordered.select("doc_id", "text").mapInArrow(write, FILES))


def encoded_runs(
    batches: Iterator[pa.RecordBatch], encode, end_id: int, width: int
) -> Iterator[list[tuple[int | None, int, bytes]]]:
    """Document, number of ids and framed record of some rows at a time."""
    for batch in batches:
        doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for piece in pieces(texts):
            ids, n = encode(texts[piece])
            stops = np.cumsum(n)
            ids = np.insert(ids, stops, end_id)
            stops += np.arange(1, len(n) + 1)
            mine, starts = doc_ids[piece], stops - n - 1
            data = [packed(d, ids[a:b], width) for d, a, b in zip(mine, starts.tolist(), stops.tolist())]
            yield list(zip(mine, (n + 1).tolist(), framed(data)))


class Files:
    """Files of records opened for reading, the last few kept open."""

    def __init__(self, keep: int = 8):
        self.keep, self.open = keep, OrderedDict()

    def at(self, uri: str, place: int, length: int) -> bytes:
        if uri not in self.open:
            store, path = fs.FileSystem.from_uri(uri)
            self.open[uri] = store.open_input_file(path)
            if len(self.open) > self.keep:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        self.open[uri].seek(place)
        found = self.open[uri].read(length)
        if len(found) != length:
            raise BadRecord(f"{uri}: ends before byte {place + length}")
        return found

    def entries(self, file: str, first: int, n: int) -> np.ndarray:
        raw = self.at(f"{file}.index", first * ENTRY.itemsize, n * ENTRY.itemsize)
        return np.frombuffer(raw, ENTRY)

    def records(self, file: str, entries: np.ndarray) -> list[np.ndarray]:
        """The ids of records that lie one behind the other, checked against the index."""
        where = f"{file}.records, byte {entries['at'][0]}"
        size = int((entries["length"] + 16).sum())
        data = unframed(self.at(f"{file}.records", int(entries["at"][0]), size), where)
        if len(data) != len(entries):
            raise BadRecord(f"{where}: {len(data)} records, {len(entries)} in the index")
        found = []
        for raw, entry in zip(data, entries):
            doc_id, ids = unpacked(raw, where)
            stated = None if entry["flags"] & NO_ID else int(entry["doc_id"])
            if len(raw) != entry["length"] or doc_id != stated or len(ids) != entry["n"]:
                raise BadRecord(f"{where}: not the record of the index")
            found.append(ids)
        return found


def digests(doc_ids, starts, ids: list[np.ndarray], with_ids: bool) -> pa.RecordBatch:
    columns = {
        "doc_id": pa.array(doc_ids, pa.int64()),
        "start": pa.array(starts, pa.int64()),
        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def with_starts(files: DataFrame) -> DataFrame:
    """The files with the ids of all files before them; one short row per file."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_records(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (and ids if asked for) of every record, read
    from the files in blocks of records, each by a task of its own.

    Raises BadRecord for a wrong length or checksum, a file that is cut off, and a record
    that is not the one of the index."""
    blocks = with_starts(files).select(
        "file", "records", "first",
        F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(BLOCK_RECORDS))).alias("entry"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Files()
        for block in (b for batch in batches for b in batch.to_pylist()):
            n = min(BLOCK_RECORDS, block["records"] - block["entry"])
            entries = opened.entries(block["file"], block["entry"], n)
            run = (entries["at"] - entries["at"][0]) // READ_BYTES
            for some in np.split(entries, np.flatnonzero(np.diff(run)) + 1):
                ids = opened.records(block["file"], some)
                doc_ids = [None if f & NO_ID else d for d, f in zip(some["doc_id"].tolist(), some["flags"].tolist())]
                yield digests(doc_ids, block["first"] + some["before"], ids, with_ids)

    return spread(blocks, "file", "entry").mapInArrow(read, ROWS + ", ids array<bigint>" * with_ids)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Few short rows that stand for much work, one to a task; without the number Spark
    would put them together by their own size."""
    rows = cut(rows)
    n = max(1, rows.count())
    turn = F.row_number().over(Window.orderBy(*keys)) - 1
    return rows.withColumn("_turn", turn.cast("int")).repartitionById(n, "_turn").drop("_turn")


def shuffled_records(files: DataFrame, seed: int, tasks: int = 64) -> DataFrame:
    """As ``read_records`` with the ids, in an order that the seed decides: records are
    drawn from all files one by one through the index.  ``turn`` numbers the order within
    each task's part, ``task`` the parts."""
    listed = files.select("file", "records")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Files()
        for row in (r for batch in batches for r in batch.to_pylist()):
            for first in range(0, row["records"], BLOCK_RECORDS):
                some = opened.entries(row["file"], first, min(BLOCK_RECORDS, row["records"] - first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]] * len(some)), pa.array(np.arange(first, first + len(some)))],
                    ["file", "entry"],
                )

    drawn = spread(listed, "file").mapInArrow(entries, "file string, entry bigint")
    # names of files differ from run to run, their part and number do not
    named = F.regexp_extract("file", r"part-\d+-\d+", 0)
    luck = F.xxhash64(F.lit(seed), named, "entry")
    drawn = drawn.withColumn("luck", luck).repartitionByRange(tasks, "luck", "entry")
    drawn = drawn.sortWithinPartitions("luck", "entry").select("file", "entry")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, turn, task = Files(64), 0, TaskContext.get().partitionId()
        for batch in batches:
            for row in batch.to_pylist():
                entry = opened.entries(row["file"], row["entry"], 1)
                ids = opened.records(row["file"], entry)[0]
                doc_id = None if entry["flags"][0] & NO_ID else int(entry["doc_id"][0])
                yield pa.RecordBatch.from_pydict(
                    {"task": pa.array([task], pa.int32()), "turn": [turn], "doc_id": pa.array([doc_id], pa.int64()), "ids": [ids.tolist()]}
                )
                turn += 1

    return drawn.mapInArrow(read, "task int, turn bigint, doc_id bigint, ids array<bigint>")


def by_tokenizer(file: str):
    """An encoder by a file of the ``tokenizers`` library, without added tokens."""

    def make():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        return tokens_of(file).encode

    return make


def token_records(docs: DataFrame, file: str, end_id: int = 0) -> DataFrame:
    """The documents written as records to the shared folder and read back."""
    folder = new_folder(docs.sparkSession, "records")
    return read_records(write_records(docs, folder, by_tokenizer(file), end_id))
