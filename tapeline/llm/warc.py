"""WARC archives in Zstandard: one frame per record, the dictionary in front.

An archive starts with a skippable frame that holds the dictionary of all frames
after it.  Each further frame is one whole record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm.common import cut, new_folder, stored, utf8

# Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DATE = "2001-11-05T00:00:00Z"
ID = "urn:x-page:"
ARCHIVE_BYTES = 256 << 20  # an archive that has reached this size is closed
TRAIN_BYTES = 4 << 20  # records at the start of an archive that its dictionary is trained on
DICTIONARY_BYTES = 64 << 10
READ_BYTES = 1 << 20

RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint"
)
ARCHIVES = "archive string, records bigint, bytes bigint"


class BadArchive(ValueError):
    """The archive breaks the format; the message says where and how."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: dict) -> bytes:
    """One record: headers, block, two line ends.

    The block is an HTTP response; that of a revisit has no body, but the length of
    the payload in its headers.  A page without url has no target."""
    payload, first = page["payload"], page["refers_to"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {page['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http + payload if first is None else http
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page['page_id'] is None else page['page_id']}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{page['payload_digest']}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page["url"] is not None:
        headers["WARC-Target-URI"] = quote(page["url"], safe="%/:=&?~#+!$,;'@()*[]")
    if first is not None:
        headers |= {"WARC-Refers-To": f"<{ID}{first}>", "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records of an archive; None if they are too few
    or too alike to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def archive(records: Iterable[bytes], sink) -> tuple[int, int]:
    """Writes records to a binary file; how many, and the bytes written."""
    records = iter(records)
    head: list[bytes] = []
    held = 0
    for r in records:
        head.append(r)
        held += len(r)
        if held >= TRAIN_BYTES:
            break
    words = trained(head)
    if words:
        packed = zstandard.ZstdCompressor(level=19).compress(words.as_bytes())
        front = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
    else:
        front = struct.pack("<II", DICTIONARY_FRAME, 0)
    sink.write(front)
    n, size = 0, len(front)
    frames = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=True)

    def rest() -> Iterator[bytes]:
        yield from head
        head.clear()
        if held >= TRAIN_BYTES:
            for r in records:
                yield r
                if size >= ARCHIVE_BYTES:
                    return

    for r in rest():
        frame = frames.compress(r)
        sink.write(frame)
        n, size = n + 1, size + len(frame)
    return n, size


def dictionary_of(payload: bytes, name: str) -> zstandard.ZstdCompressionDict | None:
    """The dictionary in the payload of the leading frame, plain or compressed."""
    if not payload:
        return None
    magic = int.from_bytes(payload[:4], "little")
    if magic == FRAME:
        payload = zstandard.ZstdDecompressor().decompress(payload)
        magic = int.from_bytes(payload[:4], "little")
    if magic != DICTIONARY:
        raise BadArchive(f"{name}: the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(payload)


def frames(source, name: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each frame of an archive, read as a stream."""
    head = source.read(8)
    at, words = 0, None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
        length = struct.unpack("<II", head)[1]
        packed = source.read(length)
        if len(packed) != length:
            raise BadArchive(f"{name}: cut off in the dictionary")
        words, at, head = dictionary_of(packed, name), 8 + length, b""
    reader = zstandard.ZstdDecompressor(dict_data=words)
    left = head
    while left or (left := source.read(READ_BYTES)):
        frame, parts, used = reader.decompressobj(), [], 0
        while True:
            used += len(left)
            try:
                parts.append(frame.decompress(left))
            except zstandard.ZstdError as e:
                raise BadArchive(f"{name}, byte {at}: {e}") from e
            if frame.eof:
                break
            if not (left := source.read(READ_BYTES)):
                raise BadArchive(f"{name}, byte {at}: cut off in a frame")
        left = frame.unused_data
        yield at, b"".join(parts)
        at += used - len(left)


def number(urn: str, where: str) -> int | None:
    if not (urn.startswith(f"<{ID}") and urn.endswith(">")):
        raise BadArchive(f"{where}: {urn} names no page")
    digits = urn[len(ID) + 1 : -1]
    return int(digits) if digits else None


def parsed(raw: bytes, where: str) -> dict:
    """The fields of the one record in a frame, after checks of its version, its
    required headers, its lengths and its digests."""

    def check(good: bool, what: str) -> None:
        if not good:
            raise BadArchive(f"{where}: {what}")

    head, found, rest = raw.partition(b"\r\n\r\n")
    check(bool(found), "no end of headers")
    version, *lines = head.decode("utf-8").split("\r\n")
    check(version in ("WARC/1.0", "WARC/1.1"), f"version {version[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        key, colon, value = line.partition(":")
        check(bool(colon and key.strip()), f"header {line[:40]!r}")
        headers[key.strip().lower()] = value.strip()
    for key in REQUIRED:
        check(key.lower() in headers, f"no {key}")
    check(headers["content-length"].isdigit(), "Content-Length is no number")
    length = int(headers["content-length"])
    check(len(rest) == length + 4 and rest.endswith(b"\r\n\r\n"), "length differs from Content-Length")
    block = rest[:length]
    kind = headers["warc-type"]
    check(kind in ("response", "revisit"), f"type {kind}")
    if "warc-block-digest" in headers:
        check(headers["warc-block-digest"] == f"sha1:{digest(block)}", "block digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    check(bool(found), "no end of HTTP headers")
    lengths = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    check(len(lengths) == 1 and lengths[0].strip().isdigit(), "HTTP Content-Length")
    size = int(lengths[0])
    named = headers.get("warc-payload-digest", "")
    check(named.startswith("sha1:"), "no payload digest")
    if kind == "response":
        check(len(payload) == size, "length differs from HTTP Content-Length")
        check(named == f"sha1:{digest(payload)}", "payload digest")
    else:
        check(not payload, "a revisit with a payload")
        check("warc-refers-to" in headers, "a revisit that refers to nothing")
    return {
        "page_id": number(headers["warc-record-id"], where),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": named.removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": number(headers["warc-refers-to"], where) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def records(source, name: str) -> Iterator[dict]:
    """The records of one archive."""
    for at, raw in frames(source, name):
        yield parsed(raw, f"{name}, byte {at}")


def planned(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1 and refers_to of each page.

    Payloads meet by SHA-1, SHA-256 and length; one short row per payload and task
    is sent to find the first page, and only payloads of two pages or more come
    back to the pages."""
    pages = pages.select("page_id", "url", utf8("html").alias("payload"))
    pages = pages.select(
        "*",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("_sha1"),
        F.unhex(F.sha2("payload", 256)).alias("_sha2"),
    )
    firsts = (
        pages.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("_sha1", "_sha2", "payload_bytes")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    first = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return pages.join(stored(firsts, "first-pages"), ["_sha1", "_sha2", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "_sha1", first.alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) as records under folder; the archives
    written: archive, records, bytes.

    The payload is the html in UTF-8; null is empty.  Of pages with equal payloads
    of ``least_bytes`` or more the one with the smallest page_id is a response and
    the others are revisits that refer to it; rows that repeat this page_id are
    responses too, and so are pages without a page_id whose payload no numbered page
    has.  Other columns are ignored; no pages give no archives.

    Each task writes archives of its own under names that no other attempt uses and
    returns their names; an archive of a lost attempt is never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        lines = (
            record(page | {"payload_digest": base64.b32encode(bytes.fromhex(page["_sha1"])).decode()})
            for batch in batches
            for page in batch.to_pylist()
        )
        for first in lines:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{top}/{name}") as sink:
                n, size = archive(chain([first], lines), sink)
            yield pa.RecordBatch.from_pydict(
                {"archive": [f"{folder}/{name}"], "records": [n], "bytes": [size]}
            )

    return cut(planned(pages, least_bytes).mapInArrow(write, ARCHIVES))


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives named in the column archive, a task per archive,
    read as a stream: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, and the payload of responses if asked for.

    Raises BadArchive for a damaged frame, a frame with anything but one record, a
    missing header, or a length or digest that differs.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"] * payloads
    schema = pa.schema(
        [
            (n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.binary() if n == "payload" else pa.string())
            for n in names
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(path) as source:
                    rows, held = [], 0
                    for row in records(source, uri):
                        rows.append(row)
                        held += 200 + len(row["payload"] or b"") * payloads
                        if held >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # a stated number of ranges: rows this short would be put together into one task
    spread = archives.select("archive").repartitionByRange(max(archives.count(), 1), "archive")
    return spread.mapInArrow(read, RECORDS + ", payload binary" * payloads)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = False) -> DataFrame:
    """The pages written to the shared folder and read back."""
    return read_archives(write_archives(pages, new_folder(spark, "warc")), payloads)
