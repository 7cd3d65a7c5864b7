import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from tapeline.llm import registry, warc

PAGES = [
    (5, "http://a/?q=ü\r\nx", "<p>one</p>", "clash"), (3, "http://b", "<p>one</p>", "clash"),
    (8, None, None, "clash"), (9, "u", "", "clash"), (4, "v", "ü" * 70_000, "clash"),
    (3, "http://b", "<p>one</p>", "clash"), (None, "n", "<p>one</p>", "clash"), (None, "n", "own", "clash"),
]


def record(i, text, kind="response", first=None):
    data = (text or "").encode()
    return (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, first)


def test_pages_come_back(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, payload string").repartition(3)
    rows = warc.round_trip(spark, df, payloads=True).collect()
    want = [
        record(5, "<p>one</p>", "revisit", 3), record(3, "<p>one</p>"), record(3, "<p>one</p>"),
        record(8, None), record(9, "", "revisit", 8), record(4, "ü" * 70_000),
        record(None, "<p>one</p>", "revisit", 3), record(None, "own"),
    ]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    texts = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response" and r.page_id}
    assert texts == {3: "<p>one</p>", 8: "", 4: "ü" * 70_000}
    assert {r.url for r in rows if r.page_id == 5} == {"http://a/?q=%C3%BC%0D%0Ax"}
    assert warc.round_trip(spark, df.limit(0)).collect() == []


def test_short_payloads_need_not_be_revisits(spark):
    df = spark.createDataFrame(PAGES[:6], "page_id long, url string, html string, payload string")
    archives = warc.write_archives(df, warc.new_folder(spark, "test"), least_bytes=100)
    assert {r.record_type for r in warc.read_archives(archives).collect()} == {"response"}


def page(i, text, first=None):
    data = text.encode()
    return warc.record(
        {"page_id": i, "url": f"http://x/{i}", "payload": data, "payload_bytes": len(data),
         "payload_digest": warc.digest(data), "refers_to": first}
    )


def written(raws):
    sink = io.BytesIO()
    warc.archive(raws, sink)
    return sink.getvalue()


def read(data):
    return [r["page_id"] for r in warc.records(io.BytesIO(data), "test")]


def test_dictionary_and_frames():
    raws = [page(i, f"<html>{i} {'lorem ipsum ' * (i % 50)}</html>") for i in range(2000)]
    data = written(raws)
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    assert int.from_bytes(data[4:8], "little") > 0
    assert [raw for _, raw in warc.frames(io.BytesIO(data), "test")] == raws
    assert read(data) == list(range(2000))
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in raws[:5])  # no leading frame
    assert read(plain) == list(range(5))


def test_archives_are_closed_when_full(monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3_000)
    monkeypatch.setattr(warc, "TRAIN_BYTES", 1_000)
    left = iter([page(i, str(i) * 300) for i in range(200)])
    seen = []
    for first in left:
        from itertools import chain

        sink = io.BytesIO()
        warc.archive(chain([first], left), sink)
        seen += read(sink.getvalue())
    assert seen == list(range(200))


GOOD = page(1, "some text")


@pytest.mark.parametrize(
    "raw, what",
    [
        (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (GOOD.replace(b"WARC-Date", b"X-Date"), "no WARC-Date"),
        (GOOD.replace(b"WARC-Type: response", b"WARC-Type: response\r\nodd"), "header"),
        (GOOD[:-1], "length"),
        (GOOD + GOOD, "length"),
        (GOOD.replace(b"some text", b"same text"), "digest"),
        (GOOD.replace(b"urn:x-page:1>", b"urn:other:1>"), "no page"),
        (page(2, "x", 1).replace(b"WARC-Refers-To: <urn:x-page:1>\r\n", b""), "refers to nothing"),
    ],
)
def test_damage_is_found(raw, what):
    with pytest.raises(warc.BadArchive, match=what):
        read(written([raw]))


def test_cut_off_archives_are_found():
    data = written([page(i, "text " * i) for i in range(50)])
    for n in (len(data) - 1, len(data) - 40):
        with pytest.raises(warc.BadArchive):
            read(data[:n])
    broken = bytearray(data)
    broken[-10] ^= 255
    with pytest.raises(warc.BadArchive):
        read(bytes(broken))


def test_whole_table(spark, sf_dir):
    assert registry.QUERIES["op2_warc"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()


def test_a_task_reads_one_archive(spark):
    df = spark.range(64).selectExpr("id AS page_id", "'u' AS url", "concat('page ', id) AS html")
    archives = warc.write_archives(df.repartition(16, "page_id"), warc.new_folder(spark, "test"))
    n = archives.count()
    read = warc.read_archives(archives).withColumn("task", F.spark_partition_id())
    per_task = read.groupBy("task").agg(F.count("*").alias("n")).collect()
    sizes = sorted(r.records for r in archives.collect())
    assert n > 4 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert sorted(r.n for r in per_task) == sizes and sum(sizes) == 64
