import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tapeline.llm import exact_dedup, registry, sharding

SCHEMA = "doc_id long, text string, keep_id string"
ODD = [
    (4, "a  b", "x"), (9, "a\tb", "x"), (2, "a\x0b\x0c\r\nb", "x"), (7, "a b ", "x"), (1, "A b", "x"),
    (8, None, "x"), (3, "", "x"), (6, "\x1c", "x"), (5, "é" * 40_000, "x"), (10, "é" * 40_000, "x"),
    (2, "a b", "x"), (None, "z", "x"), (None, "z", "x"), (None, "a b", "x"),
]


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("bits", [128, 1])
def test_groups_are_those_of_equal_bytes(spark, bits):
    hashed = exact_dedup.content_hash if bits == 128 else lambda t: F.lit(b"same")  # all collide
    df = spark.createDataFrame(ODD, SCHEMA).repartition(4)
    got = exact_dedup.exact_groups(df, hashed=hashed).collect()
    want = []
    for i, t, _ in ODD:
        same = [j for j, u, _ in ODD if normal(u) == normal(t)]
        keep = min((j for j in same if j is not None), default=None)
        sha = hashlib.sha256(normal(t).encode()).hexdigest()
        want.append((i, keep, len(same), i == keep, sha))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert exact_dedup.exact_groups(df.limit(0)).collect() == []


def test_the_rows_that_stay_keep_their_columns(spark):
    df = spark.createDataFrame([r for r in ODD if r[0] is not None], SCHEMA)
    stay = exact_dedup.without_copies(df)
    assert stay.columns == df.columns
    assert sorted({r.doc_id for r in stay.collect()}) == [1, 2, 3, 5, 6, 7]


def brute_shards(rows, n):
    """rows (id, text) -> rows with size, crc, shard and slot, from one running sum."""
    keyed = []
    for i, t in rows:
        data = (t or "").encode()
        keyed.append((i, len(data) + 8, zlib.crc32(data)))
    keyed.sort(key=lambda r: (r[0] is not None, r))
    total = sum(size for _, size, _ in keyed)
    out, at, slots = [], 0, [0] * n
    for i, size, crc in keyed:
        shard = n * (2 * at + size) // (2 * total)
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return out


@pytest.mark.parametrize("n", [1, 7, 24, 500])
def test_shards_follow_the_running_sum(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(90)]), "é" * rng.choice([0, 1, 5, 300])) for _ in range(300)]
    rows += [(40, None), (41, "x" * 20_000), (-5, "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, other int").repartition(6)
    got = [tuple(r) for r in sharding.byte_shards(df, n).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_shards(rows, n)))
    assert sharding.byte_shards(df.limit(0), n).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    df = registry.QUERIES["op3_byte_shards"](spark, sf_dir)
    got = sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in df.collect())
    assert got == sorted(brute_shards([tuple(d) for d in docs], 24))


def test_stored_order_is_kept(spark, tmp_path):
    from tapeline.llm.common import stored

    df = spark.range(1000).selectExpr("999 - id AS id", "1 + id % 7 AS bytes").repartitionByRange(9, "id")
    rows = stored(df.sortWithinPartitions("id"), "test")
    got = sharding.shards_in_stored_order(rows, 10, "bytes").orderBy("shard", "slot").collect()
    assert [r["id"] for r in got] == list(range(1000))
    clash = stored(df.selectExpr("*", "'x' AS Slot"), "test")
    assert sharding.shards_in_stored_order(clash, 10, "bytes").columns == ["id", "bytes", "shard", "slot"]
