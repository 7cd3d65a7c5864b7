import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from tapeline.llm import mixing, registry


def edf(rows, shares, default, block):
    """Ids in mixed order, one turn after the other with exact fractions.

    rows: (id, source).  Within a round, the blocks a source has left (at most its
    share) are released and due by their parts of the round."""
    by_source = defaultdict(list)
    for i, s in rows:
        by_source[s or ""].append(i)
    blocks = {}
    for s, ids in by_source.items():
        ids.sort(key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        blocks[s] = [ids[k : k + block] for k in range(0, len(ids), block)]
    out, done = [], Counter()
    while any(done[s] < len(b) for s, b in blocks.items()):
        names = sorted(blocks)
        n = {s: min(shares.get(s, default), len(blocks[s]) - done[s]) for s in names}
        turns, used = sum(n.values()), Counter()
        for t in range(turns):
            free = [s for s in names if used[s] < n[s] and math.floor(Fraction(used[s] * turns, n[s])) <= t]
            s = min(free, key=lambda s: (math.ceil(Fraction((used[s] + 1) * turns, n[s])), s))
            out.append((s, done[s] + used[s], blocks[s][done[s] + used[s]]))
            used[s] += 1
            for other in names:  # less than a block from the target, at any time
                assert abs(used[other] - Fraction(n[other] * (t + 1), turns)) < 1
        done.update(used)
    return out


CASES = [
    ({"a": 5, "b": 2, "c": 1}, 1, {"a": 130, "b": 300, "c": 7, "d": 64}, 4),
    ({"a": 1}, 1, {"a": 40, "b": 1, "c": 39}, 8),
    ({"a": 90, "b": 7, "c": 3}, 1, {"a": 900, "b": 70, "c": 31}, 3),
    ({}, 3, {"": 50, "x": 51}, 1),
]


@pytest.mark.parametrize("shares, default, sizes, block", CASES)
def test_order_is_that_of_the_turns(spark, shares, default, sizes, block):
    rows = [s for s, n in sizes.items() for _ in range(n)]
    random.Random(1).shuffle(rows)
    rows = [(3 * i, s or None, "text") for i, s in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, source string, _src string").drop("_src").repartition(5)
    got = mixing.mixed(df, shares, default, block).orderBy("position").collect()
    want = [
        (i, k) for _, k, ids in edf([r[:2] for r in rows], shares, default, block) for i in ids
    ]
    assert [(r.doc_id, r.source_block) for r in got] == want
    assert [r.position for r in got] == list(range(len(rows)))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").collect()
    got = registry.QUERIES["op10_mix"](spark, sf_dir).orderBy("position").collect()
    turns = edf([tuple(d) for d in docs], registry.MIX_SHARES, registry.MIX_DEFAULT, mixing.BLOCK_ROWS)
    assert [(r.doc_id, r.source_block) for r in got] == [(i, k) for _, k, ids in turns for i in ids]


def test_null_repeated_and_no_rows(spark):
    rows = [(None, None), (None, "a"), (1, "a"), (1, "a"), (1, "b"), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mixed(df, {"a": 2}).collect()
    assert sorted(map(str, [(r.doc_id, r.source) for r in got])) == sorted(map(str, rows))
    assert sorted(r.position for r in got) == list(range(6))
    assert mixing.mixed(df.limit(0), {}).collect() == []
    with pytest.raises(ValueError):
        mixing.mixed(df, {"a": 0})
    clash = mixing.mixed(df.selectExpr("*", "-1 AS Position", "'x' AS held"), {"a": 2})
    assert clash.columns == ["doc_id", "source", "held", "source_block", "position"]
    assert sorted(r.position for r in clash.collect()) == list(range(6))


def test_runs_without_python(spark, sf_dir):
    df = registry.QUERIES["op10_mix"](spark, sf_dir)
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
