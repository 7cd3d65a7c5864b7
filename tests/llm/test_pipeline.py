import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tapeline.llm import decontamination, mixing, registry, toxicity
from tapeline.llm.common import stored
from tests.llm import brute

ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    """What each stage is given and leaves."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages(spark, sf_dir, tables):
    raw, clean, single, safe, mix, shards = tables
    for df in tables[:-1]:
        assert df.columns == raw.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = set(ids(clean))
    gone = set(ids(raw)) - left
    assert sum(labels.get(i) == 0 for i in gone) <= 0.01 * raw.count()
    # the smallest tables have few labels to learn from
    assert sum(labels.get(i) == 1 for i in left) <= 0.4 * sum(labels.values())
    pairs = [tuple(r) for r in clean.select("doc_id", "text").collect()]
    assert set(ids(single)) == {c for _, c in brute.components(pairs).values()}
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = {r.doc_id for r in decontamination.leaks(single, benchmark).collect()}
    assert leaks and sorted(ids(safe)) == sorted(set(ids(single)) - leaks)
    order = mixing.mixed(safe, registry.MIX_SHARES, registry.MIX_DEFAULT).orderBy("position")
    assert shards.columns == [*raw.columns, "shard", "slot"]
    assert ids(shards.orderBy("shard", "slot")) == ids(order)
    assert sorted(ids(mix)) == sorted(ids(safe))


def test_run_is_the_stages_one_after_the_other(spark, sf_dir, tables):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, tables[-1].collect()))


def test_stages_take_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a b", None, "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
            assert docs.count() == n
    more = "doc_id", "text", "lang", "source", "n_chars", "score", "Shard", "position", "key", "_gone"
    docs = spark.createDataFrame([(*r, 9.5, 1, 2, 3, 4) for r in rows], list(more))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == list(more) and docs.first().score == 9.5
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.columns == [c for c in more if c != "Shard"] + ["shard", "slot"]
    assert {r.slot for r in last.collect()} == {0}  # of 24 shards each has one row or none
    assert toxicity.THRESHOLD == 0.7


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    assert set(registry.ORACLE) <= set(queries()) and set(registry.ORACLE) <= set(oracle_sql())
    for name, sql in registry.ORACLE.items():
        df = queries()[name](spark, sf_dir)
        columns = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        got = [tuple(r) for r in df.select(*columns).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)), name


def test_the_rest_works_without(tmp_path):
    for path in ("tapeline", "__spark_entry__.py"):
        (tmp_path / path).symlink_to(ROOT / path)
    (tmp_path / "tapeline").unlink()
    (tmp_path / "tapeline").mkdir()
    for path in (ROOT / "tapeline").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (tmp_path / "tapeline" / path.name).symlink_to(path)
    code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 60; print('ok')"
    env = os.environ | {"PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.strip().endswith("ok"), done.stderr[-500:]
