"""Every registered query against its SQL in DuckDB, rows and exact values."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tapeline.plans.oracle import oracle_sql
from tapeline.plans.registry import QUERIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def test_all_have_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert sum(ours.values()) == sum(theirs.values())
    extra, missing = ours - theirs, theirs - ours
    assert not extra and not missing, (
        f"{sum(extra.values())} rows differ\n"
        f"ours {sorted(extra, key=str)[:3]}\nsql  {sorted(missing, key=str)[:3]}"
    )
    assert sum(ours.values()) > 0
