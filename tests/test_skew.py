"""One ticker with a third of all trades: same results as in SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tapeline.sources import driver_tables


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf_dir):
    folder = tmp_path_factory.mktemp("skewed")
    for path in Path(sf_dir).glob("*.parquet"):
        if path.stem != "lineitem":
            (folder / path.name).symlink_to(path)
    duckdb.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 1
                                    ELSE l_suppkey END AS l_suppkey)
                  FROM '{sf_dir}/lineitem.parquet')
            TO '{folder}/lineitem.parquet'"""
    )
    return str(folder)


@pytest.mark.parametrize(
    "name", ["fct_daily_trading", "sliced_signals", "quality_report", "performance_52w"]
)
def test_hot_ticker(name, spark, skewed):
    con = duckdb.connect()
    for path in Path(skewed).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries()[name](spark, skewed)
    columns = sorted(df.columns)
    cursor = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})")
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    assert ours == Counter(cursor.fetchall())
