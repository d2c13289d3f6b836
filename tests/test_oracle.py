"""Every query with SQL gives the rows that DuckDB gives."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


def plain(frame: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        try:
            return f"{float(v):.9g}"
        except (TypeError, ValueError):
            return str(v)

    return sorted(tuple(value(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if Path(p).is_file() else p + '/*.parquet'}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", ["rmsd_best3", "directional_umi", "adapter_match"])
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["cell", "chrom", "bin", "n"]
