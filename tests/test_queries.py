"""Every query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from terravane.plans import catalog

TABLES = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else float(f"{v:.10g}")
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in TABLES.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, sql, name):
    df = catalog.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    found = sql.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
