"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from tablebridge.plans.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(round(float(v), 6) + 0.0) if isinstance(v, (float, decimal.Decimal)) else str(v)


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, oracle):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    r = oracle.execute(ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(shown(dict(zip(names, x, strict=True))[c]) for c in columns) for x in r.fetchall())


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_module_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 60)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "True"
