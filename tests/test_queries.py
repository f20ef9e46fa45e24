"""Every registered query against its SQL twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from workload.oracle import oracle_sql
from workload.queries import queries

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, str(SF))
    got = table(df.columns, df.collect())
    rel = duck.execute(oracle_sql()[name])
    want = table([d[0] for d in rel.description], rel.fetchall())
    assert got == want
