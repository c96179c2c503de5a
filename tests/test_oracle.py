"""Every catalogue query vs its DuckDB oracle at sf0.001: names, types and row multisets."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from dugout.plans.catalog import QUERIES_EXACT
from dugout.plans.oracle import ORACLE_EXACT

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return str(v)
    return repr(v)


@pytest.mark.parametrize("name", sorted(ORACLE_EXACT))
def test_query_matches_oracle(spark, duck, name):
    """Exact (DECIMAL) library output vs the exact oracle: names, types and values."""
    df = QUERIES_EXACT[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE_EXACT[name])
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(x) for x in df.columns]
    drows = [tuple(r[i] for i in at) for r in drows]
    for f, d in zip(df.schema.fields, [cur.description[i] for i in at]):
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t.upper()) == str(d[1]), (f.name, t, d[1])
    assert Counter(tuple(map(_norm, r)) for r in srows) == Counter(tuple(map(_norm, r)) for r in drows)


@pytest.mark.parametrize("name", ["fip", "team_payroll", "dq_ledger", "war_top10"])
def test_presented_queries_are_double(spark, duck, name):
    """The registered (presented) form: no DECIMAL left, and still equal to the wrapped oracle."""
    df = E.queries()[name](spark, SF)
    assert not any(f.dataType.simpleString().startswith("decimal") for f in df.schema.fields)
    cur = duck.execute(E.oracle_sql()[name])
    assert [str(d[1]) for d in cur.description if str(d[1]).startswith("DECIMAL")] == []
    assert Counter(map(repr, (tuple(r) for r in df.collect()))) == Counter(map(repr, cur.fetchall()))
