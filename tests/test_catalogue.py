"""Every catalogue query against its SQL in DuckDB."""

import datetime
import decimal

import duckdb
import pytest

from tallyline.plans import catalogue, report_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, datetime.datetime):
        return x.date()
    return int(x) if isinstance(x, (decimal.Decimal, bool)) else x


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, db, name):
    found = catalogue.QUERIES[name](spark, SF)
    cols = sorted(found.columns)
    want = db.sql(catalogue.ORACLE[name])
    assert sorted(want.columns) == cols
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(plain(x) for x in r) for r in found.select(cols).collect()), key=key)
    b = sorted((tuple(plain(x) for x in r) for r in want.project(", ".join(f'"{c}"' for c in cols)).fetchall()), key=key)
    assert a == b


@pytest.mark.parametrize("name", ["report_ftx", "report_ptx", "report_ltx", "report_ftu", "key_builder"])
def test_keys_of_seven_digits(spark, tmp_path, name):
    """Orders whose keys have the first six digits in common are told apart."""
    con = duckdb.connect()
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.sql(f"copy (select * replace ({key} + 999_900 as {key}) from '{SF}/{t}.parquet') to '{tmp_path}/{t}.parquet'")
        con.sql(f"create view {t} as from '{tmp_path}/{t}.parquet'")
    found = catalogue.QUERIES[name](spark, str(tmp_path))
    cols = ", ".join(f'"{c}"' for c in found.columns)
    rows = lambda of: sorted(tuple(map(str, map(plain, r))) for r in of)
    assert rows(found.collect()) == rows(con.sql(f"select {cols} from ({catalogue.ORACLE[name]})").fetchall())
