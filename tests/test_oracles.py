"""Every query of the library proper against its DuckDB SQL at the smallest size."""

import math

import duckdb
import pytest

from foliant.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else f"{x:.9g}"
    return x if x is None or isinstance(x, (int, str, bool)) else str(x)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_equals_its_sql(spark, db, name):
    got = plans.queries()[name](spark, SF)
    want = db.execute(plans.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    theirs = sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=repr)
    assert mine == theirs
