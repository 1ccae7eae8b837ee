"""Every registered library query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from litloom.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    rows, columns = found.collect(), found.columns
    if name in SQL:
        result = duck.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(columns) == sorted(names)
        wanted = sorted(tuple(text(r[names.index(c)]) for c in sorted(columns)) for r in result.fetchall())
        assert sorted(tuple(text(r[c]) for c in sorted(columns)) for r in rows) == wanted
    else:
        assert len(rows) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
