"""The driver's entry points, and every engine query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from vacantia import queries as engine

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(engine.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = engine.queries()[name](spark, SF)
    want = con.execute(engine.SQL[name])
    names = [d[0] for d in want.description]
    norm = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert sorted(df.columns) == sorted(names)
    assert norm(df.select(*[f"`{n}`" for n in names]).collect()) == norm(want.fetchall())
