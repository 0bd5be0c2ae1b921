"""Registered corpus queries on the smallest data, against their SQL where they have one."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from presswork.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, tiny, name):
    df = entry_module.queries()[name](spark, tiny)
    columns = sorted(df.columns)
    got = sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return
    import os

    con = duckdb.connect()
    for file in os.listdir(tiny):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{tiny}/{file}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted([tuple(r[names.index(c)] for c in columns) for r in result.fetchall()], key=repr)


def test_names_of_the_found_queries():
    found = entry_module.queries()
    for n in (1, 2, 3, 4, 5, 6, 7, 10):
        assert f"p{n}_found" in found
    assert "p8_ids" in found and "p9_containers" in found
