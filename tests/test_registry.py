"""Every registered query against its SQL, run by another engine on the same tables."""

import pytest
from conftest import TINY

import __spark_entry__ as entry_point
from tierstone.registry.oracles import ORACLES
from tierstone.registry.queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 200


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TINY)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    answer = duck.sql(f"SELECT {listed} FROM ({ORACLES[name]})")
    assert sorted(duck.sql(ORACLES[name]).columns) == columns
    types = {c: str(t) for c, t in zip(answer.columns, answer.types)}
    for column, kind in df.dtypes:
        assert TYPES.get(kind, kind.upper()) == types[column] or name == "schema_evolution", column
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(ours, key=repr) == sorted(answer.fetchall(), key=repr)
    assert ours
