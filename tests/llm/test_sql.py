"""Queries of this package that SQL can say, next to their SQL on the given tables, types included."""

import pytest
from check import OK_TYPES, plain
from conftest import DATA

from bazaarmill.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    rel = con.sql(SQL[name])
    names, types = list(rel.columns), [str(x) for x in rel.types]
    assert sorted(names) == sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert all((kinds[n], t) in OK_TYPES for n, t in zip(names, types))
    rows = lambda x: sorted(str([plain(v) for v in r]) for r in x)
    assert rows(df.select(*names).collect()) == rows(rel.fetchall())
