"""Every query of the engine with SQL equals that SQL in DuckDB on the small tables; the others give rows of a stable schema."""

import pytest

from tests.compare import SF, connect, rows
from tracklore.plans import catalogue


@pytest.fixture(scope="module")
def duck():
    return connect()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in catalogue.SQL:
        assert df.columns and got
        return
    result = duck.execute(catalogue.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, result.fetchall())
