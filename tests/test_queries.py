"""Every registered query against its DuckDB oracle at sf0.01 (the driver's check)."""

import pytest

from lakeshift.queries.compare import compare
from lakeshift.queries.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_CHECK


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF_CHECK)
    if not r["ok"]:
        pytest.fail("\n".join(f"{k}: {v}" for k, v in r.items()))  # whole rows: pytest cuts what it shows of an assertion


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    assert df.schema == e.entry(spark).schema
