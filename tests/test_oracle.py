"""Every query with an oracle equals its DuckDB SQL (rows, columns, value hash) at sf0.001."""

import pytest

from conftest import SF001
from oracle_compare import compare
from panelrank.plans import registry

ORACLES = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck001, name):
    r = compare(spark, duck001, name, QUERIES[name], ORACLES[name], SF001)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r
    assert not r["type_diff"], r


def test_every_query_is_registered_once():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 90
