"""Every registered query with oracle SQL equals DuckDB on the same tables."""

import pytest

from textlab.plans.registry import all_queries
from tools.oracle_check import compare

_QUERIES = all_queries()
_WITH_SQL = sorted(n for n, q in _QUERIES.items() if q.sql is not None)


@pytest.mark.parametrize("name", _WITH_SQL)
def test_query_matches_oracle(spark, duck, sf_dir, name):
    problems, _, _, _ = compare(spark, duck, name, _QUERIES[name], sf_dir)
    assert not problems, problems


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["rank", "pattern", "pos", "neg", "score"]
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
