from types import SimpleNamespace

import pytest

from textlab.llm.queries import QUERIES, SQL
from tools.oracle_check import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, duck, sf_dir, name):
    problems, n, _, _ = compare(spark, duck, name, SimpleNamespace(build=QUERIES[name], sql=SQL[name]), sf_dir)
    assert not problems and n > 0
