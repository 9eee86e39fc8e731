import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from sessionloom.llm import queries  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    same, note = check_oracle.compared(spark, con, name, sf_dir)
    assert same, note


def test_all_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(any(q.startswith(n) for q in entry.queries()) for n in names)
    assert "pipeline" in entry.queries()
