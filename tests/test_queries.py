"""Every registered query against its SQL on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.check_queries import compare, connect  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf, name):
    result = compare(spark, duck, sf, entry.queries()[name], SQL[name])
    assert result.startswith("ok") or (result == "EMPTY" and name.startswith("H3_examples_mejores")), result


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and {"nivel_demanda", "score_demanda_0_100", "origen_zona"} <= set(out.columns)
