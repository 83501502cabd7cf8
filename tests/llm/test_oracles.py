"""Queries with an SQL twin against it, values and types."""

import check
import pytest
from conftest import TESTDATA

from tidemill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    con = check.connect(TESTDATA)
    result, _ = check.compare(spark, con, name, QUERIES[name], ORACLES[name], TESTDATA)
    con.close()
    assert result.startswith("ok") and "TYPES" not in result and "EMPTY" not in result, result


def test_all_are_registered():
    import __spark_entry__ as entry
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
