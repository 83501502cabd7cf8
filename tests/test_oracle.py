"""Every query with an SQL twin must give the twin's rows, types included."""

import subprocess
import sys

import check
import pytest
from conftest import TESTDATA

from tidemill import bindings
from tidemill.session import STATE_STORE


@pytest.fixture(scope="module")
def duck():
    con = check.connect(TESTDATA)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_query(spark, duck, name):
    sql = bindings.ORACLES.get(name)
    result, _ = check.compare(spark, duck, name, bindings.QUERIES[name], sql, TESTDATA)
    if sql is None:
        assert result.startswith("rows-only") and not result.endswith(" 0")
    else:
        assert result.startswith("ok") and "EMPTY" not in result and "TYPES" not in result, result


@pytest.mark.parametrize("name", ["dom_07_fraud_rules_stream", "dom_07_fraud_rules_trailing_stream", "jon_08_asof_lookup_stream", "str_05_session_tracker_live"])
def test_keyed_streams_bring_their_store(spark, duck, name):
    """A session with Spark's default state store, as a caller's may be, is enough; it is left as it was."""
    default, before = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider", spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, default)
    try:
        result, _ = check.compare(spark, duck, name, bindings.QUERIES[name], bindings.ORACLES[name], TESTDATA)
        assert result.startswith("ok") and "EMPTY" not in result and "TYPES" not in result, result
        assert spark.conf.get(STATE_STORE) == default
    finally:
        spark.conf.set(STATE_STORE, before)


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("hidden", [["tidemill.llm", "corpus_pipeline"], ["tidemill.llm"], ["corpus_pipeline"]])
def test_entry_without_the_training_data_package(hidden):
    """The entry imports, and has all of the library's queries, when the package or its pipeline is left out."""
    code = ("import sys\nfor name in %r: sys.modules[name] = None\nimport __spark_entry__ as e\nfrom tidemill import bindings\n"
            "assert set(bindings.QUERIES) <= set(e.queries()) and 'pipeline' not in e.queries()\n"
            "assert any(q.startswith('op1_') for q in e.queries()) == ('tidemill.llm' not in sys.argv[1:])" % hidden)
    if "tidemill.llm" not in hidden and not (check.Path(__file__).parents[1] / "tidemill" / "llm" / "queries.py").exists():
        pytest.skip("the package is left out")
    done = subprocess.run([sys.executable, "-c", code, *hidden], cwd=check.Path(__file__).parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
