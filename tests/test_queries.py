"""Every registered query against its SQL on the driver tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import compare
from passtrail.plans.oracles import ORACLES
from passtrail.plans.queries import QUERIES

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.duck(BASE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, BASE))
    expected_names, expected = compare.duck_rows(con, ORACLES[name])
    assert names == expected_names
    assert rows == expected


def test_queries_without_sql_run(spark):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, BASE).count() > 0


def test_all_are_registered():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_results_are_flat(spark):
    for name, query in QUERIES.items():
        kinds = [t for _, t in query(spark, BASE).dtypes]
        assert not any(t.startswith(("array", "struct", "map", "binary")) for t in kinds), name


def test_names_are_known_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
