"""Every registered query against its SQL on the smallest tables."""

import ast
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import verify
from checks import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in verify.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict, _, good = verify.compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert good, verdict


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("path", sorted(Path(registry.__file__).parent.glob("*.py")), ids=lambda p: p.stem)
def test_no_check_replaces_another_name(path):
    named = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, ast.FunctionDef)]
    assert len(named) == len(set(named)), sorted(n for n in set(named) if named.count(n) > 1)
