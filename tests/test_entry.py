import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from rankloom.plans.oracles import ORACLES
from rankloom.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["qid", "rank", "doc_id", "score"] and result.count() > 0


def test_names_agree():
    queries, oracles = set(entry_module.queries()), set(entry_module.oracle_sql())
    assert oracles <= queries and set(REGISTRY) <= queries
    assert set(REGISTRY) <= oracles


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = entry_module.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got, expected = df.toPandas(), con.execute(entry_module.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    got, expected = (
        f[columns].sort_values(columns).reset_index(drop=True) for f in (got, expected)
    )
    assert [str(k) for k in got.dtypes] == [str(k) for k in expected.dtypes]
    assert got.equals(expected)


def test_entry_without_a_library_of_the_subpackage():
    """A library that only the optional subpackage needs is missing: the other queries are there."""
    code = (
        "import sys, warnings; warnings.simplefilter('ignore'); sys.modules['zstandard'] = None\n"
        "sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    root = Path(entry_module.__file__).parent
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert said.stdout.split()[-2:] == [str(len(REGISTRY)), str(len(ORACLES))]
