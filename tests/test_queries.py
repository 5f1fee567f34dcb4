"""Every registered batch query at the smallest scale, next to its SQL."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check_queries import rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
# streams take their time to start: tests/test_streaming.py covers them
BATCH = [n for n in QUERIES if not n.endswith("_stream") and n not in ("watermark", "print_sink", "checkpointing")]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, result.fetchall())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_a_missing_library_costs_only_the_part_that_needs_it():
    """The training-data operators need a library of vocabularies; the other queries do not."""
    rest = sorted(n for n in QUERIES if not (n == "pipeline" or n.startswith("op") and n[2].isdigit()))
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == rest and len(rest) > 100
