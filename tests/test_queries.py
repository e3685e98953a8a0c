"""Every query of the engine against its SQL on the same tables, and what has no SQL against its own rules."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from leafmark import catalog

SF = "/root/testdata/sf0.001"
OWN = {n: f for m in catalog.MODULES for n, f in m.queries().items()}
SQL = {n: s for m in catalog.MODULES for n, s in m.oracle_sql().items()}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, tmp_path, name):
    out = f"{tmp_path}/o"
    frame = OWN[name](spark, SF)
    frame.write.parquet(out)
    con.sql(f"CREATE OR REPLACE TEMP TABLE want AS {SQL[name]}")
    columns = sorted(c[0] for c in con.sql("DESCRIBE want").fetchall())
    assert columns == sorted(frame.columns)
    c = ", ".join(f'"{x}"' for x in columns)
    for a, b in (("want", f"'{out}/*.parquet'"), (f"'{out}/*.parquet'", "want")):
        assert con.sql(f"SELECT {c} FROM {a} EXCEPT ALL SELECT {c} FROM {b} LIMIT 3").fetchall() == []


@pytest.mark.parametrize("name", sorted(set(OWN) - set(SQL)))
def test_runs(spark, name):
    assert OWN[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 15
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_is_native(spark):
    plan = OWN["cite_resolve"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['leafmark.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))"
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert got.stdout.split() == [str(len(OWN)), "False"], got.stderr
