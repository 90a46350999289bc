"""Every registered query against its comparison SQL, and the shape of its plan."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.check_catalog import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.LIBRARY, entry.LIBRARY_SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows, problem = compare(spark, con, SF, QUERIES[name], SQL.get(name))
    assert problem is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_compares_no_rows_pairwise(spark, name):
    """No cross or nested-loop join, and no Python in any plan."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoop|BatchEvalPython|ArrowEvalPython|MapIn", plan)


@pytest.mark.parametrize("name,twin", [
    ("r11_monthly_totals", "r11_monthly_totals_every_box"),
    ("r13_image_inventory", "r13_image_inventory_every_location")])
def test_look_alike_rows_are_in_the_tables(spark, name, twin):
    sf = SF.replace("0.001", "0.01")
    assert {tuple(r) for r in QUERIES[name](spark, sf).collect()} != {
        tuple(r) for r in QUERIES[twin](spark, sf).collect()}


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["CheckInDate", "ImageCount"]


@pytest.mark.parametrize("missing, left", [
    ("xxhash", 0), ("corpus_pipeline", 0), (None, len(entry.LLM))])
def test_library_stays_without_packages_of_the_operators(missing, left):
    """In a process of its own, with a package that cannot be imported."""
    block = f"import sys; sys.modules[{missing!r}] = None; " if missing else ""
    code = block + ("import __spark_entry__ as e; print(len(e.LIBRARY) == len(e.queries()), "
                    "len(e.LLM))")
    found = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True,
                           text=True, cwd=Path(entry.__file__).parent)
    alone, operators = found.stdout.split()
    assert int(operators) >= left and (alone == "True") == (operators == "0")
