"""Registered queries against their SQL twins at the smallest scale.

A sample by default; LARDER_ALL=1 runs every query.
"""

import glob
import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of

DIR = "/root/testdata/sf0.001"
OWN = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]
SAMPLE = ["a6_title_value_counts", "a12_histogram", "l10_admitted_links", "f2_page_limit", "h6_ingredient_groups",
          "h16_recipe_rows", "i9_ranges", "i27_alternatives", "g4_coverage", "s6_key_rule"]
NAMES = OWN if os.environ.get("LARDER_ALL") else SAMPLE
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def test_catalog_needs_no_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(entry.queries())), str(len(entry.oracle_sql()))]


def test_every_query_has_its_twin():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
