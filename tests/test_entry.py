from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from graphloom.plans.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in "part lineitem documents".split():
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = con.execute("select " + ", ".join(f'"{c}"' for c in columns) + f" from ({ORACLES[name]})").fetchall()
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_corpus_operators():
    code = "import sys; sys.modules['graphloom.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), sum('op1_' in q for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[-2]) == len(QUERIES) and out[-1] == "0"
