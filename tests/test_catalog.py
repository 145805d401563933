"""The catalog: every oracle agrees on the smallest tables, and the core stands without the text subpackage."""

import glob
import os
import re
from pathlib import Path

import pandas as pd
import pytest

from acervo.plans import ALL

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


def norm(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return "∅"
    return f"{float(x):.6g}" if type(x).__name__ in ("float", "float64", "Decimal") else str(x)


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ALL.oracles))
def test_oracle(spark, con, name):
    a, b = ALL.queries[name](spark, SF).toPandas(), con.execute(ALL.oracles[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    c = sorted(a.columns)
    rows = lambda d: sorted(tuple(norm(x) for x in r) for r in d[c].itertuples(index=False))
    assert rows(a) == rows(b)


def test_nothing_imports_the_text_subpackage():
    for p in (ROOT / "acervo").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"acervo\.llm|from acervo import llm", p.read_text()), p


def test_queries_name_no_subset():
    for p in (ROOT / "acervo" / "plans").glob("*.py"):
        assert not re.search(r"\.limit\(|\.sample\(", p.read_text()), p
