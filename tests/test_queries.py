"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from screenloom.plans import QUERIES, SQL

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
#: Slow ones are held against brute force in other tests.
SLOW = {"q9_13_match_iteratively", "q9_12_ransac_inliers"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


#: Means that both sides round to few digits: a tie may fall either way.
LAST_DIGIT = {"q4_9_tile_qc": 1e-3, "q4_28_benchmark_summary": 1e-4}


def plain(v):
    if v is None or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | float | np.number):
        return float(v)
    if isinstance(v, list | np.ndarray):
        return tuple(map(plain, v))
    return str(v)


def rows(pdf):
    """Column names and rows; in order of what isn't a fraction, then of the rest."""
    names = sorted(pdf.columns)
    out = [tuple(map(plain, r)) for r in pdf[names].astype(object).itertuples(index=False, name=None)]
    whole = lambda v: not isinstance(v, float) or v.is_integer()
    return names, sorted(out, key=lambda r: (repr([v if whole(v) else None for v in r]), repr(r)))


def same(a, b, tolerance):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-8, abs_tol=tolerance)
    return a == b


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    (names, got), (wanted_names, want) = rows(QUERIES[name](spark, str(DATA)).toPandas()), rows(duck.sql(SQL[name]).df())
    assert names == wanted_names and len(got) == len(want)
    tolerance = 1.01 * LAST_DIGIT.get(name, 1e-9)
    assert [(a, b) for a, b in zip(got, want, strict=True) if not all(same(x, y, tolerance) for x, y in zip(a, b, strict=True))] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_runs(spark, name):
    first = QUERIES[name](spark, str(DATA))
    assert first.columns
    first.limit(3).collect()


def test_entry_without_llm(tmp_path):
    """The entry module works when the llm folders are gone."""
    import shutil
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "screenloom", tmp_path / "screenloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q3_4_best_guide_per_cell' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env=env)
