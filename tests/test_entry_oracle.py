"""Driver contract and the DuckDB oracle on the smallest driver tables."""

import inspect
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sparkwright.sources.tables import TABLES
from tests.conftest import SF_SMOKE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


# Plan nodes no registered query may contain: pair tables and row-at-a-time Python.
FORBIDDEN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    build = E.queries()[name]
    # Forests of the registered size take minutes; their checks hold for small ones.
    sizes = {"forest": {"num_trees": 8, "max_depth": 4, "seed": 1}} if "forest" in inspect.signature(build).parameters else {}
    if "flags_forest" in inspect.signature(build).parameters:
        sizes["flags_forest"] = {"num_trees": 8, "max_depth": 3, "seed": 1}
    if name == "ml_forest_agrees":
        sizes = {"forest": {"num_trees": 60, "max_depth": 12, "seed": 1}}
    df = build(spark, SF_SMOKE, **sizes)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [n for n in FORBIDDEN_NODES if n in plan] == []
    sp = df.toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(sp) == _rows(dk)
