"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import os
import sys

import oracle
import pytest

import __spark_entry__ as entry
from strata.operators.select import choose_match
from workload import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = ORACLE

# Operators that would make Python, a cross join or one task the bottleneck.
UNWANTED = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    assert not [node for node in UNWANTED if node in plan]
    names, got = oracle.spark_rows(df)
    assert sum(got.values()) > 0
    if name in SQL:
        sql_names, expected = oracle.sql_rows(connection, SQL[name])
        assert names == sql_names
        assert oracle.spark_types(df) == oracle.sql_types(connection, SQL[name])
        assert got == expected


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("position", [None, "event_id"])
def test_only_distinct_names_are_ranked(spark, position):
    """The names are counted by a hash aggregate before any of them is compared."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    chosen = choose_match(events, "event_type", ["purch", "view"], position=position)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[name" in plan and "HashAggregate(keys=[name" in plan.split("CASE WHEN")[-1]


def test_entry_without_the_corpus_folder(monkeypatch):
    """What hangs on the corpus subpackage goes with it; a fault inside it is not hidden."""
    for name in ("strata.llm", "corpus_pipeline"):
        with monkeypatch.context() as context:
            for module in [m for m in sys.modules if m.startswith("strata.llm")]:
                context.delitem(sys.modules, module)
            context.setitem(sys.modules, name, None)
            assert set(entry.queries()) == set(QUERIES) and entry.oracle_sql() == ORACLE
    with monkeypatch.context() as context:
        for module in [m for m in sys.modules if m.startswith("strata.llm")]:
            context.delitem(sys.modules, module)
        context.setitem(sys.modules, "zlib", None)
        with pytest.raises(ModuleNotFoundError, match="zlib"):
            entry.queries()


def test_entry(spark):
    assert entry.entry(spark).columns == ["date", "source", "variable", "unit", "value"]


def test_pushed_filters(spark):
    plan = QUERIES["serving_query_on_stored_trend"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,ERA5)]" in plan
    assert "ReadSchema: struct<date:date,source:string,value:double>" in plan
    plan = QUERIES["mean_of_chosen_target"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "EqualTo(event_type,ScalarSubquery" in plan
