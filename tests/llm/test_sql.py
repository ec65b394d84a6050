"""Corpus queries against their SQL."""

from __future__ import annotations

import oracle
import pytest

from conftest import SF_DIR
from strata.llm import queries


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_its_sql(spark, connection, name):
    df, sql = queries.QUERIES[name](spark, SF_DIR), queries.ORACLE[name]
    assert oracle.spark_types(df) == oracle.sql_types(connection, sql)
    assert oracle.spark_rows(df) == oracle.sql_rows(connection, sql)


@pytest.mark.parametrize("name", ["op2_decontamination", "op8_sharding", "op10_quality"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
