"""Every registered query with an oracle gives exactly the oracle's rows."""

import re

import pytest

import __spark_entry__ as entry_point
from tests.compare import duck_rows, oracle_connection, spark_rows

ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    cols, got = spark_rows(df)
    want_cols, want = duck_rows(con, ORACLES[name])
    assert cols == want_cols
    assert len(got) == len(want)
    assert got, "a query should have rows on this data"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, f"{len(wrong)} of {len(got)} rows differ, first: {wrong[0]}"

    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name.startswith("op"):
        return
    python = set(re.findall(r"\w*(?:EvalPython|InPandas|InArrow)\w*", plan))
    assert python == ({"FlatMapGroupsInPandas"} if name == "correlation_matrix" else set())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())


def test_entry_runs(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
