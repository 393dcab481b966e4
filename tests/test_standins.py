"""Every proof query against its SQL, and plans that must hold at scale."""

import sys
from pathlib import Path

import pytest
from conftest import plan

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as driver  # noqa: E402
from compare import compare, oracle, type_differences  # noqa: E402

from dugout import standins  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# The optional subpackage's queries have tests of their own.
CASES = {name: query for name, query in driver.queries().items() if name in standins.CASES}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle(FOLDER)


def check_shape(text):
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in text
    # A window after a single-task exchange may only see one count per partition.
    lines = text.splitlines()
    for i in (i for i, line in enumerate(lines) if "Window [" in line):
        below = "\n".join(lines[i : i + 3])
        assert "SinglePartition" not in below or "__part" in below


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_equals_sql(spark, db, name):
    df = CASES[name](spark, FOLDER)
    check_shape(plan(df))
    assert compare(db, driver.oracle_sql()[name], df.columns, df.collect()) == ""
    assert type_differences(db, driver.oracle_sql()[name], df.dtypes) == {}


def test_every_query_has_sql():
    assert set(CASES) == set(standins.CASES)
    assert set(driver.oracle_sql()) >= set(CASES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_filters_reach_the_scan(spark):
    text = plan(CASES["date_range_scan"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "In(o_orderstatus" in text
    text = plan(CASES["param_scan"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_totalprice,250000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text


def test_backlog_by_group_keeps_the_topics(spark):
    lag = CASES["backlog_by_group"](spark, FOLDER)
    assert lag.columns == ["group", "topic", "behind"]
    totals = {row["group"]: row["sum(behind)"] for row in lag.groupBy("group").sum("behind").collect()}
    assert totals == {row["group"]: row["behind"] for row in CASES["backlog_group_total"](spark, FOLDER).collect()}
    assert lag.count() > len(totals)


def test_play_documents_make_common_parts_once(spark):
    text = plan(CASES["flatten_plays"](spark, FOLDER))
    assert text.count("date_format(") == 2 and text.count("from_json(") == 1
