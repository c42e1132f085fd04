"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checker import check, connect
from fixtures.registered import REGISTERED

FOLDER = "/root/testdata/sf0.001"
EAGER = {"sink_replace", "sink_append", "bio_demographics"}


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert REGISTERED.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", REGISTERED)
def test_matches_sql(spark, tables, name):
    check(queries()[name](spark, FOLDER), tables, oracle_sql()[name])


def test_entry_has_rows(spark):
    rows = entry(spark).collect()
    assert len(rows) == 3 and sum(r.ttl for r in rows) == 10


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTERED.keys() - EAGER))
def test_plan_is_joinable_and_native(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in text


@pytest.mark.parametrize("name", ["term_enrollment", "course_enrollment", "race_detail"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_enrolled_students_are_a_semi_join(spark):
    assert "LeftSemi" in plan(queries()["race_detail"](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark):
    text = queries()["version_at_date"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PushedFilters" in text and "l_extendedprice" not in text.split("== Physical Plan ==")[1]
