"""The effective-date rules, one by one, on rows written out here."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campuslake.operators.effective import (
    as_of_max,
    current_active,
    earliest_row,
    latest_or_absent,
    latest_row,
    latest_row_strict,
    role_dates,
    sole_row,
    version_at,
    without_expired,
)

NOW = dt.date(2000, 1, 1)


def day(year: int) -> dt.date:
    return dt.date(year, 1, 1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture(scope="module")
def dated(spark):
    return spark.createDataFrame(
        [
            ("alone", day(1990), "a"), ("alone", day(1995), "b"),
            ("tied", day(1990), "a"), ("tied", day(1995), "b"), ("tied", day(1995), "c"),
            ("undated", day(1995), "a"), ("undated", None, "b"),
            ("twice", None, "a"), ("twice", None, "b"), ("twice", day(1999), "c"),
            ("future", day(2050), "a"),
        ],
        "key STRING, effdt DATE, value STRING",
    )


def test_strict_latest_drops_a_key_whose_latest_date_is_shared(dated):
    kept = latest_row_strict(dated, ["key"], "effdt")
    assert rows(kept) == [
        ("alone", day(1995), "b", 1), ("future", day(2050), "a", 1), ("undated", None, "b", 1),
    ]


def test_strict_latest_is_part_of_latest(dated):
    strict = latest_row_strict(dated, ["key"], "effdt").select("key", "effdt", "value")
    latest = latest_row(dated, ["key"], "effdt", ["value"])
    assert set(rows(strict)) <= set(rows(latest))


def test_latest_takes_unknown_dates_first_and_breaks_ties(dated):
    assert rows(latest_row(dated, ["key"], "effdt", ["value"]), "key", "value") == [
        ("alone", "b"), ("future", "a"), ("tied", "b"), ("twice", "a"), ("undated", "b"),
    ]


def test_earliest_takes_unknown_dates_last(dated):
    assert rows(earliest_row(dated, ["key"], "effdt", ["value"]), "key", "value") == [
        ("alone", "a"), ("future", "a"), ("tied", "a"), ("twice", "c"), ("undated", "a"),
    ]


def test_sole_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "k INT, v STRING")
    assert rows(sole_row(df, ["k"])) == [(1, "a"), (3, None)]


def test_current_active_needs_both_flags(spark):
    df = spark.createDataFrame(
        [(1, "Y", "Y"), (2, "Y", "N"), (3, "N", "Y"), (4, None, "Y")],
        "k INT, edw_curr_ind STRING, edw_actv_ind STRING",
    )
    assert rows(current_active(df), "k") == [(1,)]


@pytest.mark.parametrize("when", [dt.date(1998, 8, 15), "1998-08-15"])
def test_version_interval_is_closed(spark, when):
    df = spark.createDataFrame(
        [
            (1, dt.date(1998, 8, 15), dt.date(1999, 1, 1)),
            (2, dt.date(1998, 1, 1), dt.date(1998, 8, 15)),
            (3, dt.date(1998, 8, 16), dt.date(1999, 1, 1)),
            (4, dt.date(1998, 1, 1), None),
        ],
        "k INT, edw_eff_start_date DATE, edw_eff_end_date DATE",
    )
    assert rows(version_at(df, when), "k") == [(1,), (2,)]


def test_a_malformed_date_is_refused(spark):
    with pytest.raises(ValueError):
        version_at(spark.range(1), "15-AUG-98")


def test_as_of_max_stops_at_the_bound(spark):
    df = spark.createDataFrame(
        [("a", "19951"), ("a", "19983"), ("a", "19984"), ("b", "19991")], "k STRING, t STRING"
    )
    assert rows(as_of_max(df, ["k"], "t", F.lit("19983"))) == [("a", "19983")]


def test_absent_keys_get_nulls_and_future_only_keys_leave(spark, dated):
    base = spark.createDataFrame(
        [("alone",), ("tied",), ("undated",), ("future",), ("nobody",)], "key STRING"
    )
    joined = latest_or_absent(base, base, dated, "key", "effdt", NOW)
    assert rows(joined, "key", "value") == [
        ("alone", "b"), ("nobody", None), ("tied", "b"), ("tied", "c"),
        ("undated", "a"), ("undated", "b"),
    ]


def test_a_role_older_than_another_does_not_hold_when_dated_together(spark):
    df = spark.createDataFrame(
        [
            ("old", "gender", day(1990)), ("old", "tribe", day(1995)),
            ("same", "gender", day(1995)), ("same", "tribe", day(1995)),
            ("only", "tribe", day(1995)), ("later", "gender", day(2050)),
        ],
        "key STRING, name STRING, effdt DATE",
    )
    roster = df.select("key").distinct()
    roles = {n: F.col("name") == n for n in ("gender", "tribe")}
    apart = without_expired(roster, role_dates(df, "key", "effdt", NOW, roles), "key", roles)
    together = without_expired(
        roster, role_dates(df, "key", "effdt", NOW, roles, True), "key", roles
    )
    assert rows(apart, "key") == [("old",), ("only",), ("same",)]
    assert rows(together, "key") == [("only",), ("same",)]
