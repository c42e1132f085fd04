"""Joins, counts, pivot and expressions; the skewed joins really split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campuslake.functions.expressions import (
    display_name,
    federal_category,
    is_primary,
    may_enroll,
    preferred_first_name,
)
from campuslake.operators.effective import latest_row_peers
from campuslake.operators.relational import (
    distinct_pair_count,
    group_max_known_keys,
    left_join_spread,
    left_join_suffixed,
    pivot_count_total,
    spread_join,
)
from campuslake.plans import enrollment, people, snapshot


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_left_join_suffix(spark):
    schema = "k INT, x STRING, cnt INT"
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", 7)], schema)
    right = spark.createDataFrame([(1, "p", 8), (1, "q", 9), (4, "r", 1)], schema)
    joined = left_join_suffixed(left, right, ["k"], "_crs")
    assert joined.columns == ["k", "x", "cnt", "x_crs", "cnt_crs"]
    assert rows(joined) == [
        (1, "a", 5, "p", 8), (1, "a", 5, "q", 9), (2, "b", 6, None, None), (3, "c", 7, None, None),
    ]


def test_spread_join_keeps_matches_across_types(spark):
    many = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, x STRING")
    few = spark.createDataFrame([(1, "p")], "k LONG, y STRING")
    assert rows(spread_join(many, few, "k", "left"), "x", "y") == [("a", "p"), ("b", None)]


def test_unknown_keys_leave_grouped_maxima_and_nulls_are_skipped(spark):
    df = spark.createDataFrame(
        [("a", "s", "N"), ("a", "s", "Y"), ("a", "s", None), ("b", None, "Y")],
        "k STRING, d STRING, h STRING",
    )
    assert rows(group_max_known_keys(df, ["k", "d"], ["h"])) == [("a", "s", "Y")]


def test_a_null_value_counts_as_a_pair(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("a", "1"), ("a", None), ("b", None), (None, "1")], "k STRING, v STRING"
    )
    assert rows(distinct_pair_count(df, "k", "v", "n")) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("values", [None, ["N", "R"]])
def test_pivot_leaves_missing_cells_null_and_totals_the_rest(spark, values):
    df = spark.createDataFrame(
        [("g", "R"), ("g", "R"), ("u", "N"), ("u", "R"), ("u", None), (None, "R")],
        "c STRING, t STRING",
    )
    wide = pivot_count_total(df, "c", "t", values)
    assert wide.columns == ["c", "N", "R", "ttl"]
    assert rows(wide) == [("g", None, 2, 2), ("u", 1, 1, 2)]


def test_display_name_keeps_the_blank_of_a_missing_middle_name(spark):
    text, none = F.lit, F.lit(None).cast("string")
    assert one(spark, display_name(text("Ash"), text("Bo"), none)) == "Ash,Bo "
    assert one(spark, display_name(none, none, none)) == ", "


def test_a_blank_preferred_name_is_no_name(spark):
    legal = F.lit("Robert")
    assert one(spark, preferred_first_name(F.lit("Bob"), legal)) == "Bob"
    assert one(spark, preferred_first_name(F.lit(" "), legal)) == "Robert"
    assert one(spark, preferred_first_name(F.lit(None).cast("string"), legal)) == "Robert"


def test_an_unknown_withdrawal_is_not_a_pass(spark):
    df = spark.createDataFrame(
        [(1, "Y", "WDR"), (2, "N", None), (3, "N", "NWD"), (4, None, "WDR"), (5, None, "NWD")],
        "k INT, e STRING, w STRING",
    )
    assert rows(df.filter(may_enroll(F.col("e"), F.col("w"))), "k") == [(1,), (3,), (5,)]


def test_category_rules_apply_in_order(spark):
    df = spark.createDataFrame(
        [
            ("4", "Y", 3, "G"), ("1", "Y", 3, "G"), ("1", "N", 2, "G"), ("1", "N", 1, "G"),
            ("1", None, 0, None),
        ],
        "s STRING, h STRING, n LONG, g STRING",
    )
    category = federal_category(F.col("s"), F.lit("USA"), F.col("h"), F.col("n"), F.col("g"))
    assert [r.v for r in df.select(category.alias("v")).collect()] == [
        "International", "Hispanic/Latino", "Two or more", "G", None,
    ]


def test_primary_rule(spark):
    df = spark.createDataFrame(
        [(0, "U", "N", 1, 1), (1, "U", "U", 1, 2), (1, "G", "U", 1, 1), (2, "U", "U", 1, 1),
         (2, "G", "G", 1, 2), (2, "U", "U", None, None), (1, "U", None, 1, 1)],
        "n LONG, c STRING, b STRING, lo INT, p INT",
    )
    flag = is_primary(*(F.col(c) for c in ("n", "c", "b", "lo", "p")))
    assert [r.v for r in df.select(flag.alias("v")).collect()] == [0, 1, 0, 1, 0, 0, 0]


def test_credits_count_once_per_career_and_residency_row(spark):
    day, end = dt.date(1990, 1, 1), dt.date(9999, 12, 31)
    enrolled = spark.createDataFrame(
        [("p", "19983", "U", "I", 3, None, "E", day, end)] * 2,
        "emplid STRING, strm STRING, acad_career STRING, institution STRING, unt_taken INT, "
        "unt_billing INT, stdnt_enrl_status STRING, edw_eff_start_date DATE, edw_eff_end_date DATE",
    )
    careers = spark.createDataFrame(
        [("p", "19983", c, "U", "I", "Y", None, day, end) for c in ("U", "U", "G")],
        "emplid STRING, strm STRING, acad_career STRING, billing_career STRING, "
        "institution STRING, elig_to_enroll STRING, withdraw_code STRING, "
        "edw_eff_start_date DATE, edw_eff_end_date DATE",
    )
    lived = spark.createDataFrame(
        [("p", c, "I", "19951", "r", "r", "r", "r", day, end) for c in ("U", "U", "G")],
        "emplid STRING, acad_career STRING, institution STRING, effective_term STRING, "
        "residency STRING, admission_res STRING, tuition_res STRING, fin_aid_fed_res STRING, "
        "edw_eff_start_date DATE, edw_eff_end_date DATE",
    )
    sums = snapshot.term_credits(enrolled, careers, lived, F.lit("19983"), "1998-08-15")
    # two classes of 3 credits, two residency rows, and two or one career rows
    assert rows(sums, "acad_career", "sum_unt_taken", "sum_unt_billing") == [
        ("G", 12, None), ("U", 24, None),
    ]


def test_earliest_term_is_taken_over_the_unfiltered_relation(spark):
    held = spark.createDataFrame(
        [("p", "U", "I", t, c, "Y", "Y") for t, c in (("19962", "later"), ("19983", "last"))],
        "emplid STRING, acad_career STRING, institution STRING, effective_term STRING, "
        "city STRING, edw_curr_ind STRING, edw_actv_ind STRING",
    ).selectExpr("*", "'s' AS state", "'c' AS county", "'n' AS country")
    every = held.select("emplid", "acad_career", "effective_term")
    older = spark.createDataFrame([("p", "U", "19951")], every.schema)
    assert rows(people.official_residency(held, every), "city") == [("later",)]
    assert rows(people.official_residency(held, every.union(older))) == []


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df) -> tuple[int, str]:
    read_all = F.sum(F.hash(*df.columns).cast("long"))
    counted = df.agg(read_all, F.count(F.lit(1)).alias("n"))
    count = counted.collect()[0].n
    return count, counted._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_rows(spark):
    """300,000 rows over 5,000 keys, a third of them under one key."""
    number = F.col("id")
    return spark.range(0, 300_000, 1, 12).select(
        F.when(number % 3 == 0, 7).otherwise(number % 5_000).alias("key"),
        number.alias("value"),
        F.sha2(number.cast("string"), 256).alias("text"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_split_against_a_ranked_side(spark, skew_settings, hot_rows, how):
    few = latest_row_peers(
        spark.range(4_000).selectExpr("id AS key", "DATE'2000-01-01' AS effdt", "id AS other"),
        ["key"], "effdt",
    )
    matched = hot_rows.filter("key < 4000").count()
    count, plan = final_plan(spread_join(hot_rows, few, "key", how))
    assert count == (300_000 if how == "left" else matched)
    assert "skew=true" in plan


def test_a_hot_right_side_of_a_left_join_is_split(spark, skew_settings, hot_rows):
    base = spark.range(6_000).selectExpr("id AS key", "id AS other")
    count, plan = final_plan(left_join_spread(base, base.select("key"), hot_rows, "key"))
    assert count == 300_000 + 1_000
    assert "skew=true" in plan


def test_a_hot_key_is_ranked_before_the_shuffle(spark, hot_rows):
    same_date = hot_rows.withColumn("effdt", F.lit(dt.date(2000, 1, 1)))
    latest = latest_row_peers(same_date, ["key"], "effdt")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert "Final" in limits[0] and "Partial" in limits[-1]
    counts = latest.groupBy("alone").count().collect()
    assert [(r.alone, r["count"]) for r in counts] == [(False, 5_000)]


def test_copies_of_a_class_vanish_and_the_rest_stay(spark):
    """A third of the class rows are copies of one class, which then has no single latest row."""
    number, day = F.col("id"), F.lit(dt.date(1990, 1, 1))
    section = F.when(number % 3 == 0, -1).otherwise(number).cast("string")
    classes = spark.range(0, 60_000, 1, 8).select(
        F.lit("p").alias("emplid"), F.lit("19983").alias("strm"), section.alias("class_nbr"),
        *(F.lit("x").alias(c) for c in (
            "subject", "acad_career", "crse_career", "crse_id", "crse_code", "class_section",
            "crse_grade_off", "repeat_code",
        )),
        F.lit(3).alias("unt_billing"),
    )
    catalog = spark.range(2).select(
        *(F.lit("x").alias(c) for c in ("crse_id", "subject", "crse_code")),
        F.date_add(day, number.cast("int")).alias("crse_effdt"),
        *(F.lit("d").alias(c) for c in (
            "crse_effdt_end", "crse_eff_status", "course_title_long", "acad_org_mau",
            "acad_org_mau_descrformal", "acad_org_u1", "acad_org_u1_descrformal",
        )),
    )
    calendar = spark.createDataFrame(
        [
            ("I", "x", "19983", dt.date(1998, 7, 1), dt.date(1998, 9, 30)),
            ("I", "x", "19984", dt.date(1998, 10, 1), dt.date(1998, 12, 31)),
        ],
        "institution STRING, acad_career STRING, strm STRING, term_begin_dt DATE, term_end_dt DATE",
    )
    schedule = classes.select(
        "strm", "class_nbr", "subject", "crse_code", "class_section",
        *(F.lit("1").alias(c) for c in (
            "section_id", "session_code", "location", "class_type", "class_type_xlatlongname",
        )),
        F.lit("A").alias("class_stat"),
    ).distinct()
    sessions = spark.createDataFrame(
        [("19983", "x", "1", dt.date(1998, 7, 1), dt.date(1998, 9, 1))],
        "strm STRING, acad_career STRING, session_code STRING, "
        "sess_begin_dt DATE, sess_end_dt DATE",
    )
    found = enrollment.course_enrollment(
        classes, catalog, calendar, schedule, sessions, F.lit("19983")
    )
    kept = found.agg(
        F.count(F.lit(1)), F.count_distinct("class_nbr"), F.min("crse_effdt"), F.max("cnt")
    )
    assert tuple(kept.first()) == (40_000, 40_000, dt.date(1990, 1, 2), 1)
