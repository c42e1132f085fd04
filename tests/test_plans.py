"""What the plans read: scans counted in the plan that ran, over stored relations."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from campuslake import TermQueries, Warehouse, configure
from campuslake.plans import enrollment, people
from campuslake.session import shared_folder
from campuslake.sources.relations import SCHEMAS
from fixtures.parameters import GENDER, ON, PROFILE_AS_OF, TERM, TRIBE
from fixtures.relations import warehouse as derived


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    source = derived(spark, "/root/testdata/sf0.001")
    for name in SCHEMAS:
        source[name].write.parquet(f"{folder}/{name}")
    return Warehouse.from_parquet(configure(spark), folder)


def scans(df) -> dict[str, int]:
    """How often the plan that ran reads each relation; a reused shuffle is not read again."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 1000)  # whole paths
    counted = df.agg(F.sum(F.hash(*df.columns).cast("long")))
    counted.collect()
    names, skipped = [], None
    for line in counted._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is None or depth < skipped:  # below it stands a plan as it was before it ran
            skipped = depth if "== Initial Plan ==" in line else None
            names += re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*?/(\w+)[,\]]", line)
    return {n: names.count(n) for n in set(names)}


def test_courses_read_the_class_facts_once(stored):
    found = scans(TermQueries(stored, TERM, ON).course_enrollment())
    assert found["r_studentclass_rv"] == 1
    assert found["r_coursecatalog_rv"] == found["r_classschedule_rv"] == 1


def test_each_class_meets_its_own_section_once(stored):
    """No product of sections and careers: the section side has one row per section."""
    offers = enrollment.section_offers(stored["r_classschedule_rv"], F.lit(TERM))
    assert offers.count() == offers.select(*enrollment.SECTION).distinct().count()
    sessions = enrollment.career_sessions(stored["r_termsession_rv"], F.lit(TERM))
    assert sessions.count() == sessions.select("strm", "acad_career").distinct().count()


def test_a_section_of_several_codes_takes_the_careers_own_session(spark):
    """One code of two fits the career: that offer. Both fit: none. Two rows of one code: none."""
    day = dt.date(1998, 7, 1)
    keys = ("subject", "crse_code", "class_section")
    classes = spark.createDataFrame(
        [("p", TERM, nbr, *("x",) * 3, c, c, "x", 3, "g", "r") for nbr in ("one", "two") for c in ("U", "G")],
        "emplid STRING, strm STRING, class_nbr STRING, subject STRING, crse_code STRING, class_section STRING, "
        "acad_career STRING, crse_career STRING, crse_id STRING, unt_billing INT, crse_grade_off STRING, repeat_code STRING",
    )
    catalog = spark.createDataFrame([("x", "x", "x", day)], "crse_id STRING, subject STRING, crse_code STRING, crse_effdt DATE")
    for c in enrollment.COURSE_COLUMNS:
        if c not in [*catalog.columns, *classes.columns, *enrollment.SECTION] and ("acad_org" in c or c in ("crse_effdt_end", "crse_eff_status", "course_title_long")):
            catalog = catalog.withColumn(c, F.lit("d"))
    calendar = spark.createDataFrame(
        [("I", c, t, day, day) for c in "UG" for t in (TERM, "19984")],
        "institution STRING, acad_career STRING, strm STRING, term_begin_dt DATE, term_end_dt DATE",
    ).withColumn("term_begin_dt", F.when(F.col("strm") == TERM, F.col("term_begin_dt")).otherwise(F.date_add("term_begin_dt", 90)))
    schedule = spark.createDataFrame(
        [(TERM, "one", *("x",) * 3, "1", "A", "here"), (TERM, "one", *("x",) * 3, "2", "A", "there"),
         (TERM, "two", *("x",) * 3, "1", "A", "a"), (TERM, "two", *("x",) * 3, "1", "A", "b"), (TERM, "two", *("x",) * 3, None, "A", "c")],
        f"strm STRING, class_nbr STRING, {', '.join(k + ' STRING' for k in keys)}, session_code STRING, class_stat STRING, location STRING",
    ).selectExpr("*", "'s' section_id", "'t' class_type", "'l' class_type_xlatlongname")
    sessions = spark.createDataFrame(
        [(TERM, "U", "2", day, day), (TERM, "G", "1", day, day), (TERM, "G", "2", day, day)],
        "strm STRING, acad_career STRING, session_code STRING, sess_begin_dt DATE, sess_end_dt DATE",
    )
    found = enrollment.course_enrollment(classes, catalog, calendar, schedule, sessions, F.lit(TERM))
    assert [(r.class_nbr, r.acad_career, r.location, r.session_code) for r in found.collect()] == [("one", "U", "there", "2")]


def test_the_schedule_writes_nothing(stored, spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = TermQueries(stored, TERM, ON).enrollment_schedule()
    count = found.count()
    assert set(os.listdir(folder)) == before and count > 0


def test_profiles_read_each_history_twice_at_most(stored, monkeypatch):
    kept, seen = people.materialized, []

    def counting(df):
        seen.append(scans(df))
        return kept(df)

    monkeypatch.setattr(people, "materialized", counting)
    rest = scans(TermQueries(stored, TERM, PROFILE_AS_OF).bio_demographics(GENDER, TRIBE))
    total = {n: sum(s.get(n, 0) for s in [*seen, rest]) for n in SCHEMAS}
    for name in ("p_names_av", "p_scc_caf_persbio_av", "p_pers_data_effdt_av"):
        assert 1 <= total[name] <= 2, total
    assert total["p_stdnt_car_term_av"] == 1


def test_histories_are_cut_down_before_they_are_grouped(stored):
    source = [stored[n] for n in ("p_pers_data_effdt_av", "p_names_av", "p_scc_caf_persbio_av")]
    roster = people.enrolled_persons(stored["p_stdnt_car_term_av"], F.lit(TERM))
    dates = people.profile_dates(people.profile_rows(*source, roster, GENDER, TRIBE), PROFILE_AS_OF)
    plan = dates._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("LeftSemi")]
    assert above.count("Aggregate") == 1  # the one over dates; all scans lie below the semi join
    assert "Relation" not in above
