"""Term enrollment, course enrollment and the two joined.

Both enrollments keep the latest row per student key only if nothing else shares
its date. A joined side whose match is not unique repeats a student's row at the
same date, so each side is reduced to one row per join key with its number of
rows, and a kept row must have matched one row everywhere. No product of matching
rows is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.functions.expressions import AsOf
from campuslake.operators.effective import (
    in_force_on,
    latest_row_peers,
    latest_row_strict,
    not_future,
    sole_row,
    version_intervals,
)
from campuslake.operators.relational import left_join_suffixed, spread_join
from campuslake.plans.terms import next_term_begin

# Fixed values
ENROLLED_STATUSES = ("C", "E", "W")
LEVEL_FIELD = "ACADEMIC_LEVEL"

TERM_COLUMNS = (
    "emplid strm term_descrshort acad_career degree_career enrollment_status "
    "residency admission_res tuition_res fin_aid_fed_res acad_level_bot "
    "tot_proj_units acad_level_bot_short_descr acad_level_bot_long_descr acad_plan "
    "acad_plan_descr acad_plan_u1 acad_plan_u1_descrformal acad_plan_mau "
    "acad_plan_mau_descrformal citizenship_status citizenship_descrshort sex "
    "ipeds_race_ethnicity res_country res_state res_county res_city cnt"
).split()

COURSE_COLUMNS = (
    "emplid strm class_nbr subject acad_career crse_career crse_code class_section "
    "asessed_credit crse_grade_off crse_effdt crse_effdt_end crse_eff_status "
    "repeat_code section_id course_title_long acad_org_mau acad_org_mau_descrformal "
    "acad_org_u1 acad_org_u1_descrformal session_code location class_type "
    "class_type_xlatlongname sess_begin_dt sess_end_dt cnt"
).split()

COURSE = ["crse_id", "subject", "crse_code"]
SECTION = ["strm", "class_nbr", "subject", "crse_code", "class_section"]


def enrolled_in_term(student_term: DataFrame, term: Column) -> DataFrame:
    return student_term.filter(
        F.col("enrollment_status").isin(*ENROLLED_STATUSES)
        & (F.col("primary_car_flag") == "Y")
        & (F.col("strm") == term)
    )


def level_descriptions(translations: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every description of an academic level that is not future-dated."""
    levels = translations.filter(F.col("fieldname") == LEVEL_FIELD)
    return not_future(levels, "effdt", as_of).select(
        F.col("fieldvalue").alias("acad_level_bot"),
        F.col("xlatshortname").alias("acad_level_bot_short_descr"),
        F.col("xlatlongname").alias("acad_level_bot_long_descr"),
        "effdt",
    )


def term_enrollment(
    student_term: DataFrame,
    biodemo: DataFrame,
    plans: DataFrame,
    translations: DataFrame,
    term: Column,
    as_of: AsOf = None,
) -> DataFrame:
    """Enrolled students of the term with plan, level description and home data."""
    plan_key, level_key = ["acad_plan", "institution"], ["acad_level_bot"]
    plan = latest_row_peers(plans, plan_key, "acad_plan", "plan_alone")
    level = latest_row_peers(
        level_descriptions(translations, as_of), level_key, "effdt", "level_alone"
    )
    planned = spread_join(enrolled_in_term(student_term, term), plan, plan_key)
    described = spread_join(planned, level, level_key, "left")
    latest = latest_row_strict(described, ["emplid", "acad_career", "institution"], "effdt")
    alone = F.col("plan_alone") & F.coalesce("level_alone", F.lit(True))
    # one row per student, career and institution is left: no student is heavy here
    return latest.filter(alone).join(sole_row(biodemo, ["emplid"]), "emplid").select(*TERM_COLUMNS)


def catalog_days(calendar: DataFrame, term: Column) -> DataFrame:
    """Per career, the last day a catalog version of the term may begin on.

    Institutions may end the term on several days: ``last_day`` is the latest, ``days``
    has one for each. A career's last known term has none, and no row.
    """
    ends = next_term_begin(calendar).filter(
        (F.col("strm") == term) & F.col("next_term_begin_dt1").isNotNull()
    )
    return ends.groupBy("acad_career").agg(
        F.max("next_term_begin_dt1").alias("last_day"),
        F.collect_list("next_term_begin_dt1").alias("days"),
    )


def section_offers(schedule: DataFrame, term: Column) -> DataFrame:
    """One row per active section of the term with ``offers``: for each session code its row,
    and how many rows it has. A section has no more offers than there are codes."""
    held = ["section_id", "location", "class_type", "class_type_xlatlongname"]
    active = schedule.filter((F.col("strm") == term) & (F.col("class_stat") == "A"))
    coded = active.dropna(subset=["session_code"]).groupBy(*SECTION, "session_code").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.struct(*held)).alias("held")
    )
    offer = F.struct("session_code", "rows", *(F.col(f"held.{c}").alias(c) for c in held))
    return coded.groupBy(*SECTION).agg(F.collect_list(offer).alias("offers"))


def career_sessions(sessions: DataFrame, term: Column) -> DataFrame:
    """One row per career of the term with its sessions by code: their days, and how many rows."""
    coded = (
        sessions.filter(F.col("strm") == term)
        .dropna(subset=["session_code"])
        .groupBy("strm", "acad_career", "session_code")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.struct("sess_begin_dt", "sess_end_dt")).alias("days"),
        )
    )
    entry = F.struct("session_code", F.struct("rows", "days.sess_begin_dt", "days.sess_end_dt"))
    entries = F.collect_list(entry)
    return coded.groupBy("strm", "acad_career").agg(F.map_from_entries(entries).alias("sessions"))


def course_enrollment(
    classes: DataFrame,
    catalog: DataFrame,
    calendar: DataFrame,
    schedule: DataFrame,
    sessions: DataFrame,
    term: Column,
) -> DataFrame:
    """Classes taken in the term with the catalog version in force and the schedule.

    The class facts are read once: each class meets the one version of its course that is in
    force on its career's last day, and its section's offers in its own career's sessions.
    """
    days = catalog_days(calendar, term)
    earliest, latest = (days.agg(f("last_day")).scalar() for f in (F.min, F.max))
    # versions in force on no career's last day go before the join
    versions = version_intervals(catalog, COURSE, "crse_effdt", "until", "version_alone").filter(
        (F.col("crse_effdt") <= latest) & F.coalesce(F.col("until") >= earliest, F.col("until").isNull())
    )
    taken = spread_join(classes.filter(F.col("strm") == term), days, "acad_career")
    described = spread_join(taken, versions, COURSE).filter(
        in_force_on("last_day", "crse_effdt", "until")
    )
    # the version counts once for every institution whose last day reaches it
    reached = F.size(F.filter("days", lambda d: d >= F.col("crse_effdt")))
    described = described.withColumn("sole", F.col("version_alone") & (reached == 1))
    # ranked before the section join: copies of a class shrink to two rows per task
    section = [*SECTION, "acad_career"]
    newest = latest_row_strict(described, ["emplid", *section], "crse_effdt").filter("sole")
    offered = spread_join(newest, section_offers(schedule, term), SECTION)
    placed = spread_join(offered, career_sessions(sessions, term), ["strm", "acad_career"])
    meets = F.filter("offers", lambda o: F.col("sessions")[o["session_code"]].isNotNull())
    placed = placed.withColumn("offers", meets)
    rows = F.aggregate(
        "offers", F.lit(0).cast("long"), lambda n, o: n + o["rows"] * F.col("sessions")[o["session_code"]]["rows"]
    )
    offer = F.col("offers")[0]
    session = F.col("sessions")[offer["session_code"]]
    return (
        placed.filter(rows == 1)
        .select("*", offer.alias("offer"), session.alias("session"))
        .select("*", "offer.*", "session.sess_begin_dt", "session.sess_end_dt")
        .withColumnRenamed("unt_billing", "asessed_credit")
        .select(*COURSE_COLUMNS)
    )


def enrollment_schedule(terms: DataFrame, courses: DataFrame) -> DataFrame:
    """Every term enrollment with its courses; shared column names end in ``_crs``."""
    return left_join_suffixed(terms, courses, ["emplid", "strm"], "_crs")
