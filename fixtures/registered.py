"""The registered queries: every operation and operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslake import TermQueries, configure
from campuslake.functions.expressions import display_name, may_enroll
from campuslake.operators.effective import (
    as_of_max,
    current_active,
    earliest_row,
    latest_or_absent,
    latest_row,
    latest_row_strict,
    version_at,
    version_intervals,
)
from campuslake.operators.relational import (
    distinct_pair_count,
    given_back,
    group_max_known_keys,
    left_join_spread,
    pivot_count_total,
    spread_join,
)
from campuslake.operators.running import as_of_join, running_count
from campuslake.plans import enrollment, people, snapshot, terms
from campuslake.session import shared_folder
from campuslake.sinks.bulk import batch_of, bulk_insert
from campuslake.sinks.publish import PathSink, append, replace, typed
from campuslake.sinks.versions import VersionedSink
from campuslake.sources.splits import cuts, predicates
from fixtures.parameters import (
    CAREERS,
    GENDER,
    NEXT_DAY,
    ON,
    PROFILE_AS_OF,
    SPLIT_KEY,
    SPLITS,
    TERM,
    TRIBE,
)
from fixtures.relations import warehouse
from fixtures.target import FolderTarget

Query = Callable[[SparkSession, str], DataFrame]

COURSE = enrollment.COURSE


def bound(spark: SparkSession, folder: str, as_of: date = ON) -> TermQueries:
    return TermQueries.with_select_term(warehouse(configure(spark), folder), TERM, as_of)


def in_session(spark: SparkSession, folder: str, as_of: date = ON) -> TermQueries:
    return TermQueries.with_current_term(warehouse(configure(spark), folder), as_of)


def headcount(spark: SparkSession, folder: str, on: date = ON) -> DataFrame:
    return bound(spark, folder).enrollment_snapshot_agg(on)


def profile(spark: SparkSession, folder: str) -> DataFrame:
    return bound(spark, folder, PROFILE_AS_OF).bio_demographics(GENDER, TRIBE)


def home_set(spark: SparkSession, folder: str) -> DataFrame:
    race = bound(spark, folder).race_detail()
    return race.filter((F.col("hisp_latino") == "N") & (F.col("setid") == "USA"))


def relation_query(plan: Callable[..., DataFrame], *relations: str) -> Query:
    """A query that hands the named relations to a plan."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        source = warehouse(configure(spark), folder)
        return plan(*(source[name] for name in relations))

    return run


def as_of_lookup(careers: DataFrame, residencies: DataFrame) -> DataFrame:
    key = snapshot.CAREER_KEY
    students = careers.filter(F.col("strm") == TERM).select(*key, "strm")
    reached = as_of_max(residencies, key, "effective_term", F.lit(TERM))
    return spread_join(students, reached, key, "left")


def names_or_absent(personal: DataFrame, names: DataFrame) -> DataFrame:
    persons = personal.select("emplid").distinct()
    legal = people.names_of_type(current_active(names), people.LEGAL, "legal")
    return latest_or_absent(persons, persons, legal, "emplid", "name_effdt", PROFILE_AS_OF)


def levels_by_date(student_term: DataFrame, translations: DataFrame) -> DataFrame:
    levels = enrollment.level_descriptions(translations, ON)
    students = student_term.select("emplid", "acad_career", "acad_level_bot")
    return spread_join(students, levels, "acad_level_bot", "left")


def attributes_by_person(persons: DataFrame, attributes: DataFrame) -> DataFrame:
    roster = persons.select("emplid").distinct()
    picked = persons.select("emplid")
    for name, alias in ((GENDER, "gender_pref"), (TRIBE, "tribal_affiliation")):
        values = people.attribute(attributes, name, alias).drop("attribute_effdt")
        picked = left_join_spread(picked, roster, values, "emplid")
    return picked


def publish_folder(spark: SparkSession) -> PathSink:
    return PathSink(f"{shared_folder(configure(spark))}/published-{uuid.uuid4().hex}")


def sink_replace(spark: SparkSession, folder: str) -> DataFrame:
    sink = publish_folder(spark)
    for on in (ON, NEXT_DAY):
        replace(headcount(spark, folder, on), sink)
    return spark.read.parquet(sink.path)


def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    sink = publish_folder(spark)
    for on in (ON, NEXT_DAY):
        append(headcount(spark, folder, on), sink)
    return spark.read.parquet(sink.path)


def sink_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A version is added, replaced and added to again; what stands then."""
    sink = VersionedSink(publish_folder(spark).path)
    append(headcount(spark, folder, ON), sink)
    replace(headcount(spark, folder, NEXT_DAY), sink)
    append(headcount(spark, folder, ON), sink)
    return sink.read(spark)


def sink_bulk_insert(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily batches, the first sent twice."""
    target = FolderTarget(publish_folder(spark).path)
    for on in (ON, ON, NEXT_DAY):
        bulk_insert(headcount(spark, folder, on), target, batch_of(on, "headcount"), 2)
    return target.read(spark, typed(headcount(spark, folder)).schema)


def split_read(names: DataFrame) -> DataFrame:
    """How many rows each part of a split read by a text key takes, and its keys."""
    spark, view = names.sparkSession, f"split_{uuid.uuid4().hex}"
    names.createOrReplaceTempView(view)
    found = None
    for number, condition in enumerate(predicates(SPLIT_KEY, cuts(names, SPLIT_KEY, SPLITS))):
        part = spark.table(view).filter(condition).agg(
            F.lit(number).alias("part"), F.count(F.lit(1)).alias("rows"),
            F.min(SPLIT_KEY).alias("first_key"), F.max(SPLIT_KEY).alias("last_key"),
        )
        found = part if found is None else found.union(part)
    return found


REGISTERED: dict[str, Query] = {
    "current_term": lambda s, d: bound(s, d).current_term(),
    "term_enrollment": lambda s, d: bound(s, d).term_enrollment(),
    "course_enrollment": lambda s, d: bound(s, d).course_enrollment(),
    "enrollment_schedule": lambda s, d: bound(s, d).enrollment_schedule(),
    "race_detail": lambda s, d: bound(s, d).race_detail(),
    "race_ethnicity_category": lambda s, d: bound(s, d).race_ethnicity_category(),
    "bio_demographics": profile,
    "enrollment_snapshot_base": lambda s, d: bound(s, d).enrollment_snapshot_base(ON),
    "enrollment_snapshot_agg": headcount,
    "current_term_race": lambda s, d: in_session(s, d).race_detail(),
    "current_term_headcount": lambda s, d: in_session(s, d).enrollment_snapshot_agg(ON),
    "sink_type_mapping": lambda s, d: typed(configure(s).read.parquet(f"{d}/orders.parquet")),
    "sink_replace": sink_replace,
    "sink_append": sink_append,
    "next_term_begin": relation_query(terms.next_term_begin, "r_term_rv"),
    "current_active": relation_query(
        lambda names: current_active(names).select(
            "emplid", "name_type", "effdt", "last_name", "first_name", "middle_name"
        ),
        "p_names_av",
    ),
    "filter_in_list": relation_query(
        lambda students: enrollment.enrolled_in_term(students, F.lit(TERM)).select(
            "emplid", "strm", "acad_career", "enrollment_status"
        ),
        "r_studentterm_rv",
    ),
    "version_at_date": relation_query(
        lambda classes: version_at(classes, ON).select(
            "emplid", "strm", "class_nbr", "unt_taken", "edw_eff_start_date", "edw_eff_end_date"
        ),
        "p_stdnt_enrl_av",
    ),
    "three_valued_or": relation_query(
        lambda careers: careers.filter(
            may_enroll(F.col("elig_to_enroll"), F.col("withdraw_code"))
        ).select("emplid", "strm", "acad_career", "elig_to_enroll", "withdraw_code"),
        "p_stdnt_car_term_av",
    ),
    "as_of_lookup": relation_query(as_of_lookup, "p_stdnt_car_term_av", "p_residency_off_av"),
    "latest_row": relation_query(
        lambda personal: latest_row(
            current_active(personal).select("emplid", "effdt", "sex"), ["emplid"], "effdt", ["sex"]
        ),
        "p_pers_data_effdt_av",
    ),
    "latest_row_strict": relation_query(
        lambda catalog: latest_row_strict(
            catalog.select(*COURSE, "crse_effdt", "course_title_long"), COURSE, "crse_effdt"
        ),
        "r_coursecatalog_rv",
    ),
    "earliest_row": relation_query(
        lambda catalog: earliest_row(
            catalog.select(*COURSE, "crse_effdt", "course_title_long"),
            COURSE,
            "crse_effdt",
            ["course_title_long"],
        ),
        "r_coursecatalog_rv",
    ),
    "latest_or_absent": relation_query(names_or_absent, "p_pers_data_effdt_av", "p_names_av"),
    "left_join_on_predicate": relation_query(levels_by_date, "r_studentterm_rv", "t_xlatitem_v"),
    "official_residency": relation_query(
        people.official_residency, "p_residency_off_av", "p_residency_off_v"
    ),
    "semi_join_in": relation_query(
        lambda personal, careers: spread_join(
            current_active(personal).select("emplid", "effdt", "sex"),
            people.enrolled_persons(careers, F.lit(TERM)),
            "emplid",
            "left_semi",
        ),
        "p_pers_data_effdt_av",
        "p_stdnt_car_term_av",
    ),
    "eav_pick": relation_query(attributes_by_person, "p_person_av", "p_scc_caf_persbio_av"),
    "group_sum": relation_query(
        lambda classes: snapshot.enrolled_credits(classes, F.lit(TERM), ON), "p_stdnt_enrl_av"
    ),
    "group_max_nonnull_keys": lambda s, d: group_max_known_keys(
        bound(s, d).race_detail(),
        ["emplid", "citizenship_descrshort"],
        ["hisp_latino", "ethnic_group"],
    ),
    "distinct_pair_count": lambda s, d: distinct_pair_count(
        home_set(s, d), "emplid", "ethnic_group", "recnt"
    ),
    "distinct_rows": lambda s, d: home_set(s, d).select("emplid", "xlatlongname").distinct(),
    "case_cascade": lambda s, d: bound(s, d)
    .race_ethnicity_category()
    .select("emplid", "ipeds_race_ethnicity"),
    "partition_min_sum": lambda s, d: bound(s, d)
    .enrollment_snapshot_base(ON)
    .select("emplid", "strm", "acad_career", "residency", "tuition_res", "fanummin", "billcnt"),
    "primary_career_flag": lambda s, d: bound(s, d)
    .enrollment_snapshot_base(ON)
    .select("emplid", "acad_career", "billing_career", "bill", "primary"),
    "pivot_count_total": relation_query(
        lambda careers: pivot_count_total(careers, "strm", "acad_career", CAREERS),
        "p_stdnt_car_term_av",
    ),
    "running_count": relation_query(
        lambda names: running_count(
            names.select("emplid", "name_type", "effdt"), ["emplid", "name_type"], "effdt"
        ),
        "p_names_av",
    ),
    "as_of_join": relation_query(
        lambda careers, residencies: as_of_join(
            careers.select(*snapshot.CAREER_KEY, "strm"),
            residencies, snapshot.CAREER_KEY, "strm", "effective_term",
        ),
        "p_stdnt_car_term_av",
        "p_residency_off_av",
    ),
    "version_intervals": relation_query(
        lambda catalog: version_intervals(
            catalog.select(*COURSE, "crse_effdt"), COURSE, "crse_effdt", "until"
        ),
        "r_coursecatalog_rv",
    ),
    "aggregate_given_back": relation_query(
        lambda classes: given_back(
            classes.select("emplid", "strm", "class_nbr", "unt_taken"), ["strm"],
            least=F.min("unt_taken"), units=F.sum("unt_taken"),
        ),
        "p_stdnt_enrl_av",
    ),
    "split_read": relation_query(split_read, "p_names_av"),
    "sink_versions": sink_versions,
    "sink_bulk_insert": sink_bulk_insert,
    "name_concat": relation_query(
        lambda names: names.select(
            "emplid",
            "effdt",
            display_name(F.col("last_name"), F.col("first_name"), F.col("middle_name")).alias(
                "university_name"
            ),
        ),
        "p_names_av",
    ),
}
