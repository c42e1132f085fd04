"""Term binding and the source relations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from campuslake import TermQueries, Warehouse
from campuslake.plans.terms import current_term, next_term_begin
from campuslake.sources.relations import SCHEMAS
from campuslake.sources.warehouse import jdbc_options
from fixtures.parameters import ON, TERM
from fixtures.relations import warehouse

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.createDataFrame(
        [
            ("I0", "U", "19981", dt.date(1998, 1, 1), dt.date(1998, 3, 31)),
            ("I0", "U", "19982", dt.date(1998, 4, 1), dt.date(1998, 6, 30)),
            ("I0", "G", "19982", dt.date(1998, 3, 15), dt.date(1998, 6, 30)),
        ],
        "institution STRING, acad_career STRING, strm STRING, term_begin_dt DATE, term_end_dt DATE",
    )


@pytest.mark.parametrize(
    ("as_of", "term"),
    [
        (dt.date(1998, 3, 1), "19981"),
        (dt.date(1998, 3, 20), "19982"),
        (dt.date(1998, 6, 30), "19982"),
        (dt.datetime(1998, 6, 30, 9, 0), None),
        (dt.date(1999, 1, 1), None),
    ],
)
def test_current_term(calendar, as_of, term):
    assert current_term(calendar, as_of).first().term == term


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Chicago"])
def test_a_time_is_wall_clock_time_in_any_zone(spark, calendar, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert current_term(calendar, dt.datetime(1998, 6, 30)).first().term == "19982"
        assert current_term(calendar, dt.datetime(1998, 6, 30, 0, 0, 1)).first().term is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_last_known_term_has_no_successor(calendar):
    terms = next_term_begin(calendar).collect()
    found = {(r.acad_career, r.strm): r.next_term_begin_dt1 for r in terms}
    assert found == {
        ("U", "19981"): dt.date(1998, 3, 31), ("U", "19982"): None, ("G", "19982"): None,
    }


def test_the_current_term_binds_inside_the_plan(spark):
    source = warehouse(spark, FOLDER)
    current = TermQueries.with_current_term(source, ON)
    chosen = TermQueries.with_select_term(source, TERM, ON)
    assert current.current_term().first().term == TERM
    for run in (
        lambda q: q.enrollment_snapshot_agg(ON, ["NRES", "RES"]),
        lambda q: q.term_enrollment(),
        lambda q: q.race_ethnicity_category(),
    ):
        assert sorted(run(current).collect(), key=repr) == sorted(run(chosen).collect(), key=repr)


def test_no_term_in_session_is_an_error(spark):
    between = TermQueries.with_current_term(warehouse(spark, FOLDER), dt.date(2030, 1, 1))
    with pytest.raises(Exception, match="no term is in session"):
        between.term_enrollment().collect()


def test_a_term_must_be_chosen(spark):
    with pytest.raises(ValueError, match="choose a term"):
        TermQueries(warehouse(spark, FOLDER)).term_enrollment()


def test_the_last_term_has_no_courses(spark):
    last = TermQueries.with_select_term(warehouse(spark, FOLDER), "20013", ON)
    assert last.course_enrollment().count() == 0


def test_output_columns(spark):
    queries = TermQueries.with_select_term(warehouse(spark, FOLDER), TERM, ON)
    assert len(queries.term_enrollment().columns) == 29
    assert len(queries.course_enrollment().columns) == 27
    assert len(queries.race_detail().columns) == 8
    assert len(queries.race_ethnicity_category().columns) == 8
    assert len(queries.enrollment_snapshot_base(ON).columns) == 15
    schedule = queries.enrollment_schedule()
    assert len(schedule.columns) == 54
    assert {"acad_career_crs", "cnt_crs"} < set(schedule.columns)
    assert len(queries.bio_demographics("ATTR_GENDER", "ATTR_TRIBE").columns) == 16


def test_without_values_the_headcount_finds_its_columns(spark):
    queries = TermQueries.with_select_term(warehouse(spark, FOLDER), TERM, ON)
    found = queries.enrollment_snapshot_agg(ON)
    assert found.columns[0] == "acad_career" and found.columns[-2:] == ["ttl", "Date"]
    primary = queries.enrollment_snapshot_base(ON).filter("primary = 1").dropna(
        subset=["acad_career", "tuition_res"]
    )
    assert found.agg(F.sum("ttl")).first()[0] == primary.count()


def test_sources_read_alike(spark, tmp_path):
    derived = warehouse(spark, FOLDER)
    relation = "r_term_rv"
    extra = derived[relation].withColumn("unused", F.lit(1))
    renamed = extra.withColumnsRenamed({c: c.upper() for c in extra.columns})
    renamed.write.parquet(f"{tmp_path}/{relation}")
    renamed.write.mode("overwrite").saveAsTable(relation)
    wanted = sorted(derived[relation].collect())
    for source in (
        Warehouse.from_parquet(spark, str(tmp_path)),
        Warehouse.from_tables(spark, "default"),
        Warehouse.from_frames(spark, {relation: renamed}),
    ):
        assert source[relation].columns == SCHEMAS[relation].fieldNames()
        assert sorted(source[relation].collect()) == wanted
    spark.sql(f"DROP TABLE {relation}")


def test_a_term_prunes_partitions_and_stays_text(spark, tmp_path):
    facts = warehouse(spark, FOLDER)["p_stdnt_enrl_av"]
    facts.write.partitionBy("strm").parquet(f"{tmp_path}/p_stdnt_enrl_av")
    stored = Warehouse.from_parquet(spark, str(tmp_path))["p_stdnt_enrl_av"]
    chosen = stored.filter(F.col("strm") == F.lit(TERM))
    assert dict(chosen.dtypes)["strm"] == "string"
    plan = chosen._jdf.queryExecution().toString()
    scan = plan[plan.index("PartitionFilters: ["):]
    assert TERM in scan[: scan.index("]")]
    assert chosen.count() == facts.filter(F.col("strm") == TERM).count() > 0


def test_views_answer_parameterised_sql(spark):
    warehouse(spark, FOLDER).register_views()
    query = "SELECT count(*) AS n FROM r_studentterm_rv WHERE strm = :term"
    assert spark.sql(query, args={"term": TERM}).first().n > 0


def test_unknown_relation(spark):
    with pytest.raises(KeyError, match="nothing"):
        warehouse(spark, FOLDER)["nothing"]


def test_jdbc_reads_are_split_as_asked():
    options = jdbc_options(
        "jdbc:x", "edw", "p_names_av", {"user": "u"}, {"p_names_av": {"numPartitions": "64"}}
    )
    assert options == {
        "fetchsize": "10000", "user": "u", "numPartitions": "64", "url": "jdbc:x",
        "dbtable": "edw.p_names_av",
    }


def test_every_relation_is_declared():
    assert len(SCHEMAS) == 23
