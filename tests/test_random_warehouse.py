"""Every operation against row-by-row SQL on random, badly behaved sources."""

import duckdb
import pytest

from campuslake import TermQueries, configure
from checker import check
from fixtures import expected as e
from fixtures.parameters import GENDER, ON, PROFILE_AS_OF, TERM, TRIBE, TUITION
from random_warehouse import frames

SCHEDULE = f"""WITH terms AS ({e.TERM_ENROLLMENT}), courses AS ({e.COURSE_ENROLLMENT})
{e.ENROLLMENT_SCHEDULE}"""

OPERATIONS = {
    "term_enrollment": (lambda q: q.term_enrollment(), e.TERM_ENROLLMENT),
    "course_enrollment": (lambda q: q.course_enrollment(), e.COURSE_ENROLLMENT),
    "enrollment_schedule": (lambda q: q.enrollment_schedule(), SCHEDULE),
    "race_detail": (lambda q: q.race_detail(), e.RACE_DETAIL),
    "race_ethnicity_category": (
        lambda q: q.race_ethnicity_category(),
        f"WITH race AS ({e.RACE_DETAIL}) {e.RACE_CATEGORY}",
    ),
    "enrollment_snapshot_base": (lambda q: q.enrollment_snapshot_base(ON), e.BASE),
    "enrollment_snapshot_agg": (
        lambda q: q.enrollment_snapshot_agg(ON, TUITION),
        f"WITH base AS ({e.BASE}) {e.snapshot_agg(ON)}",
    ),
}


@pytest.fixture(scope="module", params=[101, 104, 107, 111])
def sources(request, spark):
    con = duckdb.connect()
    return frames(configure(spark), con, request.param), con


@pytest.mark.parametrize("name", OPERATIONS)
def test_operation(sources, name):
    warehouse, con = sources
    run, sql = OPERATIONS[name]
    check(run(TermQueries.with_select_term(warehouse, TERM, ON)), con, sql)


def test_profile(sources):
    warehouse, con = sources
    queries = TermQueries.with_select_term(warehouse, TERM, PROFILE_AS_OF)
    sql = f"WITH home AS ({e.OFFICIAL_RESIDENCY}) {e.BIO_DEMOGRAPHICS}"
    check(queries.bio_demographics(GENDER, TRIBE), con, sql)
