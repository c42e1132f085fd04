"""The operations on a warehouse stored as Parquet, its term facts partitioned by term."""

import pytest

from campuslake import TermQueries, Warehouse
from campuslake.sources.relations import SCHEMAS
from fixtures.parameters import GENDER, ON, PROFILE_AS_OF, TERM, TRIBE
from fixtures.relations import warehouse

BY_TERM = {
    "r_studentterm_rv", "r_studentclass_rv", "r_classschedule_rv", "p_stdnt_car_term_av",
    "p_stdnt_enrl_av",
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    derived = warehouse(spark, "/root/testdata/sf0.001")
    for name in SCHEMAS:
        writer = derived[name].write
        writer = writer.partitionBy("strm") if name in BY_TERM else writer
        writer.parquet(f"{folder}/{name}")
    return derived, Warehouse.from_parquet(spark, str(folder))


@pytest.mark.parametrize(
    ("as_of", "run"),
    [
        (ON, lambda q: q.enrollment_schedule()),
        (ON, lambda q: q.race_ethnicity_category()),
        (ON, lambda q: q.enrollment_snapshot_agg(ON)),
        (PROFILE_AS_OF, lambda q: q.bio_demographics(GENDER, TRIBE)),
    ],
)
def test_same_results(stored, as_of, run):
    results = [
        sorted(run(TermQueries.with_select_term(source, TERM, as_of)).collect(), key=repr)
        for source in stored
    ]
    assert results[0] == results[1] and results[0]


def test_the_current_term_prunes_partitions(stored):
    current = TermQueries.with_current_term(stored[1], ON).term_enrollment()
    plan = current._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    scan = next(line for line in scans if "enrollment_status" in line)
    assert "PartitionFilters: [" in scan and "ubquery" in scan
