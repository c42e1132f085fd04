"""Nothing is lost or left behind: unlisted codes, term codes as text, staged files."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campuslake import Warehouse
from campuslake.operators.relational import pivot_count_total
from campuslake.session import shared_folder
from campuslake.sinks.publish import PathSink, append, replace
from campuslake.sources.relations import SCHEMAS


def frame(spark, rows):
    return spark.createDataFrame(rows, "career string, code string")


ROWS = [("u", "RES"), ("u", "NRES"), ("u", "WUE"), ("g", "WUE"), ("g", "WUE"), (None, "RES"), ("u", None)]


def test_total_counts_every_code_found(spark):
    wide = pivot_count_total(frame(spark, ROWS), "career", "code")
    assert wide.columns == ["career", "NRES", "RES", "WUE", "ttl"]
    assert sorted(map(tuple, wide.collect())) == [("g", None, None, 2, 2), ("u", 1, 1, 1, 3)]


def test_unlisted_code_fails(spark):
    with pytest.raises(PySparkException, match="not listed"):
        pivot_count_total(frame(spark, ROWS), "career", "code", ["NRES", "RES"]).collect()


def test_odd_codes_and_no_rows(spark):
    odd = [("u", "a"), ("u", "A"), ("u", "b`c"), ("u", "d.e")]
    wide = pivot_count_total(frame(spark, odd), "career", "code")
    assert [tuple(r) for r in wide.collect()] == [("u", 1, 1, 1, 1, 4)]
    assert pivot_count_total(frame(spark, []), "career", "code").collect() == []
    assert pivot_count_total(frame(spark, []), "career", "code", ["RES"]).columns == ["career", "RES", "ttl"]


def test_code_named_like_a_column_is_refused(spark):
    with pytest.raises(ValueError, match="ttl"):
        pivot_count_total(frame(spark, [("u", "ttl")]), "career", "code")


def test_partition_names_keep_leading_zeros(spark, tmp_path):
    schema = SCHEMAS["r_term_rv"]
    row = {f.name: None for f in schema} | {"strm": "0998", "term_begin_dt": dt.date(1998, 1, 1)}
    terms = spark.createDataFrame([tuple(row[f.name] for f in schema)], schema)
    terms.write.partitionBy("strm").parquet(str(tmp_path / "r_term_rv"))
    found = Warehouse.from_parquet(spark, str(tmp_path))["r_term_rv"].where(F.col("strm") == "0998")
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(strm" in found._jdf.queryExecution().toString()


def test_a_lacking_column_is_named(spark):
    lacking = Warehouse.from_frames(spark, {"r_term_rv": spark.range(1)})
    with pytest.raises(ValueError, match="r_term_rv lacks"):
        lacking["r_term_rv"]


def test_staged_files_go(spark, tmp_path):
    sink, folder = PathSink(str(tmp_path / "out")), shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    replace(frame(spark, ROWS), sink)
    append(frame(spark, ROWS), sink)
    assert spark.read.parquet(sink.path).count() == 2 * len(ROWS)
    assert set(os.listdir(folder)) == before
