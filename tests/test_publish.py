"""Type mapping, replace and append."""

import datetime as dt

import pytest
from pyspark.errors import ParseException, PySparkException

from campuslake.sinks.publish import (
    JdbcSink,
    PathSink,
    TableSink,
    append,
    replace,
    sink_columns,
    typed,
)
from campuslake.sources.warehouse import jdbc_options


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [("a", 1, 2.5, dt.date(2000, 1, 1), True), (None, None, None, None, None)],
        "text STRING, number LONG, share DOUBLE, day DATE, flag BOOLEAN",
    )


def test_types_follow_the_column_kinds(frame):
    assert sink_columns(frame.schema) == {
        "text": "VARCHAR(255)", "number": "INT", "share": "DOUBLE", "day": "TIMESTAMP_NTZ",
    }


def test_typed_keeps_values(frame):
    found = typed(frame)
    assert found.dtypes == [
        ("text", "string"), ("number", "int"), ("share", "double"), ("day", "timestamp_ntz"),
        ("flag", "boolean"),
    ]
    assert found.collect()[0] == ("a", 1, 2.5, dt.datetime(2000, 1, 1), True)
    assert found.collect()[1] == (None,) * 5


@pytest.fixture(params=["path", "table"])
def sink(request, spark, tmp_path):
    if request.param == "path":
        yield PathSink(f"{tmp_path}/out")
    else:
        yield TableSink("published")
        spark.sql("DROP TABLE IF EXISTS published")


def content(spark, sink):
    return spark.read.parquet(sink.path) if isinstance(sink, PathSink) else spark.table(sink.name)


def test_append_doubles_and_replace_does_not(spark, frame, sink):
    append(frame, sink)
    append(frame, sink)
    assert content(spark, sink).count() == 4
    replace(frame, sink)
    replace(frame, sink)
    assert content(spark, sink).count() == 2


def test_a_frame_read_from_the_sink_can_replace_it(spark, frame, sink):
    append(frame, sink)
    replace(content(spark, sink).filter("number = 1"), sink)
    spark.catalog.clearCache()
    assert [r.text for r in content(spark, sink).collect()] == ["a"]


@pytest.mark.parametrize(
    ("value", "message"), [(("x" * 256, 1), "longer than 255"), (("x", 2**31), "INT range")]
)
@pytest.mark.parametrize("publish", [replace, append])
def test_a_value_that_does_not_fit_leaves_the_sink_alone(spark, sink, publish, value, message):
    good = spark.createDataFrame([("x" * 255, 2**31 - 1)], "text STRING, number LONG")
    replace(good, sink)
    bad = spark.createDataFrame([value], "text STRING, number LONG")
    with pytest.raises(PySparkException, match=message):
        publish(bad, sink)
    assert content(spark, sink).collect() == good.collect()


def test_jdbc_options(frame):
    sink = JdbcSink("jdbc:x", "dbo.daily", 16, {"user": "u"})
    assert sink.writer_options(frame.schema) == {
        "batchsize": "10000",
        "createTableColumnTypes": "`number` INT, `share` DOUBLE, `day` TIMESTAMP_NTZ",
        "user": "u", "numPartitions": "16", "url": "jdbc:x", "dbtable": "dbo.daily",
    }
    chosen = JdbcSink("jdbc:x", "dbo.daily", 16, text="VARCHAR(255)").writer_options(frame.schema)
    assert chosen["createTableColumnTypes"].startswith("`text` VARCHAR(255), `number` INT")


def test_jdbc_reads_of_growing_relations_name_their_split():
    split = {"partitionColumn": "emplid", "lowerBound": "0", "upperBound": "9", "numPartitions": "9"}
    found = jdbc_options("jdbc:x", "s", "p_names_av", None, {"p_names_av": split})
    assert split.items() <= found.items()
    assert "numPartitions" not in jdbc_options("jdbc:x", "s", "r_term_rv")
    with pytest.raises(ValueError, match="p_names_av: give its partitioning"):
        jdbc_options("jdbc:x", "s", "p_names_av")


def test_unknown_column_types_are_refused_before_the_table_is_touched(frame):
    sink = JdbcSink("jdbc:x", "t", 1, {"createTableColumnTypes": "`text` NVARCHAR(255)"})
    with pytest.raises(ParseException):
        sink.write(frame, "overwrite")
