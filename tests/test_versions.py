"""Publishing by swap: what stood stands until the new rows do."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campuslake.session import CHECKPOINT_CONF, discard, materialized, scratch, shared_folder
from campuslake.sinks.publish import PathSink, TableSink, append, replace
from campuslake.sinks.versions import VersionedSink


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark):
    """Fails while it is written, after its first rows."""
    return spark.range(0, 1000, 1, 2).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id")).cast("int").alias("id")
    )


def test_versions_are_added_and_replaced(spark, tmp_path):
    sink = VersionedSink(f"{tmp_path}/out")
    with pytest.raises(FileNotFoundError):
        sink.read(spark)
    append(spark.range(2), sink)
    append(spark.range(1), sink)
    before = sink.read(spark)
    assert ids(before) == [0, 0, 1]
    replace(spark.range(5, 7), sink)
    assert ids(sink.read(spark)) == [5, 6]
    assert ids(before) == [0, 0, 1]  # a reader under way
    replace(sink.read(spark).filter("id = 5"), sink)
    assert ids(sink.read(spark)) == [5]
    assert len(os.listdir(tmp_path / "out" / "data")) == 2
    assert len([n for n in os.listdir(tmp_path / "out" / "versions") if n.startswith("pointer-")]) == 2


def test_of_two_writers_both_are_published(spark, tmp_path, monkeypatch):
    sink, other = VersionedSink(f"{tmp_path}/out"), VersionedSink(f"{tmp_path}/out")
    sink.write(spark.range(1), "append")
    point, raced = VersionedSink._point, []

    def overtaken(self, session, number, parts):
        if not raced:
            raced.append(number)
            other.write(spark.range(10, 11), "append")
        return point(self, session, number, parts)

    monkeypatch.setattr(VersionedSink, "_point", overtaken)
    sink.write(spark.range(20, 21), "append")
    assert ids(sink.read(spark)) == [0, 10, 20]


@pytest.mark.parametrize("kind", ["versions", "path", "table"])
def test_a_failing_write_leaves_the_old_rows(spark, tmp_path, kind):
    sink = {
        "versions": VersionedSink(f"{tmp_path}/out"), "path": PathSink(f"{tmp_path}/out"), "table": TableSink("swapped"),
    }[kind]
    read = {"versions": lambda: sink.read(spark), "path": lambda: spark.read.parquet(sink.path), "table": lambda: spark.table("swapped")}[kind]
    sink.write(spark.range(3), "overwrite")
    with pytest.raises(PySparkException, match="lost"):
        sink.write(failing(spark), "overwrite")
    spark.catalog.clearCache()
    assert ids(read()) == [0, 1, 2]
    sink.write(spark.range(4, 5), "overwrite")
    spark.catalog.clearCache()
    assert ids(read()) == [4]
    if kind == "table":
        spark.sql("DROP TABLE swapped")


def written(spark):
    return set(os.listdir(shared_folder(spark).removeprefix("file:")))


def test_frames_go_with_their_block(spark):
    before = written(spark)
    with scratch(spark) as keep:
        first = materialized(spark.range(3))
        with scratch(spark) as inner:
            lost = materialized(spark.range(1))
            held = inner(lost.union(first))
        assert ids(held) == [0, 0, 1, 2]
        assert len(written(spark) - before) == 2
        kept_one = keep(held.distinct())
    assert len(written(spark) - before) == 1 and ids(kept_one) == [0, 1, 2]
    discard(kept_one, kept_one, spark.range(1))
    assert written(spark) == before


def test_frames_of_a_failing_block_go(spark):
    before = written(spark)
    with pytest.raises(RuntimeError), scratch(spark):
        materialized(spark.range(3))
        raise RuntimeError
    assert written(spark) == before


def test_a_session_without_a_folder_is_told_so(spark):
    folder = spark.conf.get(CHECKPOINT_CONF)

    class Unnamed:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: None)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match=CHECKPOINT_CONF):
        shared_folder(Unnamed)
    assert shared_folder(spark) == folder
