"""Bulk insert: repeated tasks and calls insert once; the statements of the SQL target."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException

from campuslake.sinks.bulk import SqlTarget, _Writer, bulk_insert
from fixtures.target import FolderTarget

SCHEMA = "text STRING, number INT, day TIMESTAMP_NTZ"

# A task that fails after its rows are staged; the session retries tasks, as a cluster does.
RETRIED = """
import os, sys
sys.path[:0] = [{repo!r}, {repo!r} + "/tests"]
from pyspark import TaskContext
from pyspark.sql import SparkSession
from campuslake.sinks.bulk import bulk_insert
from fixtures.target import FolderTarget

class Failing(FolderTarget):
    def stage(self, batch, attempt, columns, chunks):
        rows = super().stage(batch, attempt, columns, chunks)
        task = TaskContext.get()
        if task.partitionId() % 2 == 0 and task.attemptNumber() < 2:
            raise RuntimeError("lost after its insert")
        return rows

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r} + "/shared").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
target = Failing({folder!r} + "/target")
df = spark.range(0, 1000, 1, 4).selectExpr("id", "cast(id as string) text")
assert bulk_insert(df, target, "first", 4) and not bulk_insert(df, target, "first", 4)
assert target.staged_attempts > 3, target.staged_attempts
print("ROWS", target.read(spark).count(), target.read(spark).distinct().count(), target.leftovers())
"""


def test_a_task_that_fails_after_its_insert_is_counted_once(tmp_path):
    repo = __file__.rsplit("/tests/", 1)[0]
    script = RETRIED.format(repo=repo, folder=str(tmp_path))
    found = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "ROWS 1000 1000 []" in found.stdout, found.stderr[-3000:]


def test_a_folder_named_by_its_file_address(spark, tmp_path, monkeypatch):
    """The shared folder may be an address: tasks and the commit work in folders of their own."""
    monkeypatch.chdir(tmp_path)
    target = FolderTarget(f"file://{tmp_path}/a%20b")
    assert bulk_insert(spark.range(3).selectExpr("'x' text", "cast(id as int) number"), target, "one", 2)
    assert (tmp_path / "a b" / "ledger" / "one").exists() and not (tmp_path / "file:").exists()
    assert target.read(spark, "text STRING, number INT").count() == 3
    with pytest.raises(ValueError, match="file: address"):
        FolderTarget("hdfs://host/folder")


def test_batches_replace_and_values_that_do_not_fit(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    frame = spark.createDataFrame([("a", 1, dt.date(2000, 1, 1)), (None, None, None)], "text STRING, number LONG, day DATE")
    for batch in ("one", "one", "two"):
        bulk_insert(frame, target, batch, 2)
    assert target.read(spark, SCHEMA).count() == 4
    found = target.read(spark, SCHEMA)
    assert found.where("day = '2000-01-01'").select("text", "number").collect() == [("a", 1)] * 2
    bad = spark.createDataFrame([("x" * 256, 1, None)], frame.schema)
    with pytest.raises(PySparkException, match="longer than 255"):
        bulk_insert(bad, target, "three", 2, replace=True)
    assert target.read(spark, SCHEMA).count() == 4 and not target.published("three")
    assert bulk_insert(frame.limit(1), target, "four", 2, replace=True)
    assert [r.text for r in target.read(spark, SCHEMA).collect()] == ["a"]
    assert bulk_insert(frame.where("false"), target, "five", 2)
    assert target.read(spark, SCHEMA).count() == 1 and target.leftovers() == []
    with pytest.raises(ValueError, match="name the batch"):
        bulk_insert(frame, target, "a b", 2)


def test_a_run_that_died_is_not_read(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    target.stage("one", "0-dead", ["id"], iter([[(7,)]]))
    assert bulk_insert(spark.range(3), target, "one", 1)
    assert sorted(r.id for r in target.read(spark, "id INT").collect()) == [0, 1, 2]


def test_an_aborted_batch_leaves_nothing(tmp_path):
    target = FolderTarget(str(tmp_path))
    target.stage("one", "0-x", ["id"], iter([[(7,)]]))
    _Writer(target, "one", ["id"], False).abort([None])
    assert target.leftovers() == [] and not target.published("one")


class Recorder:
    """A connection that records what it is asked to do."""

    def __init__(self):
        self.log, self.open = [], 0

    def __call__(self):
        self.open += 1
        return self

    def cursor(self):
        return self

    def execute(self, statement, values):
        self.log.append((statement, list(values)))

    def executemany(self, statement, rows):
        self.log.append((statement, rows))

    def fetchall(self):
        return []

    def commit(self):
        self.log.append("commit")

    def close(self):
        self.open -= 1


def test_statements_of_the_sql_target(spark):
    record = Recorder()
    target = SqlTarget(record, "daily", "%s")
    assert not target.published("b1")
    assert target.stage("b1", "0-x", ["c", "n"], iter([[("U", 1), ("G", 2)], [("P", 3)]])) == 3
    target.publish("b1", ["0-x", "1-y"], ["c", "n"], replace=True)
    target.discard("b1")
    fill = "INSERT INTO daily (c, n) SELECT c, n FROM daily_staged WHERE batch_id = %s AND attempt_id = %s"
    insert = "INSERT INTO daily_staged (batch_id, attempt_id, c, n) VALUES (%s, %s, %s, %s)"
    assert record.log == [
        ("SELECT batch_id FROM daily_batches WHERE batch_id = %s", ["b1"]), "commit",
        (insert, [("b1", "0-x", "U", 1), ("b1", "0-x", "G", 2)]), (insert, [("b1", "0-x", "P", 3)]), "commit",
        ("INSERT INTO daily_batches (batch_id) VALUES (%s)", ["b1"]), ("DELETE FROM daily", []),
        (fill, ["b1", "0-x"]), (fill, ["b1", "1-y"]), "commit",
        ("DELETE FROM daily_staged WHERE batch_id = %s", ["b1"]), "commit",
    ]
    assert record.open == 0
    schema = spark.createDataFrame([], "c STRING, n INT, d DOUBLE").schema
    assert target.definitions(schema) == [
        "CREATE TABLE daily_staged (batch_id VARCHAR(64), attempt_id VARCHAR(64), c VARCHAR(255), n INT, d DOUBLE)",
        "CREATE TABLE daily_batches (batch_id VARCHAR(64) PRIMARY KEY)",
    ]
