"""Running aggregates, as-of joins and given-back aggregates, also with a key of a third of all rows."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_relational import final_plan, hot_rows, skew_settings  # noqa: F401

from campuslake.operators import running as module
from campuslake.operators.effective import in_force_on, version_intervals
from campuslake.operators.relational import given_back
from campuslake.operators.running import as_of_join, running, running_count


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def some_date(rng):
    return rng.choice([None, *(dt.date(2000, 1, 1) + dt.timedelta(days=k) for k in range(40))])


@pytest.mark.parametrize("seed", range(3))
def test_running_count_is_the_window(spark, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", None]
    data = [(rng.choice(keys), rng.choice([1, None]), some_date(rng), n) for n in range(400)]
    df = spark.createDataFrame(data, "k STRING, j INT, d DATE, n INT").repartition(5)
    df.createOrReplaceTempView("counted")
    wanted = spark.sql(
        "SELECT k, j, d, n, count(*) OVER (PARTITION BY k, j ORDER BY d DESC NULLS FIRST) AS cnt FROM counted"
    )
    assert rows(running_count(df, ["k", "j"], "d")) == rows(wanted)
    assert max(r.cnt for r in wanted.collect()) > 50
    assert rows(running_count(df.filter("false"), ["k", "j"], "d")) == []


def test_a_running_sum_skips_unknown_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 2)], "k STRING, t INT, v LONG")
    assert rows(running(df, ["k"], [F.col("t")], "v", F.sum, "s"), "t", "s") == [(1, None), (2, 5), (3, 5), (4, 7)]


@pytest.mark.parametrize("seed", range(3))
def test_as_of_join_takes_the_last_value_reached(spark, seed):
    rng = random.Random(seed)
    keys, times = ["hot"] * 4 + ["a", "b", "c", None], [None, *(f"{t:03d}" for t in range(60))]
    left = [(rng.choice(keys), rng.choice(times), n) for n in range(300)]
    right = [(rng.choice(keys[:-2]), rng.choice(times)) for _ in range(200)]
    reached = {}
    for key, time in right:
        if key is not None and time is not None:
            reached.setdefault(key, []).append(time)
    wanted = []
    for key, bound, n in left:
        own = sorted(reached.get(key, []))
        at = bisect.bisect_right(own, bound) if bound is not None and key is not None else 0
        wanted.append((key, bound, n, own[at - 1] if at else None))
    found = as_of_join(
        spark.createDataFrame(left, "k STRING, bound STRING, n INT"),
        spark.createDataFrame(right, "k STRING, effective STRING"),
        ["k"], "bound", "effective",
    )
    assert rows(found) == sorted(wanted, key=repr)


def test_a_hot_keys_rows_are_spread_over_ranges(spark, monkeypatch):
    """A third of the rows under one key: no range holds more than twice the median."""
    placed = []

    def seen(df):
        placed.append(kept(df))
        return placed[-1]

    kept = module.materialized
    monkeypatch.setattr(module, "materialized", seen)
    number = F.col("id")
    hot = F.when(number % 3 == 0, -1).otherwise(number % 500)
    df = spark.range(0, 60_000, 1, 8).select(hot.alias("key"), number.alias("time"))
    found = running(df.withColumn("one", F.lit(1)), ["key"], [F.col("time")], "one", F.sum, "n")
    most = found.groupBy("key").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("rows"))
    assert most.filter("most <> rows").count() == 0
    sizes = sorted(r["count"] for r in placed[0].groupBy("_range").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert placed[0].filter("key = -1").select("_range").distinct().count() > 2


def test_more_rows_make_more_ranges_and_tasks(spark, monkeypatch):
    """No range, and no task of the windows, holds much more than ROWS_TOGETHER rows."""
    placed = []

    def seen(df):
        placed.append(written(df))
        return placed[-1]

    written = module.materialized
    monkeypatch.setattr(module, "materialized", seen)
    monkeypatch.setattr(module, "ROWS_TOGETHER", 1000)
    df = spark.range(0, 30_000, 1, 4).select((F.col("id") % 3).alias("key"), F.col("id").alias("time"), F.lit(1).alias("one"))
    found = running(df, ["key"], [F.col("time")], "one", F.sum, "n")
    assert found.filter("n <> time div 3 + 1").count() == 0
    sizes = [r["count"] for r in placed[0].groupBy("_range").count().collect()]
    assert len(sizes) == 30 and max(sizes) <= 2000
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


def test_given_back_is_the_window_but_for_unknown_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None), (None, 7)], "k STRING, v INT")
    found = given_back(df, ["k"], low=F.min("v"), total=F.sum("v"))
    assert rows(found) == [("a", 1, 1, 4), ("a", 3, 1, 4), ("b", None, None, None), (None, 7, None, None)]


def test_a_hot_key_given_back_is_split(spark, skew_settings, hot_rows):  # noqa: F811
    found = given_back(hot_rows, ["key"], least=F.min("value"), rows=F.count(F.lit(1)))
    count, plan = final_plan(found)
    assert count == 300_000 and "skew=true" in plan and "Window" not in plan


def test_intervals_are_closed_and_tell_shared_dates(spark):
    days = [dt.date(2000, 1, 1), dt.date(2000, 2, 1), dt.date(2000, 2, 1), dt.date(2000, 3, 1), None]
    df = spark.createDataFrame([("a", d) for d in days] + [("b", days[1])], "k STRING, effdt DATE")
    found = version_intervals(df, ["k"], "effdt", "until")
    assert rows(found, "k", "effdt", "until", "alone") == [
        ("a", days[0], dt.date(2000, 1, 31), True), ("a", days[1], dt.date(2000, 2, 29), False),
        ("a", days[3], None, True), ("b", days[1], None, True),
    ]
    for day, held in ((dt.date(1999, 1, 1), 0), (days[0], 1), (dt.date(2000, 1, 31), 1), (days[1], 2), (dt.date(2030, 1, 1), 2), (None, 0)):
        at = found.withColumn("day", F.lit(day).cast("date"))
        assert at.filter(in_force_on("day", "effdt", "until")).count() == held
