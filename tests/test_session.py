"""Settings of the session: what may go through the driver, and how much one task reads."""

import os
import time

from pyspark.sql import functions as F

from campuslake.session import ESTIMATED, MEASURED, SHUFFLES_GO, TOGETHER, configure, materialized


def fresh(spark, **settings):
    session = spark.newSession()
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_repeated_behind_a_small_file_are_not_broadcast(spark, tmp_path):
    """The estimate of such a side is its file's size; in memory it is many times that."""
    path = str(tmp_path / "people")
    spark.range(400_000).select(F.col("id").alias("k"), F.hash("id").alias("h")).write.parquet(path)
    session = configure(fresh(spark, **{ESTIMATED: "10m"}))
    people = session.read.parquet(path)
    held = people.select("k", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("n"))
    firsts = held.groupBy("k").agg(F.min("n").alias("n"))
    assert "BroadcastHashJoin" not in plan_of(held.join(firsts, ["k", "n"]))


def test_a_measured_side_is_broadcast_within_the_clusters_limit(spark):
    session = configure(configure(fresh(spark, **{ESTIMATED: "3m"})))
    assert session.conf.get(MEASURED) == "3m"
    few = session.range(5).groupBy(F.col("id").alias("k")).count()
    met = session.range(1000).select((F.col("id") % 7).alias("k")).join(few, "k")
    assert met.count() == sum(n % 7 < 5 for n in range(1000))


def test_the_clusters_own_settings_stay(spark):
    off = configure(fresh(spark, **{ESTIMATED: "-1", TOGETHER: "8m"}))
    assert off.conf.get(ESTIMATED) == "-1" and off.conf.get(MEASURED, None) is None
    assert off.conf.get(TOGETHER) == "8m"


def test_a_written_frames_shuffles_go(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    grouped = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.collect_list("id").alias("ids"))
    before, setting = shuffles(), spark.conf.get(SHUFFLES_GO)
    found = materialized(grouped)
    for _ in range(100):  # they go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and found.count() == 1000 and spark.conf.get(SHUFFLES_GO) == setting
