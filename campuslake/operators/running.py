"""Running aggregates along a key's order, and what rests on them.

A window over a key would gather its rows in one task. Here rows are dealt out by
ranges of key and order, so that a key with very many rows spans several ranges; each
range has its own running values, and what the ranges before it hold of its key is
carried over. A key has one carried row for each range, whatever its number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.operators.relational import spread_join
from campuslake.session import kept, materialized

# Rows of one range, and of one task of the windows.
ROWS_TOGETHER = 500_000


def running(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    merge: Callable[[str], Column],
    name: str,
) -> DataFrame:
    """The rows with the running ``merge`` of ``value``: of all rows of the key up to this one.

    ``merge`` is an aggregate that can be taken of its own results, ``F.sum`` or ``F.max``.
    The order tells all rows of a key apart; equal keys include unknown ones. Without keys
    all rows are one. The rows are written when this is called, counted, and dealt out to
    ranges of ROWS_TOGETHER rows, so that a task holds no more of a larger input.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with kept(rows) as written:
        ranges = max(least, -(-written.count() // ROWS_TOGETHER))
        dealt = written.repartitionByRange(ranges, *keys, *order)
        ranged = materialized(dealt.withColumn("_range", F.spark_partition_id()))
    placed = ranged.repartition(ranges, "_range", *keys)
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_range").agg(merge(value).alias("_total"))
    carried = totals.withColumn("_carried", merge("_total").over(earlier)).drop("_total")
    met = placed.withColumn("_inside", merge(value).over(inside))
    both = spread_join(met, carried.filter("_carried is not null"), [*keys, "_range"], "left", nulls=True)
    # the merge of two values, either of which may be missing
    pair = F.array_compact(F.array("_carried", "_inside"))
    column = F.array_max(pair) if merge is F.max else F.aggregate(pair, F.lit(None).cast(met.schema["_inside"].dataType), lambda a, x: F.coalesce(a + x, x))
    return both.withColumn(name, column).drop("_range", "_inside", "_carried")


def running_count(df: DataFrame, keys: Sequence[str], date: str, name: str = "cnt") -> DataFrame:
    """Every row with the number of its key's rows from the newest date down to its own.

    Rows of one date count together; an unknown date is the newest of all. It is
    ``count(*) over (partition by keys order by date desc)`` with the frame that a window
    has by default. Only one row for each key and date takes part in the running sum.
    """
    dated = df.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("_rows"))
    counted = running(dated, keys, [F.col(date).desc_nulls_first()], "_rows", F.sum, name)
    return spread_join(df, counted.drop("_rows"), [*keys, date], nulls=True)


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    bound: str,
    effective: str,
    name: str | None = None,
) -> DataFrame:
    """Every left row with the greatest ``effective`` value of its key not beyond its own ``bound``.

    Null where there is none, or where a key or the bound is unknown. Both sides are
    reduced to their distinct keys and times, put into one order, and each bound takes
    the last value reached before it. Left rows are then met again by key and bound.
    """
    name = name or effective
    bounds = left.select(*keys, F.col(bound).alias("_time")).dropna().distinct()
    reached = right.select(*keys, F.col(effective).alias("_time")).dropna().distinct()
    unknown = F.lit(None).cast(right.schema[effective].dataType)
    both = reached.select("*", F.lit(0).alias("_side"), F.col("_time").alias("_value")).unionByName(
        bounds.select("*", F.lit(1).alias("_side"), unknown.alias("_value"))
    )
    # a value at the bound itself is reached
    order = [F.col("_time"), F.col("_side")]
    found = running(both, keys, order, "_value", F.max, name).filter("_side = 1")
    found = found.select(*keys, F.col("_time").alias(bound), name)
    return spread_join(left, found, [*keys, bound], "left")
