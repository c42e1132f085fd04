"""Reads split at equal depth: bounds from the key's own quantiles."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslake.operators.running import running
from campuslake.session import materialized, scratch


def cut_query(table: str, key: str, parts: int) -> str:
    """A query whose rows are the last keys of ``parts`` runs of equally many rows, in order."""
    return (
        f"SELECT MAX({key}) AS cut FROM (SELECT {key}, NTILE({parts}) OVER (ORDER BY {key}) AS part "
        f"FROM {table} WHERE {key} IS NOT NULL) tiles GROUP BY part"
    )


def cuts(df: DataFrame, key: str, parts: int) -> list[Any]:
    """What ``cut_query`` returns, of a frame: the last key of each run, equal keys not made one.

    A window over the whole frame would gather it in one task. Here keys are counted, and the
    counts summed up along ranges of keys; a run ends at the key whose sum reaches its end.
    """
    rows, upto = F.col("_rows"), F.col("_upto")
    with scratch(df.sparkSession):
        known = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        counted = materialized(known)
        each, over = divmod(counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first().n, parts)
        ends = [k * each + min(k, over) for k in range(1, (parts if each else over) + 1)]
        if not ends:
            return []
        reached = running(counted, [], [F.col(key)], "_rows", F.sum, "_upto")
        own = F.filter(F.array(*map(F.lit, ends)).cast("array<long>"), lambda e: (e > upto - rows) & (e <= upto))
        found = reached.select(key, F.explode(own).alias("_end")).collect()  # one row a part
        return [row[0] for row in sorted(found, key=lambda row: row._end)]


def literal(value: Any) -> str:
    """The value as every SQL dialect reads it."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"a key of type {type(value).__name__} can't be split")


def predicates(key: str, cuts: Sequence[Any]) -> list[str]:
    """Conditions of which every row meets exactly one; the first takes the unknown keys.

    A key that holds more rows than a part fills several runs, whose equal cuts are one
    here: its rows are read by one task, as no condition on the key could split them. The
    greatest cut bounds nothing, so that keys added since are read too.
    """
    ends = sorted(set(cuts))[:-1]
    if not ends:
        return ["1 = 1"]
    own = [literal(c) for c in ends]
    between = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(own, own[1:], strict=False)]
    return [f"{key} <= {own[0]} OR {key} IS NULL", *between, f"{key} > {own[-1]}"]
