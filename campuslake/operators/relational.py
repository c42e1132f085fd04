"""Joins, distinct counts, partition aggregates and the pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.session import materialized


def spread_join(
    many: DataFrame, few: DataFrame, on: str | Sequence[str], how: str = "inner", nulls: bool = False
) -> DataFrame:
    """Join many rows to few rows per key, where one key may hold much of ``many``.

    Spark splits a skewed partition at run time only where both sides of the join
    come straight from a shuffle. ``few`` is usually grouped or ranked by the join
    key and would be joined in place, so a hash of the key is added to the key: it
    asks for a shuffle of the reduced ``few`` and changes no match. A small ``few``
    is still broadcast by its size. Keys of two types are hashed as the type both
    widen to, as they are compared. With ``nulls`` an unknown key meets an unknown one.
    """
    keys = [on] if isinstance(on, str) else list(on)
    wide = many.select(*keys).union(few.select(*keys)).schema.fields
    spread = F.xxhash64(*(F.col(k).cast(f.dataType) for k, f in zip(keys, wide, strict=True)))
    left, right = many.withColumn("_spread", spread), few.withColumn("_spread", spread)
    if not nulls:
        return left.join(right, [*keys, "_spread"], how).drop("_spread")
    named = right.withColumnsRenamed({k: f"_few_{k}" for k in [*keys, "_spread"]})
    same = F.col("_spread") == F.col("_few__spread")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_few_{k}"))
    return left.join(named, same, how).drop("_spread", *(f"_few_{k}" for k in [*keys, "_spread"]))


def left_join_spread(
    base: DataFrame, roster: DataFrame, right: DataFrame, key: str
) -> DataFrame:
    """A left join whose right side may be skewed.

    Spark can split a skewed right side of an inner join, not of a left join, so the
    right side is completed with a null row for every roster key that it lacks.
    ``roster`` holds the distinct keys of ``base`` or more.
    """
    wanted = spread_join(right, roster, key, "left_semi")
    absent = roster.join(right.select(key).distinct(), key, "left_anti")
    return join_completed(base, wanted, absent, key)


def join_completed(base: DataFrame, rows: DataFrame, absent: DataFrame, key: str) -> DataFrame:
    """Join rows to the base, with nulls for the absent keys."""
    return spread_join(base, rows.unionByName(absent, allowMissingColumns=True), key)


def left_join_suffixed(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str
) -> DataFrame:
    """Left join that renames the right side's overlapping columns.

    The right side may be skewed, and Spark splits no right side of a left join: the
    matches are an inner join, and the left rows that have none are told by the right
    side's grouped keys, of which nothing but the keys is read. Both joins deal out the
    left side alike, so its shuffle is read twice and run once.
    """
    overlap = (set(left.columns) & set(right.columns)) - set(on)
    renamed = right.withColumnsRenamed({c: c + suffix for c in overlap})
    matched = spread_join(left, renamed, on)
    lacking = spread_join(left, right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(lacking, allowMissingColumns=True).select(
        *left.columns, *(c for c in renamed.columns if c not in on)
    )


# A pivot of more columns than this is a mistaken column.
MOST_COLUMNS = 1000


def group_max_known_keys(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Grouped maxima over the rows whose keys are all known."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in columns)
    )


def distinct_pair_count(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Distinct (key, value) pairs per known key; a null value is a value."""
    pairs = df.dropna(subset=[key]).select(key, value).distinct()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def over_keys(aggregate: Column, keys: Sequence[str]) -> Column:
    """An aggregate given back to every row of its key, for keys known to have few rows each.

    It spares a join. Where one key may have very many rows, use ``given_back``.
    """
    return aggregate.over(Window.partitionBy(*keys))


def given_back(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates of each key, given back to every one of its rows.

    The key is aggregated before its shuffle and joined back, so that a key with very many rows
    is split. A row with an unknown key gets nulls. Both uses ask for the same
    columns: then what they rest on is shuffled once and read twice.
    """
    whole = F.bit_xor(F.xxhash64(*df.columns)).alias("_whole")
    totals = df.groupBy(*keys).agg(*(c.alias(n) for n, c in aggregates.items()), whole)
    return spread_join(df, totals.filter("_whole is not null").drop("_whole"), keys, "left")


def pivot_count_total(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence[str] | None = None,
    total: str = "ttl",
) -> DataFrame:
    """Row counts by two keys, the second spread into columns, with a row total.

    A combination that does not occur is null; rows with an unknown key are left
    out. The total is that of all known codes: with ``values``, a code that is not
    listed fails the query. Without ``values`` the counts are written once and the
    columns read from them; more than MOST_COLUMNS codes are refused.
    """
    known = df.dropna(subset=[row, column])
    counts = known.groupBy(row, column).agg(F.count(F.lit(1)).alias("_rows"))
    if values is None:
        counts = materialized(counts)
        codes = counts.select(column).distinct().orderBy(column).limit(MOST_COLUMNS + 1)
        values = [r[0] for r in codes.collect()]
        if len(values) > MOST_COLUMNS:
            raise ValueError(f"{column} has more than {MOST_COLUMNS} codes")
    taken = {row, total} & set(map(str, values))
    if taken:
        raise ValueError(f"a code has the name of another column: {sorted(taken)}")
    code = F.col(column)
    listed = code.isin(*values) if values else F.lit(False)
    unlisted = F.raise_error(F.concat(F.lit(f"{column} has a code that is not listed: "), code.cast("string")))
    checked = F.when(listed, F.col("_rows")).otherwise(unlisted.cast("long"))
    return counts.groupBy(row).agg(
        *(F.sum(F.when(code == v, F.col("_rows"))).alias(str(v)) for v in values),
        F.sum(checked).alias(total),
    )
