"""Operators over effective-dated and versioned rows.

One key may hold a large share of a table, so no operator here gathers a key's
rows in one task. Windows only ever rank with a small limit, which Spark applies
on the map side before the shuffle; everything else is a grouped aggregate with a
map-side combine, joined back on its key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.functions.expressions import AsOf, day, moment
from campuslake.operators.relational import join_completed, spread_join


def current_active(df: DataFrame) -> DataFrame:
    return df.filter((F.col("edw_curr_ind") == "Y") & (F.col("edw_actv_ind") == "Y"))


def not_future(df: DataFrame, effdt: str, as_of: AsOf) -> DataFrame:
    return df.filter(F.col(effdt) <= moment(as_of))


def version_at(
    df: DataFrame,
    when: dt.date | str,
    start: str = "edw_eff_start_date",
    end: str = "edw_eff_end_date",
) -> DataFrame:
    """Rows whose closed validity interval contains the date."""
    return df.filter(day(when).between(F.col(start), F.col(end)))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_row(
    df: DataFrame, keys: Sequence[str], effdt: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the latest, an unknown date counting as latest."""
    order = [F.col(effdt).desc_nulls_first(), *(F.col(c).asc_nulls_last() for c in tiebreak)]
    return first_by(df, keys, order)


def earliest_row(
    df: DataFrame, keys: Sequence[str], effdt: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the earliest, an unknown date counting as latest."""
    return first_by(df, keys, [F.col(c).asc_nulls_last() for c in (effdt, *tiebreak)])


def latest_row_peers(
    df: DataFrame, keys: Sequence[str], effdt: str, alone: str = "alone"
) -> DataFrame:
    """One latest row per key, and whether no other row shares its date.

    The first two rows of a key tell whether the latest is alone, so no more than
    two per key and map task are shuffled.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(effdt).desc_nulls_first())
    first_two = df.withColumn("_rank", F.row_number().over(window)).filter("_rank <= 2")
    # rows of equal date are counted together
    counted = first_two.withColumn(alone, F.count(F.lit(1)).over(window) == 1)
    return counted.filter("_rank = 1").drop("_rank")


def latest_row_strict(
    df: DataFrame, keys: Sequence[str], effdt: str, count: str = "cnt"
) -> DataFrame:
    """The latest row of each key, or nothing for a key whose latest date is shared.

    ``count`` is the running count by date, which is 1 for such a row.
    ``running_count`` gives every row's.
    """
    sole = latest_row_peers(df, keys, effdt, "_alone").filter("_alone").drop("_alone")
    return sole.withColumn(count, F.lit(1).cast("long"))


def sole_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of those keys that occur once."""
    return latest_row_peers(df, keys, keys[0], "_alone").filter("_alone").drop("_alone")


def version_intervals(
    versions: DataFrame, keys: Sequence[str], effdt: str, until: str, alone: str = "alone"
) -> DataFrame:
    """One row per key and date, valid from its date to the day before the key's next date.

    ``until`` is the last day, null for the newest version; ``alone`` tells that no other
    row has the key and date. Rows without a date are no versions. A key has no more
    rows here than there are days.
    """
    dated = latest_row_peers(versions.filter(F.col(effdt).isNotNull()), [*keys, effdt], effdt, alone)
    following = Window.partitionBy(*keys).orderBy(effdt)
    return dated.withColumn(until, F.lead(F.date_sub(effdt, 1)).over(following))


def in_force_on(day_of: str, effdt: str, until: str) -> Column:
    """Whether the closed interval holds the day; an unknown end is no end."""
    return (F.col(effdt) <= F.col(day_of)) & F.coalesce(F.col(day_of) <= F.col(until), F.col(until).isNull())


def as_of_max(
    df: DataFrame, keys: Sequence[str], effective: str, bound: Column, name: str | None = None
) -> DataFrame:
    """Per key, the greatest ``effective`` value not beyond the bound."""
    reached = df.filter(F.col(effective) <= bound)
    return reached.groupBy(*keys).agg(F.max(effective).alias(name or effective))


def role_dates(
    rows: DataFrame,
    key: str,
    effdt: str,
    as_of: AsOf,
    roles: Mapping[str, Column],
    together: bool = False,
) -> DataFrame:
    """Per key and role, the date in force, one pass over the rows for all roles.

    ``<role>_known`` says that the key has rows of the role, ``<role>_held`` that
    some of them hold: dated at the latest date that is not in the future, or not
    dated. With ``together`` that latest date is taken over the rows of all roles,
    so a role whose newest row is older than another's does not hold.
    """
    date = F.col(effdt)
    reached = F.when(date <= moment(as_of), date)
    facts = [F.max(reached).alias("_latest")]
    for role, rule in roles.items():
        facts += [
            F.max(F.when(rule, reached)).alias(f"{role}_date"),
            F.bool_or(rule).alias(f"{role}_known"),
            F.bool_or(rule & date.isNull()).alias(f"{role}_undated"),
        ]
    dates = rows.groupBy(key).agg(*facts)
    for role in roles:
        own = F.col(f"{role}_date")
        if together:
            dates = dates.withColumn(f"{role}_date", F.when(own == F.col("_latest"), own))
        held = own.isNotNull() | F.col(f"{role}_undated")
        dates = dates.withColumn(f"{role}_held", held)
    return dates.drop("_latest", *(f"{role}_undated" for role in roles))


def without_expired(
    roster: DataFrame, dates: DataFrame, key: str, roles: Iterable[str]
) -> DataFrame:
    """Roster keys with their dates, less those that know a role of which nothing holds."""
    dated = roster.join(dates, key, "left")
    for role in roles:
        known = F.coalesce(F.col(f"{role}_known"), F.lit(False))
        dated = dated.withColumn(f"{role}_known", known)
        dated = dated.filter(~known | F.col(f"{role}_held"))
    return dated


def rows_in_force(
    versions: DataFrame, dates: DataFrame, key: str, effdt: str, role: str
) -> DataFrame:
    """All versions dated at the role's date in force, and undated ones. Ties stay."""
    dates = dates.select(key, f"{role}_date")
    return (
        spread_join(versions, dates, key)
        .filter(F.col(effdt).isNull() | (F.col(effdt) == F.col(f"{role}_date")))
        .drop(effdt, f"{role}_date")
    )


def attach_in_force(
    base: DataFrame, versions: DataFrame, dates: DataFrame, key: str, effdt: str, role: str
) -> DataFrame:
    """Join the versions in force, with nulls for the keys that know none."""
    held = rows_in_force(versions, dates, key, effdt, role)
    absent = dates.filter(~F.col(f"{role}_known")).select(key)
    return join_completed(base, held, absent, key)


def latest_or_absent(
    base: DataFrame, roster: DataFrame, versions: DataFrame, key: str, effdt: str, as_of: AsOf
) -> DataFrame:
    """Attach the versions in force; nulls only for a key that has no version at all.

    A key whose versions are all dated later leaves the result: it has versions,
    and none of them holds. ``roster`` is the distinct keys of ``base`` or more.
    """
    found = role_dates(versions, key, effdt, as_of, {"version": F.lit(True)})
    dates = without_expired(roster, found, key, ["version"])
    return attach_in_force(base, versions, dates, key, effdt, "version")

