"""Column expressions shared by the plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | dt.datetime | Column | None

# Fixed values
INTERNATIONAL = "International"
HISPANIC = "Hispanic/Latino"
SEVERAL = "Two or more"
INTERNATIONAL_STATUS = "4"
HOME_COUNTRY = "USA"


def moment(as_of: AsOf) -> Column:
    """"Now" as a column. A date includes a term's last day, a time does not.

    Comparing a midnight end date with a time of day excludes the last day, as a
    database clock would; pass a ``datetime`` for that, a ``date`` for whole days.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is None:
        # wall-clock time, as the dates it is compared with
        return F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def day(value: dt.date | str) -> Column:
    """A date literal from a ``date`` or an ISO ``YYYY-MM-DD`` string."""
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def null_as_empty_concat(*parts: Column | str) -> Column:
    """String concatenation in which a null part counts as empty text."""
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*(F.coalesce(c, F.lit("")) for c in columns))


def preferred_first_name(preferred: Column, legal: Column) -> Column:
    """The preferred first name unless it is missing or the single-blank filler."""
    return F.when(preferred != " ", preferred).otherwise(legal)


def display_name(last: Column, first: Column, middle: Column) -> Column:
    """``last,first middle``; the blank stays when there is no middle name."""
    return null_as_empty_concat(last, ",", first, " ", middle)


def deceased_flag(date_of_death: Column) -> Column:
    return F.when(date_of_death.isNull(), "N").otherwise("Y")


def may_enroll(eligible: Column, withdraw_code: Column) -> Column:
    """Eligible, or known not to be withdrawn: a null code is not a pass."""
    return (eligible == "Y") | (withdraw_code != "WDR")


def is_international(status: Column, country: Column) -> Column:
    return (status == INTERNATIONAL_STATUS) & (country == HOME_COUNTRY)


def federal_category(
    status: Column, country: Column, hispanic: Column, groups: Column, group_name: Column
) -> Column:
    """Federal reporting category, first matching rule wins."""
    return (
        F.when(is_international(status, country), INTERNATIONAL)
        .when(hispanic == "Y", HISPANIC)
        .when(groups > 1, SEVERAL)
        .otherwise(group_name)
    )


def is_primary(
    billed_rows: Column, career: Column, billing: Column, lowest: Column, primacy: Column
) -> Column:
    """1 for the row whose career is billed; among several billed, the lowest primacy.

    No billed row, no primary row.
    """
    sole = (billed_rows == 1) & (career == billing)
    first = (billed_rows > 1) & (lowest == primacy)
    return F.when(sole | first, 1).otherwise(0)
