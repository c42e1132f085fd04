"""The academic calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.functions.expressions import AsOf, moment


def current_term(calendar: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row: the greatest term in session, null between terms."""
    in_session = moment(as_of).between(F.col("term_begin_dt"), F.col("term_end_dt"))
    return calendar.filter(in_session).agg(F.max("strm").alias("term"))


def current_term_value(calendar: DataFrame, as_of: AsOf = None) -> Column:
    """The current term as a scalar subquery of the plan that uses it.

    The query fails, rather than returning nothing, when no term is in session.
    """
    missing = F.raise_error(F.lit("no term is in session on the given date"))
    return current_term(calendar, as_of).select(F.coalesce(F.col("term"), missing)).scalar()


def next_term_begin(calendar: DataFrame) -> DataFrame:
    """Each career's terms with the day before the following term begins.

    The last known term of a career has none. The calendar holds one row per
    institution, career and term, so a partition is as long as the history of terms.
    """
    following = Window.partitionBy("institution", "acad_career").orderBy("strm")
    return calendar.select(
        "institution",
        "acad_career",
        "strm",
        F.lead(F.date_sub("term_begin_dt", 1)).over(following).alias("next_term_begin_dt1"),
    )
