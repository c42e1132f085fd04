"""Credit-hour snapshot of a term on a date, and its headcount.

The joins fan out by design: credits meet every career-term row of the student.
Each side is first reduced to one row per combination of join and output columns,
with its number of rows, and the sums are multiplied by those numbers, so the
fan-out is never built and a student with very many rows costs one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.functions.expressions import AsOf, day, is_primary, may_enroll
from campuslake.operators.effective import (
    as_of_max,
    earliest_row,
    not_future,
    version_at,
)
from campuslake.operators.relational import over_keys, pivot_count_total, spread_join

RESIDENCY = ["residency", "admission_res", "tuition_res", "fin_aid_fed_res"]
CAREER_KEY = ["emplid", "acad_career", "institution"]

BASE_COLUMNS = [
    "emplid", "strm", "acad_career", "billing_career", *RESIDENCY,
    "sum_unt_taken", "sum_unt_billing", "fa_primacy_nbr", "fanummin",
    "bill", "billcnt", "primary",
]


def enrolled_credits(enrollments: DataFrame, term: Column, on: dt.date | str) -> DataFrame:
    """Credits of the enrolled classes in force on the date, by student career."""
    taken = enrollments.filter((F.col("strm") == term) & (F.col("stdnt_enrl_status") == "E"))
    return version_at(taken, on).groupBy(*CAREER_KEY).agg(
        F.sum("unt_taken").alias("sum_unt_taken"),
        F.sum("unt_billing").alias("sum_unt_billing"),
    )


def active_careers(career_terms: DataFrame, term: Column, on: dt.date | str) -> DataFrame:
    """Career-term rows in force on the date, with how often each occurs."""
    eligible = career_terms.filter(
        (F.col("strm") == term) & may_enroll(F.col("elig_to_enroll"), F.col("withdraw_code"))
    )
    return version_at(eligible, on).groupBy(*CAREER_KEY, "strm", "billing_career").agg(
        F.count(F.lit(1)).alias("career_rows")
    )


def residency_versions(residencies: DataFrame, on: dt.date | str) -> DataFrame:
    """Residency rows in force on the date, with how often each occurs."""
    return version_at(residencies, on).groupBy(*CAREER_KEY, "effective_term", *RESIDENCY).agg(
        F.count(F.lit(1)).alias("residency_rows")
    )


def career_primacy(careers: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The financial-aid rank each career started with, per institution."""
    known = not_future(careers, "effdt", as_of)
    first = earliest_row(known, ["institution", "acad_career"], "effdt", ["fa_primacy_nbr"])
    return first.select("acad_career", "fa_primacy_nbr")


def term_credits(
    enrollments: DataFrame,
    career_terms: DataFrame,
    residencies: DataFrame,
    term: Column,
    on: dt.date | str,
) -> DataFrame:
    """Credit sums by student, career, billing career and residency of the term.

    The residency is the credits' career's row whose effective term is the latest
    one the career-term row had reached.
    """
    begun = residencies.filter(F.col("effective_term") <= term)
    reached = as_of_max(version_at(begun, on), CAREER_KEY, "effective_term", term)
    careers = active_careers(career_terms, term, on).join(reached, CAREER_KEY)
    own = {"acad_career": "credit_career", "institution": "credit_institution"}
    credits = enrolled_credits(enrollments, term, on).withColumnsRenamed(own)
    lived = residency_versions(begun, on).withColumnsRenamed(own)
    matched = careers.join(credits, "emplid").join(
        lived, ["emplid", "credit_career", "credit_institution", "effective_term"]
    )
    copies = F.col("career_rows") * F.col("residency_rows")
    keys = ["emplid", "strm", "acad_career", "billing_career", *RESIDENCY]
    return matched.groupBy(*keys).agg(
        F.sum(F.col("sum_unt_taken") * copies).alias("sum_unt_taken"),
        F.sum(F.col("sum_unt_billing") * copies).alias("sum_unt_billing"),
    )


def with_primary_flag(credits: DataFrame, primacy: DataFrame) -> DataFrame:
    """Mark each student's primary row from billing careers and career primacy.

    A student's rows here are distinct codes, a handful, whatever the source holds.
    """
    student = ["emplid", "strm"]
    career, billing = F.col("acad_career"), F.col("billing_career")
    billed = F.when(career == billing, 1).otherwise(0)
    return (
        spread_join(credits, primacy, "acad_career", "left")
        .withColumn("bill", billed)
        .withColumn("fanummin", over_keys(F.min("fa_primacy_nbr"), student))
        .withColumn("billcnt", over_keys(F.sum("bill"), student))
        .withColumn(
            "primary",
            is_primary(
                F.col("billcnt"), career, billing, F.col("fanummin"), F.col("fa_primacy_nbr")
            ),
        )
    )


def enrollment_snapshot_base(
    enrollments: DataFrame,
    career_terms: DataFrame,
    residencies: DataFrame,
    careers: DataFrame,
    term: Column,
    on: dt.date | str,
    as_of: AsOf = None,
) -> DataFrame:
    credits = term_credits(enrollments, career_terms, residencies, term, on)
    return with_primary_flag(credits, career_primacy(careers, as_of)).select(*BASE_COLUMNS)


def enrollment_snapshot_agg(
    base: DataFrame, on: dt.date | str, tuition_values: Sequence[str] | None = None
) -> DataFrame:
    """Primary rows by career and tuition residency, stamped with the date."""
    primary = base.filter(F.col("primary") == 1)
    counted = pivot_count_total(primary, "acad_career", "tuition_res", tuition_values)
    return counted.withColumn("Date", day(on))
