"""The public operations, bound to a warehouse, a term and a moment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.functions.expressions import AsOf
from campuslake.plans import enrollment, people, snapshot, terms
from campuslake.sources.warehouse import Warehouse


@dataclass(frozen=True)
class TermQueries:
    """Every operation for one term; most return lazy DataFrames; the
    schedule, the profile and the headcount without codes run jobs when called.

    ``term`` is a term code, or a column that yields it. ``as_of`` stands for
    "now": a date, a time, or today when left out.
    """

    warehouse: Warehouse
    term: str | Column | None = None
    as_of: AsOf = None

    @classmethod
    def with_select_term(cls, warehouse: Warehouse, term: str, as_of: AsOf = None) -> TermQueries:
        return cls(warehouse, term, as_of)

    @classmethod
    def with_current_term(cls, warehouse: Warehouse, as_of: AsOf = None) -> TermQueries:
        """Bind the term in session, looked up inside each plan that uses it."""
        return cls(warehouse, terms.current_term_value(warehouse["r_term_rv"], as_of), as_of)

    def _term(self) -> Column:
        if self.term is None:
            raise ValueError("choose a term first: with_select_term or with_current_term")
        return self.term if isinstance(self.term, Column) else F.lit(str(self.term))

    def current_term(self) -> DataFrame:
        return terms.current_term(self.warehouse["r_term_rv"], self.as_of)

    def term_enrollment(self) -> DataFrame:
        source = self.warehouse
        return enrollment.term_enrollment(
            source["r_studentterm_rv"],
            source["r_stdntbiodemo_rv"],
            source["r_acadplan_rv"],
            source["t_xlatitem_v"],
            self._term(),
            self.as_of,
        )

    def course_enrollment(self) -> DataFrame:
        source = self.warehouse
        return enrollment.course_enrollment(
            source["r_studentclass_rv"],
            source["r_coursecatalog_rv"],
            source["r_term_rv"],
            source["r_classschedule_rv"],
            source["r_termsession_rv"],
            self._term(),
        )

    def enrollment_schedule(self) -> DataFrame:
        return enrollment.enrollment_schedule(self.term_enrollment(), self.course_enrollment())

    def race_detail(self) -> DataFrame:
        source = self.warehouse
        return people.race_detail(
            source["p_citizenship_av"],
            source["s_citizen_sts_tbl_av"],
            source["p_ethnicity_dtl_av"],
            source["s_ethnic_grp_tbl_av"],
            source["t_xlattable_vw_av"],
            source["p_stdnt_car_term_av"],
            self._term(),
            self.as_of,
        )

    def race_ethnicity_category(self) -> DataFrame:
        return people.race_ethnicity_category(self.race_detail())

    def bio_demographics(self, gender_attribute: str, tribe_attribute: str) -> DataFrame:
        """Profiles; the two names say which attributes hold gender preference and tribe."""
        source = self.warehouse
        return people.bio_demographics(
            source["p_pers_data_effdt_av"],
            source["p_names_av"],
            source["p_scc_caf_persbio_av"],
            source["p_person_av"],
            source["p_residency_off_av"],
            source["p_residency_off_v"],
            source["p_stdnt_car_term_av"],
            gender_attribute,
            tribe_attribute,
            self._term(),
            self.as_of,
        )

    def enrollment_snapshot_base(self, on: dt.date | str) -> DataFrame:
        source = self.warehouse
        return snapshot.enrollment_snapshot_base(
            source["p_stdnt_enrl_av"],
            source["p_stdnt_car_term_av"],
            source["p_residency_off_av"],
            source["s_acad_car_tbl_v"],
            self._term(),
            on,
            self.as_of,
        )

    def enrollment_snapshot_agg(
        self, on: dt.date | str, tuition_values: Sequence[str] | None = None
    ) -> DataFrame:
        return snapshot.enrollment_snapshot_agg(
            self.enrollment_snapshot_base(on), on, tuition_values
        )
