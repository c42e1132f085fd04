"""The source relations derived from the given tables, as DataFrames.

``fixtures/recipes.py`` states the same derivations in SQL for the checks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslake import Warehouse

FOREVER = dt.date(9999, 12, 31)
START = dt.date(1995, 1, 1)


def _flags(active: Column | None = None, current: Column | None = None) -> list[Column]:
    active, current = (F.lit("Y") if flag is None else flag for flag in (active, current))
    return [current.alias("edw_curr_ind"), active.alias("edw_actv_ind")]


def _institution(second: Column) -> Column:
    return F.when(second, "I1").otherwise("I0").alias("institution")


def _unless(condition: Column) -> Column:
    return F.when(condition, "N").otherwise("Y")


def _texts(**values: str) -> list[Column]:
    return [F.lit(v).alias(k) for k, v in values.items()]


def _expand(df: DataFrame, *names: str, rows: list[tuple]) -> DataFrame:
    """Repeat each row once per tuple of constants."""
    items = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in rows))
    return df.withColumn("_item", F.explode(items)).select(
        *df.columns, *(F.col(f"_item.{n}").alias(n) for n in names)
    )


def _term() -> Column:
    return (F.year("o_orderdate") * 10 + F.quarter("o_orderdate")).cast("string").alias("strm")


def _career() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "UGRD")
        .when(F.col("o_orderstatus") == "O", "GRAD")
        .otherwise("PROF")
        .alias("acad_career")
    )


class Derived:
    """Each method derives one relation; base columns only, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def r_term_rv(self) -> DataFrame:
        quarters = (
            self.table("orders")
            .select(_term(), _career(), F.trunc("o_orderdate", "quarter").alias("term_begin_dt"))
            .distinct()
        )
        end = F.date_sub(F.add_months("term_begin_dt", 3), 1)
        first = quarters.select(
            "strm", "acad_career", F.lit("I0").alias("institution"), "term_begin_dt",
            end.alias("term_end_dt"),
        )
        # the second institution's terms begin and end two weeks later
        second = first.filter(F.col("acad_career") == "PROF").select(
            "strm", "acad_career", F.lit("I1").alias("institution"),
            *(F.date_add(c, 14).alias(c) for c in ("term_begin_dt", "term_end_dt")),
        )
        return first.unionByName(second)

    def _student_terms(self) -> DataFrame:
        """One row per student, term and career, with the term's first career."""
        careers = (
            self.table("orders")
            .select(F.col("o_custkey").alias("emplid"), _term(), _career())
            .groupBy("emplid", "strm")
            .agg(F.collect_set("acad_career").alias("careers"))
        )
        return careers.select(
            "emplid", "strm", F.explode("careers").alias("acad_career"),
            F.array_min("careers").alias("first_career"), _institution(F.col("emplid") % 23 == 0),
        )

    def p_stdnt_car_term_av(self) -> DataFrame:
        student = F.col("emplid")
        return self._student_terms().select(
            "emplid", "strm", "acad_career", "institution",
            F.when(student % 11 == 0, "NONE")
            .when(student % 4 == 1, F.col("acad_career"))
            .otherwise(F.col("first_career")).alias("billing_career"),
            _unless(student % 5 == 0).alias("elig_to_enroll"),
            F.when(student % 3 == 0, "WDR").when(student % 3 == 1, "NWD").alias("withdraw_code"),
            F.lit(START).alias("edw_eff_start_date"),
            F.lit(FOREVER).alias("edw_eff_end_date"),
            *_flags(_unless(student % 13 == 0), _unless(student % 37 == 5)),
        )

    def _order_lines(self) -> DataFrame:
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def p_stdnt_enrl_av(self) -> DataFrame:
        units = F.col("l_quantity").cast("int")
        return self._order_lines().select(
            F.col("o_custkey").alias("emplid"), _term(), _career(),
            _institution(F.col("o_custkey") % 23 == 0), F.col("l_partkey").alias("class_nbr"),
            units.alias("unt_taken"), (units % 4).alias("unt_billing"),
            F.when(F.col("l_returnflag") == "N", "E")
            .when(F.col("l_returnflag") == "A", "D")
            .otherwise("W").alias("stdnt_enrl_status"),
            F.col("o_orderdate").cast("date").alias("edw_eff_start_date"),
            F.when(F.col("l_linestatus") == "O", F.lit(FOREVER))
            .otherwise(F.col("l_shipdate").cast("date")).alias("edw_eff_end_date"),
        )

    def p_residency_off_av(self) -> DataFrame:
        person, nation = F.col("c_custkey"), F.col("c_nationkey")
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        held = _expand(customers, "acad_career", rows=[("UGRD",), ("GRAD",), ("PROF",)])
        held = _expand(
            held, "n", "effective_term", rows=[(0, "19951"), (1, "19974"), (2, "19993")]
        ).filter(~((person % 10 == 0) & (F.col("n") < 2)))
        turn = nation + F.col("n")
        return held.select(
            person.alias("emplid"), "acad_career", _institution(person % 46 == 0),
            "effective_term",
            F.when(turn % 3 == 0, None).when(turn % 3 == 1, "RES").otherwise("NRES")
            .alias("tuition_res"),
            F.when(turn % 2 == 0, "RES").otherwise("NRES").alias("residency"),
            *_texts(admission_res="RES", fin_aid_fed_res="RES"),
            F.concat(F.lit("City "), turn.cast("string")).alias("city"),
            F.concat(F.lit("S"), nation.cast("string")).alias("state"),
            F.concat(F.col("acad_career"), F.lit(" County")).alias("county"),
            F.lit("USA").alias("country"),
            F.lit(START).alias("edw_eff_start_date"),
            F.when(person % 17 == 0, F.lit(dt.date(1997, 12, 31))).otherwise(F.lit(FOREVER))
            .alias("edw_eff_end_date"),
            *_flags(current=_unless((person + F.col("n")) % 27 == 0)),
        )

    def p_residency_off_v(self) -> DataFrame:
        return self.p_residency_off_av().select("emplid", "acad_career", "effective_term")

    def s_acad_car_tbl_v(self) -> DataFrame:
        return self.spark.sql(
            """SELECT * FROM VALUES
            ('I0', 'UGRD', 1, DATE '1990-01-01'), ('I0', 'UGRD', 9, DATE '1996-01-01'),
            ('I0', 'GRAD', 2, DATE '1990-01-01'), ('I0', 'PROF', 3, DATE '1990-01-01'),
            ('I1', 'PROF', 4, DATE '1990-01-01')
            AS t (institution, acad_career, fa_primacy_nbr, effdt)"""
        )

    def p_citizenship_av(self) -> DataFrame:
        person = F.col("c_custkey")
        customers = self.table("customer")
        first = customers.select(
            person.alias("emplid"),
            F.when(person % 9 == 0, "CAN").otherwise("USA").alias("country"),
            (person % 6).cast("string").alias("citizenship_status"),
            *_flags(current=_unless(person % 43 == 0)),
        )
        second = customers.filter(person % 25 == 2).select(
            person.alias("emplid"), *_texts(country="USA", citizenship_status="1"), *_flags()
        )
        return first.unionByName(second)

    def s_citizen_sts_tbl_av(self) -> DataFrame:
        return self.table("region").select(
            F.lit("USA").alias("country"),
            F.col("r_regionkey").cast("string").alias("citizenship_status"),
            F.col("r_name").alias("descr"),
            *_flags(),
        )

    def p_ethnicity_dtl_av(self) -> DataFrame:
        person, nation = F.col("c_custkey"), F.col("c_nationkey")
        customers = self.table("customer")

        def code(number: Column) -> Column:
            return F.concat(F.lit("E"), (number % 7).cast("string")).alias("ethnic_grp_cd")

        first = customers.filter(person % 8 != 7).select(
            person.alias("emplid"), code(nation),
            F.when(person % 4 == 0, "Y").otherwise("N").alias("hisp_latino"),
            *_flags(current=_unless(person % 31 == 0)),
        )
        second = customers.filter(person % 5 == 1).select(
            person.alias("emplid"), code(nation + 1), F.lit("N").alias("hisp_latino"), *_flags()
        )
        return first.unionByName(second)

    def s_ethnic_grp_tbl_av(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        group = F.col("r_regionkey").cast("string")
        return nations.select(
            F.when(F.col("n_nationkey") % 4 == 0, "CAN").otherwise("USA").alias("setid"),
            F.concat(F.lit("E"), group).alias("ethnic_grp_cd"),
            group.alias("ethnic_group"),
            F.make_date(F.lit(1990) + F.col("n_nationkey"), F.lit(1), F.lit(1)).alias("effdt"),
            *_flags(),
        )

    def t_xlattable_vw_av(self) -> DataFrame:
        return self.table("region").select(
            F.lit("ETHNIC_GROUP").alias("fieldname"),
            F.col("r_regionkey").cast("string").alias("fieldvalue"),
            F.concat(F.lit("GROUP "), F.col("r_name")).alias("xlatlongname"),
            F.lit("A").alias("eff_status"),
            *_flags(),
        )

    def p_names_av(self) -> DataFrame:
        number = F.col("event_id")

        def numbered(letter: str, modulus: int) -> Column:
            return F.concat(F.lit(letter), (number % modulus).cast("string"))

        return self.table("events").select(
            F.col("user_id").alias("emplid"),
            F.when(F.col("event_type") == "view", "PRF").otherwise("PRI").alias("name_type"),
            F.col("ts").cast("date").alias("effdt"),
            numbered("L", 97).alias("last_name"),
            F.when(number % 5 == 0, " ").otherwise(numbered("F", 89)).alias("first_name"),
            F.when(number % 3 != 0, numbered("M", 7)).alias("middle_name"),
            F.when(number % 10 == 0, "Jr").alias("name_suffix"),
            *_flags(_unless(number % 6 == 0), _unless(number % 29 == 0)),
        )

    def r_coursecatalog_rv(self) -> DataFrame:
        number = F.col("p_partkey")
        parts = self.table("part").select("p_partkey", "p_type", "p_brand", "p_name")
        versions = _expand(
            parts, "n", "crse_effdt",
            rows=[(0, dt.date(1994, 1, 1)), (1, dt.date(1997, 6, 1)), (2, dt.date(2000, 6, 1))],
        ).filter((number % 3 >= F.col("n")) | (F.col("n") == 0))
        course = [
            number.alias("crse_id"), F.col("p_type").alias("subject"),
            F.col("p_brand").alias("crse_code"),
        ]
        rest = [
            F.lit(FOREVER).alias("crse_effdt_end"),
            F.lit("A").alias("crse_eff_status"),
            F.col("p_brand").alias("acad_org_mau"),
            F.concat(F.lit("Unit "), F.col("p_brand")).alias("acad_org_mau_descrformal"),
            F.col("p_type").alias("acad_org_u1"),
            F.concat(F.lit("Part "), F.col("p_type")).alias("acad_org_u1_descrformal"),
        ]
        copies = parts.filter(number % 20 == 1).select(
            *course, F.lit(dt.date(1997, 6, 1)).alias("crse_effdt"),
            F.lit("dup").alias("course_title_long"), *rest,
        )
        return versions.select(
            *course, "crse_effdt", F.col("p_name").alias("course_title_long"), *rest
        ).unionByName(copies)

    def r_studentterm_rv(self) -> DataFrame:
        student = F.col("emplid")
        return self._student_terms().select(
            "emplid", "strm", "acad_career", "institution",
            F.when(student % 4 == 0, "C").when(student % 4 == 1, "E")
            .when(student % 4 == 2, "W").otherwise("N").alias("enrollment_status"),
            F.when(F.col("acad_career") == F.col("first_career"), "Y").otherwise("N")
            .alias("primary_car_flag"),
            (10 * (1 + student % 4)).cast("string").alias("acad_level_bot"),
            F.concat(F.lit("P"), (student % 30).cast("string")).alias("acad_plan"),
            (student % 18).cast("int").alias("tot_proj_units"),
            F.concat(F.lit("Term "), F.col("strm")).alias("term_descrshort"),
            F.col("acad_career").alias("degree_career"),
            *_texts(residency="RES", admission_res="RES", tuition_res="NRES",
                    fin_aid_fed_res="RES"),
        )

    def t_xlatitem_v(self) -> DataFrame:
        return self.spark.sql(
            """SELECT * FROM VALUES
            ('ACADEMIC_LEVEL', '10', 'FR', 'Freshman', DATE '1990-01-01'),
            ('ACADEMIC_LEVEL', '10', 'FRS', 'First year', DATE '1996-01-01'),
            ('ACADEMIC_LEVEL', '10', 'FUT', 'Future', DATE '2050-01-01'),
            ('ACADEMIC_LEVEL', '20', 'SO', 'Sophomore', DATE '1990-01-01'),
            ('ACADEMIC_LEVEL', '20', 'SO2', 'Sophomore tie', DATE '1990-01-01'),
            ('ACADEMIC_LEVEL', '30', 'JR', 'Junior', DATE '1990-01-01'),
            ('OTHER', '40', 'XX', 'Other', DATE '1990-01-01')
            AS t (fieldname, fieldvalue, xlatshortname, xlatlongname, effdt)"""
        )

    def r_stdntbiodemo_rv(self) -> DataFrame:
        person = F.col("c_custkey")
        status = (person % 6).cast("string")
        customers = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return customers.filter(person % 40 != 3).select(
            person.alias("emplid"),
            F.when(person % 2 == 0, "F").otherwise("M").alias("sex"),
            status.alias("citizenship_status"),
            F.col("n_name").alias("res_country"),
            F.concat(F.lit("Status "), status).alias("citizenship_descrshort"),
            F.concat(F.lit("Group "), (person % 7).cast("string")).alias("ipeds_race_ethnicity"),
            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("res_state"),
            F.col("c_mktsegment").alias("res_county"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("res_city"),
        )

    def r_acadplan_rv(self) -> DataFrame:
        unit = F.col("n_regionkey").cast("string")
        return self.table("nation").select(
            F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("acad_plan"),
            _institution(F.col("n_nationkey") % 12 == 11),
            F.col("n_name").alias("acad_plan_descr"),
            unit.alias("acad_plan_mau"),
            F.concat(F.lit("Unit "), unit).alias("acad_plan_mau_descrformal"),
            unit.alias("acad_plan_u1"),
            F.concat(F.lit("Part "), unit).alias("acad_plan_u1_descrformal"),
        )

    def r_studentclass_rv(self) -> DataFrame:
        lines = self._order_lines().join(
            self.table("part"), F.col("l_partkey") == F.col("p_partkey")
        )
        return lines.select(
            F.col("o_custkey").alias("emplid"), _term(), F.col("l_partkey").alias("class_nbr"),
            F.col("p_type").alias("subject"), _career(), F.col("l_partkey").alias("crse_id"),
            F.col("p_brand").alias("crse_code"),
            F.col("l_linenumber").cast("string").alias("class_section"),
            (F.col("l_quantity").cast("int") % 4).alias("unt_billing"),
            F.col("l_returnflag").alias("crse_grade_off"),
            _career().alias("crse_career"),
            F.col("l_linestatus").alias("repeat_code"),
        )

    def r_classschedule_rv(self) -> DataFrame:
        number = F.col("class_nbr")
        sections = (
            self.r_studentclass_rv()
            .select("strm", "class_nbr", "subject", "crse_code", "class_section")
            .distinct()
        )
        main = F.struct(
            F.when(number % 10 == 0, "X").otherwise("A").alias("class_stat"),
            F.lit("MAIN").alias("location"),
        )
        annex = F.struct(F.lit("A").alias("class_stat"), F.lit("ANNEX").alias("location"))
        places = F.when(number % 15 == 1, F.array(main, annex)).otherwise(F.array(main))
        return sections.withColumn("place", F.explode(places)).select(
            "strm", "class_nbr", "subject", "crse_code", "class_section",
            (1 + number % 2).cast("string").alias("session_code"),
            "place.class_stat", "place.location",
            F.concat(F.lit("S"), F.col("class_section")).alias("section_id"),
            *_texts(class_type="E", class_type_xlatlongname="Enrollment Section"),
        )

    def r_termsession_rv(self) -> DataFrame:
        first = self.r_term_rv().filter(F.col("institution") == "I0")
        sessions = _expand(first, "session_code", rows=[("1",), ("2",)])
        missing = (F.col("acad_career") == "PROF") & (F.col("session_code") == "2")
        return sessions.filter(~missing).select(
            "strm", "acad_career", "session_code",
            F.col("term_begin_dt").alias("sess_begin_dt"),
            F.col("term_end_dt").alias("sess_end_dt"),
        )

    def p_pers_data_effdt_av(self) -> DataFrame:
        person = F.col("c_custkey")
        customers = self.table("customer")
        first = customers.select(
            person.alias("emplid"),
            F.make_date(
                (1990 + person % 20).cast("int"), F.lit(1), F.lit(1)
            ).alias("effdt"),
            F.when(person % 2 == 0, "F").otherwise("M").alias("sex"),
            *_flags(_unless(person % 19 == 0), _unless(person % 41 == 0)),
        )
        second = customers.filter(person % 6 == 0).select(
            person.alias("emplid"), F.lit(dt.date(1997, 1, 1)).alias("effdt"),
            F.lit("U").alias("sex"), *_flags(),
        )
        return first.unionByName(second)

    def p_scc_caf_persbio_av(self) -> DataFrame:
        person = F.col("c_custkey")
        customers = self.table("customer")
        old, new = F.lit(dt.date(1995, 1, 1)), F.lit(dt.date(1996, 1, 1))

        def rows(chosen: Column, name: str, value: str, effdt: Column) -> DataFrame:
            return customers.filter(chosen).select(
                person.alias("emplid"),
                *_texts(scc_caf_attrib_nm=name, scc_caf_attr_tval=value),
                effdt.alias("effdt"),
                *_flags(),
            )

        gender = rows(person % 3 == 0, "ATTR_GENDER", "G1", old)
        tribe = rows(
            person % 4 < 2, "ATTR_TRIBE", "T1", F.when(person % 2 == 0, old).otherwise(new)
        )
        return gender.unionByName(tribe)

    def p_person_av(self) -> DataFrame:
        person = F.col("c_custkey")
        return self.table("customer").filter(person % 33 != 0).select(
            person.alias("emplid"),
            F.make_date((1970 + person % 30).cast("int"), F.lit(6), F.lit(1)).alias("birthdate"),
            F.when(person % 50 == 0, F.lit(dt.date(1997, 3, 1))).alias("dt_of_death"),
            *_flags(),
        )


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    derived = Derived(spark, folder)
    return Warehouse(spark, lambda name: getattr(derived, name)())
