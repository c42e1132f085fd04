"""The source relations: the columns each one must offer, with their logical types.

``emplid`` may be any type that compares for equality; dates may be DATE or
TIMESTAMP. Both pass through unchanged, so day and time-of-day comparisons follow
the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

_CURRENT_ACTIVE = ", edw_curr_ind STRING, edw_actv_ind STRING"
_VERSIONED = ", edw_eff_start_date DATE, edw_eff_end_date DATE"

_DDL: dict[str, str] = {
    "r_term_rv": (
        "strm STRING, acad_career STRING, institution STRING, "
        "term_begin_dt DATE, term_end_dt DATE"
    ),
    "r_studentterm_rv": (
        "emplid STRING, strm STRING, term_descrshort STRING, acad_career STRING, "
        "degree_career STRING, institution STRING, enrollment_status STRING, "
        "primary_car_flag STRING, residency STRING, admission_res STRING, "
        "tuition_res STRING, fin_aid_fed_res STRING, acad_level_bot STRING, "
        "acad_plan STRING, tot_proj_units INT"
    ),
    "r_stdntbiodemo_rv": (
        "emplid STRING, citizenship_status STRING, citizenship_descrshort STRING, "
        "sex STRING, ipeds_race_ethnicity STRING, res_country STRING, "
        "res_state STRING, res_county STRING, res_city STRING"
    ),
    "r_acadplan_rv": (
        "acad_plan STRING, institution STRING, acad_plan_descr STRING, "
        "acad_plan_u1 STRING, acad_plan_u1_descrformal STRING, "
        "acad_plan_mau STRING, acad_plan_mau_descrformal STRING"
    ),
    "t_xlatitem_v": (
        "fieldname STRING, fieldvalue STRING, xlatshortname STRING, "
        "xlatlongname STRING, effdt DATE"
    ),
    "r_studentclass_rv": (
        "emplid STRING, strm STRING, class_nbr STRING, subject STRING, "
        "acad_career STRING, crse_career STRING, crse_id STRING, crse_code STRING, "
        "class_section STRING, unt_billing INT, crse_grade_off STRING, repeat_code STRING"
    ),
    "r_coursecatalog_rv": (
        "crse_id STRING, subject STRING, crse_code STRING, crse_effdt DATE, "
        "crse_effdt_end DATE, crse_eff_status STRING, course_title_long STRING, "
        "acad_org_mau STRING, acad_org_mau_descrformal STRING, "
        "acad_org_u1 STRING, acad_org_u1_descrformal STRING"
    ),
    "r_classschedule_rv": (
        "strm STRING, class_nbr STRING, subject STRING, crse_code STRING, "
        "class_section STRING, section_id STRING, session_code STRING, "
        "location STRING, class_type STRING, class_type_xlatlongname STRING, "
        "class_stat STRING"
    ),
    "r_termsession_rv": (
        "strm STRING, acad_career STRING, session_code STRING, "
        "sess_begin_dt DATE, sess_end_dt DATE"
    ),
    "p_citizenship_av": (
        "emplid STRING, country STRING, citizenship_status STRING" + _CURRENT_ACTIVE
    ),
    "s_citizen_sts_tbl_av": (
        "country STRING, citizenship_status STRING, descr STRING" + _CURRENT_ACTIVE
    ),
    "p_ethnicity_dtl_av": (
        "emplid STRING, ethnic_grp_cd STRING, hisp_latino STRING" + _CURRENT_ACTIVE
    ),
    "s_ethnic_grp_tbl_av": (
        "ethnic_grp_cd STRING, setid STRING, ethnic_group STRING, effdt DATE"
        + _CURRENT_ACTIVE
    ),
    "t_xlattable_vw_av": (
        "fieldname STRING, fieldvalue STRING, eff_status STRING, xlatlongname STRING"
        + _CURRENT_ACTIVE
    ),
    "p_stdnt_car_term_av": (
        "emplid STRING, strm STRING, acad_career STRING, billing_career STRING, "
        "institution STRING, elig_to_enroll STRING, withdraw_code STRING"
        + _VERSIONED
        + _CURRENT_ACTIVE
    ),
    "p_pers_data_effdt_av": "emplid STRING, effdt DATE, sex STRING" + _CURRENT_ACTIVE,
    "p_names_av": (
        "emplid STRING, name_type STRING, effdt DATE, last_name STRING, "
        "first_name STRING, middle_name STRING, name_suffix STRING" + _CURRENT_ACTIVE
    ),
    "p_scc_caf_persbio_av": (
        "emplid STRING, scc_caf_attrib_nm STRING, scc_caf_attr_tval STRING, effdt DATE"
        + _CURRENT_ACTIVE
    ),
    "p_person_av": "emplid STRING, birthdate DATE, dt_of_death DATE" + _CURRENT_ACTIVE,
    "p_residency_off_av": (
        "emplid STRING, acad_career STRING, institution STRING, effective_term STRING, "
        "residency STRING, admission_res STRING, tuition_res STRING, "
        "fin_aid_fed_res STRING, city STRING, state STRING, county STRING, country STRING"
        + _VERSIONED
        + _CURRENT_ACTIVE
    ),
    "p_residency_off_v": "emplid STRING, acad_career STRING, effective_term STRING",
    "p_stdnt_enrl_av": (
        "emplid STRING, strm STRING, acad_career STRING, institution STRING, "
        "class_nbr STRING, unt_taken INT, unt_billing INT, stdnt_enrl_status STRING"
        + _VERSIONED
    ),
    "s_acad_car_tbl_v": (
        "institution STRING, acad_career STRING, fa_primacy_nbr INT, effdt DATE"
    ),
}

_TYPES = {"STRING": T.StringType(), "DATE": T.DateType(), "INT": T.IntegerType()}


def _schema(ddl: str) -> T.StructType:
    columns = (column.split() for column in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


SCHEMAS: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}
