"""Small random source relations full of ties, copies, nulls and missing partners."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from campuslake import Warehouse
from campuslake.sources.relations import SCHEMAS
from fixtures.parameters import GENDER, TERM, TRIBE

TERMS = ["19974", "19981", "19982", TERM, "19984"]
CAREERS = ["UGRD", "GRAD", "PROF"]
YES = ["Y", "Y", "Y", "N"]

# Value pools by column; a column not listed holds two short codes.
POOLS = {
    "emplid": [f"p{i}" for i in range(40)],
    "strm": TERMS,
    "effective_term": [*TERMS, None],
    "acad_career": CAREERS,
    "billing_career": [*CAREERS, *CAREERS, "NONE", None],
    "crse_career": CAREERS,
    "institution": ["I0", "I0", "I0", "I1"],
    "enrollment_status": ["C", "E", "W", "N", None],
    "primary_car_flag": YES,
    "edw_curr_ind": YES,
    "edw_actv_ind": YES,
    "elig_to_enroll": ["Y", "Y", "Y", "N", None],
    "withdraw_code": ["WDR", "NWD", None],
    "stdnt_enrl_status": ["E", "E", "D"],
    "country": ["USA", "USA", "CAN"],
    "citizenship_status": ["1", "2", "4", None],
    "hisp_latino": ["N", "N", "Y", None],
    "setid": ["USA", "USA", "CAN"],
    "ethnic_grp_cd": ["E1", "E2", "E3", "E4", None],
    "ethnic_group": ["1", "2", None],
    "fieldname": ["ACADEMIC_LEVEL", "ETHNIC_GROUP", "ETHNIC_GROUP", "OTHER"],
    "fieldvalue": ["1", "2", "3"],
    "acad_level_bot": ["1", "2", "3", None],
    "acad_plan": [f"P{i}" for i in range(8)],
    "eff_status": ["A", "A", "I"],
    "name_type": ["PRF", "PRI"],
    "first_name": ["Ann", "Bo", " ", None],
    "last_name": ["Ash", "Birch", None],
    "middle_name": ["M", None],
    "scc_caf_attrib_nm": [GENDER, TRIBE, "OTHER"],
    "class_stat": ["A", "A", "X"],
    "class_nbr": [f"c{i}" for i in range(12)],
    "crse_id": ["k1", "k2", "k3"],
    "subject": ["S"],
    "crse_code": ["K1", "K2"],
    "class_section": ["1", "2"],
    "session_code": ["1", "2"],
    "tuition_res": ["RES", "RES", "NRES", None],
    "dt_of_death": [dt.date(1997, 3, 1), None, None],
}
DATES = [dt.date(y, m, 1) for y in (1996, 1997, 1998, 1999) for m in (1, 6)]

ROWS = {
    "r_studentterm_rv": 500,
    "r_studentclass_rv": 800,
    "p_stdnt_enrl_av": 700,
    "p_stdnt_car_term_av": 400,
    "p_residency_off_av": 700,
    "r_coursecatalog_rv": 25,
    "r_classschedule_rv": 300,
    "r_acadplan_rv": 12,
    "s_acad_car_tbl_v": 6,
    "t_xlatitem_v": 14,
    "t_xlattable_vw_av": 12,
    "s_ethnic_grp_tbl_av": 14,
    "r_stdntbiodemo_rv": 40,
    "p_citizenship_av": 80,
    "p_ethnicity_dtl_av": 80,
    "p_person_av": 40,
    "p_names_av": 90,
    "p_scc_caf_persbio_av": 80,
    "p_pers_data_effdt_av": 80,
}


def _value(rng: random.Random, relation: str, field: T.StructField):
    name = field.name
    if name == "edw_eff_start_date":
        return dt.date(1998, rng.choice([1, 1, 1, 9]), 1)
    if name == "edw_eff_end_date":
        return rng.choice([dt.date(9999, 12, 31)] * 3 + [dt.date(1998, 8, 15), dt.date(1998, 8, 1)])
    if name == "effdt" and relation == "p_names_av":
        return rng.choice([*DATES, dt.date(2024, 1, 2), dt.date(2024, 1, 9)])
    if name in POOLS:
        return rng.choice(POOLS[name])
    if isinstance(field.dataType, T.DateType):
        return rng.choice([*DATES, None] if name == "effdt" else DATES)
    if isinstance(field.dataType, T.IntegerType):
        return rng.choice([1, 2, 3, 4, None])
    return rng.choice([f"{name}1", f"{name}2", None])


def _rows(rng: random.Random, relation: str) -> list[tuple]:
    fields = SCHEMAS[relation].fields
    size = ROWS.get(relation, 30)
    rows = [tuple(_value(rng, relation, f) for f in fields) for _ in range(size)]
    return rows + rng.choices(rows, k=size // 20)  # some exact copies


def frames(spark: SparkSession, con: duckdb.DuckDBPyConnection, seed: int) -> Warehouse:
    """The same relations as DataFrames and as tables of the connection."""
    rng = random.Random(seed)
    made = {}
    for name, schema in SCHEMAS.items():
        rows = _rows(rng, name)
        if name == "r_term_rv":  # one row per institution, career and term
            rows = list({r[:3]: r for r in rows}.values())
        made[name] = spark.createDataFrame(rows, schema)
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields
        )
        con.execute(f"CREATE OR REPLACE TABLE {name} ({columns})")
        marks = ", ".join("?" * len(schema.fields))
        con.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    return Warehouse.from_frames(spark, made)
