"""Race and ethnicity detail, federal category and biographic profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.functions.expressions import (
    HOME_COUNTRY,
    AsOf,
    deceased_flag,
    display_name,
    federal_category,
    is_international,
    moment,
    preferred_first_name,
)
from campuslake.operators.effective import current_active, first_by, latest_row, not_future
from campuslake.operators.relational import join_completed, left_join_spread, spread_join
from campuslake.session import materialized

# Fixed values
ETHNIC_FIELD = "ETHNIC_GROUP"
PREFERRED, LEGAL = "PRF", "PRI"

RACE_COLUMNS = (
    "emplid hisp_latino country citizenship_status setid ethnic_group "
    "xlatlongname citizenship_descrshort"
).split()

CATEGORY_COLUMNS = (
    "emplid citizenship_status citizenship_descrshort country hisp_latino Intl "
    "xlatlongname ipeds_race_ethnicity"
).split()

NAME_PARTS = ("last_name", "first_name", "middle_name", "name_suffix")

# What makes a profile, and the columns each role brings to it.
ROLES = {
    "personal": {"sex": "sex"},
    "preferred": {c: f"preferred_{c}" for c in NAME_PARTS},
    "legal": {c: f"legal_{c}" for c in NAME_PARTS},
    "gender": {"scc_caf_attr_tval": "gender_pref"},
    "tribe": {"scc_caf_attr_tval": "tribal_affiliation"},
}
ATTRIBUTES = ("gender", "tribe", "attribute")

PROFILE_COLUMNS = (
    "emplid university_name university_first_name university_middle_name "
    "university_last_name name_suffix birthdate sex gender_pref dt_of_death "
    "deceased_flag tribal_affiliation res_city res_country res_county res_state"
).split()


def enrolled_persons(career_terms: DataFrame, term: Column) -> DataFrame:
    """The distinct persons with an active career in the term."""
    return current_active(career_terms).filter(F.col("strm") == term).select("emplid").distinct()


def home_citizenships(citizenship: DataFrame, statuses: DataFrame) -> DataFrame:
    """One active home-country citizenship per person, with its description."""
    home = F.col("country") == HOME_COUNTRY
    described = first_by(
        current_active(statuses).filter(home),
        ["citizenship_status"],
        [F.col("descr").asc_nulls_last()],
    ).select("citizenship_status", F.col("descr").alias("citizenship_descrshort"))
    chosen = first_by(
        current_active(citizenship).filter(home),
        ["emplid"],
        [F.col("citizenship_status").asc_nulls_last()],
    ).select("emplid", "country", "citizenship_status")
    return spread_join(chosen, described, "citizenship_status", "left")


def ethnic_groups(groups: DataFrame, translations: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The latest definition of each ethnic group code, with its long name."""
    names = first_by(
        current_active(translations).filter(
            (F.col("fieldname") == ETHNIC_FIELD) & (F.col("eff_status") == "A")
        ),
        ["fieldvalue"],
        [F.col("xlatlongname").asc_nulls_last()],
    ).select(F.col("fieldvalue").alias("ethnic_group"), "xlatlongname")
    latest = latest_row(
        not_future(current_active(groups), "effdt", as_of),
        ["ethnic_grp_cd"],
        "effdt",
        ["setid", "ethnic_group"],
    ).select("ethnic_grp_cd", "setid", "ethnic_group")
    return latest.join(names, "ethnic_group", "left")


def race_detail(
    citizenship: DataFrame,
    statuses: DataFrame,
    ethnicities: DataFrame,
    groups: DataFrame,
    translations: DataFrame,
    career_terms: DataFrame,
    term: Column,
    as_of: AsOf = None,
) -> DataFrame:
    """Citizenship and ethnic groups of the term's students, home country only.

    One row per person and ethnic group code: the latest definition of the code,
    ties going to the lowest status, set, group, name and Hispanic flag. Each of
    these belongs to one side, so each side picks its own row before they meet, and
    reads only the persons of the term before it ranks.
    """
    enrolled = enrolled_persons(career_terms, term)
    home = home_citizenships(spread_join(citizenship, enrolled, "emplid", "left_semi"), statuses)
    details = first_by(
        current_active(spread_join(ethnicities, enrolled, "emplid", "left_semi")),
        ["emplid", "ethnic_grp_cd"],
        [F.col("hisp_latino").asc_nulls_last()],
    ).select("emplid", "ethnic_grp_cd", "hisp_latino")
    defined = spread_join(
        details, ethnic_groups(groups, translations, as_of), "ethnic_grp_cd", "left"
    )
    return home.join(defined, "emplid", "left").select(*RACE_COLUMNS)


def race_ethnicity_category(race: DataFrame) -> DataFrame:
    """The federal category of each person in the race detail.

    The detail gives a person one citizenship, so the person's groups are counted
    in the same pass: distinct groups among the non-Hispanic home-set rows, an
    unknown group counting as one.
    """
    keys = ["emplid", "citizenship_status", "citizenship_descrshort", "country"]
    status, country = F.col("citizenship_status"), F.col("country")
    counted = (F.col("hisp_latino") == "N") & (F.col("setid") == HOME_COUNTRY)
    persons = (
        race.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.max("hisp_latino").alias("hisp_latino"),
            F.count_distinct(F.when(counted, F.struct("ethnic_group"))).alias("groups"),
            F.max(F.when(counted, F.col("xlatlongname"))).alias("group_name"),
        )
    )
    sole_name = F.when(F.col("groups") == 1, F.col("group_name"))
    return (
        persons.withColumn(
            "Intl", F.when(is_international(status, country), "Y").otherwise("N")
        )
        .withColumn("xlatlongname", sole_name)
        .withColumn(
            "ipeds_race_ethnicity",
            federal_category(
                status, country, F.col("hisp_latino"), F.col("groups"), F.col("xlatlongname")
            ),
        )
        .select(*CATEGORY_COLUMNS)
    )


def official_residency(residencies: DataFrame, all_residencies: DataFrame) -> DataFrame:
    """One address per person: the earliest term's, of the last career by code.

    The earliest term is taken over all residency rows, active or not.
    """
    earliest = all_residencies.groupBy("emplid", "acad_career").agg(
        F.min("effective_term").alias("_first_term")
    )
    held = spread_join(
        current_active(residencies), earliest, ["emplid", "acad_career"], "left"
    ).filter(
        F.col("effective_term").isNull() | (F.col("effective_term") == F.col("_first_term"))
    )
    address = ["city", "state", "county", "country"]
    return first_by(
        held,
        ["emplid"],
        [
            F.col("acad_career").desc_nulls_first(),
            F.col("institution").asc_nulls_last(),
            *(F.col(c).asc_nulls_last() for c in address),
        ],
    ).select("emplid", "acad_career", *address)


def names_of_type(names: DataFrame, name_type: str, prefix: str) -> DataFrame:
    return names.filter(F.col("name_type") == name_type).select(
        "emplid",
        F.col("effdt").alias("name_effdt"),
        *(F.col(c).alias(f"{prefix}_{c}") for c in NAME_PARTS),
    )


def attribute(attributes: DataFrame, attribute_name: str, alias: str) -> DataFrame:
    """One named attribute of an attribute-value table as a column."""
    return attributes.filter(F.col("scc_caf_attrib_nm") == attribute_name).select(
        "emplid",
        F.col("effdt").alias("attribute_effdt"),
        F.col("scc_caf_attr_tval").alias(alias),
    )


def profile_rows(
    personal: DataFrame,
    names: DataFrame,
    attributes: DataFrame,
    roster: DataFrame,
    gender_attribute: str,
    tribe_attribute: str,
) -> DataFrame:
    """The active rows that make the profiles of the roster's students, each under its role.

    Attributes of other names are there for their dates only.
    """
    kind, name = F.col("name_type"), F.col("scc_caf_attrib_nm")
    picked = F.array_compact(
        F.array(F.when(name == gender_attribute, "gender"), F.when(name == tribe_attribute, "tribe"))
    )
    roles = F.when(F.size(picked) > 0, picked).otherwise(F.array(F.lit("attribute")))
    parts = (
        current_active(personal).select("emplid", F.lit("personal").alias("role"), "effdt", "sex"),
        current_active(names)
        .filter(kind.isin(PREFERRED, LEGAL))
        .select(
            "emplid", F.when(kind == PREFERRED, "preferred").otherwise("legal").alias("role"),
            "effdt", *NAME_PARTS,
        ),
        current_active(attributes).select(
            "emplid", F.explode(roles).alias("role"), "effdt", "scc_caf_attr_tval"
        ),
    )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return spread_join(every, roster, "emplid", "left_semi")


def profile_dates(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per student that has a profile: each role's date in force.

    A role holds by its latest date that is not in the future, or by an undated row; an
    attribute only if that date is the latest of all attributes. A student with rows of a role of
    which nothing holds has no profile, nor has one without a personal row.
    """
    date = F.col("effdt")
    reached = F.when(date <= moment(as_of), date)
    facts = [F.max(F.when(F.col("role").isin(*ATTRIBUTES), reached)).alias("_attribute_date")]
    for role in ROLES:
        own = F.col("role") == role
        facts += [
            F.max(F.when(own, reached)).alias(f"{role}_date"),
            F.bool_or(own).alias(f"{role}_known"),
            F.bool_or(own & date.isNull()).alias(f"{role}_undated"),
        ]
    dates = rows.groupBy("emplid").agg(*facts).filter("personal_known")
    for role in ROLES:
        own = F.col(f"{role}_date")
        if role in ATTRIBUTES:
            dates = dates.withColumn(f"{role}_date", F.when(own == F.col("_attribute_date"), own))
        held = F.col(f"{role}_date").isNotNull() | F.col(f"{role}_undated")
        dates = dates.filter(~F.col(f"{role}_known") | held)
    return dates.select("emplid", *(f"{role}_date" for role in ROLES))


def profile_parts(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """The rows in force of all roles: at their role's date, or undated. Ties stay."""
    due = F.coalesce(*(F.when(F.col("role") == r, F.col(f"{r}_date")) for r in ROLES))
    wanted = rows.filter(F.col("role").isin(*ROLES))
    met = spread_join(wanted, dates, "emplid")
    return met.filter(F.col("effdt").isNull() | (F.col("effdt") == due)).select(*rows.columns).drop("effdt")


def profiles(parts: DataFrame) -> DataFrame:
    """One row per student; a student with several rows of a role has their products.

    Most students have one row of a role at most, and are put together by an aggregate
    without a join. Those with ties, known by their counts, are joined role by role.
    """
    role = F.col("role")
    facts = []
    for name, columns in ROLES.items():
        facts.append(F.count(F.when(role == name, 1)).alias(f"{name}_rows"))
        facts.append(F.max(F.when(role == name, F.struct(*columns))).alias(name))
    whole = parts.groupBy("emplid").agg(*facts)
    most = F.greatest(*(f"{name}_rows" for name in ROLES))
    brought = [F.col(name)[c].alias(a) for name, columns in ROLES.items() for c, a in columns.items()]
    sole = whole.filter(most == 1).select("emplid", *brought)
    tied = whole.filter(most > 1).select("emplid", *(f"{name}_rows" for name in ROLES))
    apart = spread_join(parts, tied.select("emplid"), "emplid", "left_semi")
    product = None
    for name, columns in ROLES.items():
        own = apart.filter(role == name).select("emplid", *(F.col(c).alias(a) for c, a in columns.items()))
        if product is None:
            product = own
        else:
            absent = tied.filter(f"{name}_rows = 0").select("emplid")
            product = join_completed(product, own, absent, "emplid")
    return sole.unionByName(product)


def bio_demographics(
    personal: DataFrame,
    names: DataFrame,
    attributes: DataFrame,
    persons: DataFrame,
    residencies: DataFrame,
    all_residencies: DataFrame,
    career_terms: DataFrame,
    gender_attribute: str,
    tribe_attribute: str,
    term: Column,
    as_of: AsOf = None,
) -> DataFrame:
    """The profile of every active student of the term.

    All histories are cut down to the term's students before anything is grouped. Names, attributes and
    personal rows go through one pass for the dates in force and one for the rows of
    all roles at these dates. The students and the rows in force are written once when this is called.
    """
    roster = materialized(enrolled_persons(career_terms, term))
    rows = profile_rows(personal, names, attributes, roster, gender_attribute, tribe_attribute)
    parts = materialized(profile_parts(rows, profile_dates(rows, as_of)))
    life = current_active(persons).select("emplid", "birthdate", "dt_of_death")
    home = official_residency(
        spread_join(residencies, roster, "emplid", "left_semi"),
        spread_join(all_residencies, roster, "emplid", "left_semi"),
    ).select(
        "emplid", *(F.col(c).alias(f"res_{c}") for c in ("city", "country", "county", "state"))
    )
    first = preferred_first_name(F.col("preferred_first_name"), F.col("legal_first_name"))
    lived = left_join_spread(profiles(parts), roster, life, "emplid")
    return (
        spread_join(lived, home, "emplid", "left")
        .withColumn("university_first_name", first)
        .withColumn(
            "university_name",
            display_name(
                F.col("legal_last_name"), F.col("university_first_name"), F.col("legal_middle_name")
            ),
        )
        .withColumn("deceased_flag", deceased_flag(F.col("dt_of_death")))
        .withColumnsRenamed(
            {
                "legal_middle_name": "university_middle_name",
                "legal_last_name": "university_last_name",
                "legal_name_suffix": "name_suffix",
            }
        )
        .select(*PROFILE_COLUMNS)
    )
