"""Where the source relations come from: Parquet, catalog tables, JDBC or views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField

from campuslake.sources.relations import SCHEMAS
from campuslake.sources.splits import cut_query, predicates

TERM_CODES = {"strm", "effective_term"}
# Calendars and code lists: one task may read them.
SMALL = {
    "r_term_rv", "r_termsession_rv", "r_acadplan_rv", "t_xlatitem_v", "t_xlattable_vw_av",
    "s_citizen_sts_tbl_av", "s_ethnic_grp_tbl_av", "s_acad_car_tbl_v",
}
INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


@dataclass(frozen=True)
class Warehouse:
    """Gives each relation as a lazy DataFrame with lower-case declared columns."""

    spark: SparkSession
    load: Callable[[str], DataFrame]

    def __getitem__(self, relation: str) -> DataFrame:
        if relation not in SCHEMAS:
            raise KeyError(f"unknown relation {relation!r}")
        found = self.load(relation)
        kinds = {f.name.lower(): f.dataType for f in found.schema}
        lacking = [f.name for f in SCHEMAS[relation] if f.name not in kinds]
        if lacking:
            raise ValueError(f"{relation} lacks the columns {lacking}")
        return found.select(*(_declared(f, kinds[f.name]) for f in SCHEMAS[relation]))

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Warehouse:
        return cls(spark, frames.__getitem__)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Warehouse:
        """One Parquet dataset per relation; partition the term facts by ``strm``."""
        return cls(spark, lambda name: _with_text_partitions(spark, f"{folder}/{name}"))

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str) -> Warehouse:
        return cls(spark, lambda name: spark.read.table(f"{database}.{name}"))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        schema: str,
        options: Mapping[str, str] | None = None,
        partitioning: Mapping[str, Mapping[str, str]] | None = None,
        splits: Mapping[str, tuple[str, int]] | None = None,
    ) -> Warehouse:
        """Read a live database; filters and columns are pushed to it.

        ``splits`` names, per relation, a key and a number of parts: the database tells the key's
        quantiles, and each task reads one run of keys, text or not. ``partitioning`` gives the
        ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` by hand
        instead. Relations that grow with students or classes need one of the two.
        """

        def load(name: str) -> DataFrame:
            if name not in (splits or {}):
                found = jdbc_options(url, schema, name, options, partitioning)
                return spark.read.format("jdbc").options(**found).load()
            key, parts = splits[name]
            asked = {**jdbc_options(url, schema, name, options, {name: {}})}
            table = asked.pop("dbtable")
            query = f"({cut_query(table, key, parts)}) cuts"
            cuts = spark.read.format("jdbc").options(**asked, dbtable=query).load()
            read = predicates(key, [row[0] for row in cuts.collect()])  # one row a part
            del asked["url"]
            return spark.read.jdbc(url, table, predicates=read, properties=asked)

        return cls(spark, load)

    def register_views(self) -> None:
        """Offer every relation to ``spark.sql(query, args={...})`` by its own name."""
        for name in SCHEMAS:
            self[name].createOrReplaceTempView(name)


def _declared(field: StructField, kind: DataType) -> Column | str:
    """The column under its declared name; term codes as text, which they compare as.

    A partition value, read as text, gets its declared type.
    """
    name = field.name
    if name in TERM_CODES:
        return F.col(name).cast("string").alias(name)
    if isinstance(kind, StringType) and not isinstance(field.dataType, StringType):
        return F.col(name).cast(field.dataType).alias(name)
    return name


def _with_text_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset whose partition folder names stay text: ``0998`` is no number."""
    before = spark.conf.get(INFERENCE)
    spark.conf.set(INFERENCE, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(INFERENCE, before)


def jdbc_options(
    url: str,
    schema: str,
    relation: str,
    options: Mapping[str, str] | None = None,
    partitioning: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, str]:
    split = (partitioning or {}).get(relation)
    if split is None and relation not in SMALL:
        raise ValueError(f"{relation}: give its partitioning; numPartitions 1 reads it in one task")
    return {
        "fetchsize": "10000",
        **(options or {}),
        **(split or {}),
        "url": url,
        "dbtable": f"{schema}.{relation}",
    }
