"""Publish a frame to a table: map its types, check its values, replace or append."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslake.session import kept
from campuslake.sinks.versions import VersionedSink

# Fixed values
TEXT_LENGTH = 255
TEXT, MOMENT, REAL, WHOLE = f"VARCHAR({TEXT_LENGTH})", "TIMESTAMP_NTZ", "DOUBLE", "INT"

BATCH_ROWS = 10_000
COLUMN_TYPES = "createTableColumnTypes"
INT_RANGE = (-(2**31), 2**31 - 1)


def sink_type(data_type: T.DataType) -> str | None:
    """The destination's column type, or None where the writer's default holds."""
    if isinstance(data_type, T.StringType):
        return TEXT
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return MOMENT
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return REAL
    if isinstance(data_type, T.IntegralType):
        return WHOLE
    return None


def sink_columns(schema: T.StructType) -> dict[str, str]:
    """Destination type by column; unmapped columns are left out."""
    mapped = {f.name: sink_type(f.dataType) for f in schema.fields}
    return {name: kind for name, kind in mapped.items() if kind is not None}


def _fitted(column: str, kind: str) -> Column:
    """The column cast to its destination type; a value that does not fit fails the job."""
    value = F.col(f"`{column}`")
    if kind == TEXT:
        problem = F.lit(f"{column}: text longer than {TEXT_LENGTH} characters")
        too_long = F.length(value) > TEXT_LENGTH
        return F.when(too_long, F.raise_error(problem).cast("string")).otherwise(value)
    if kind == WHOLE:
        problem = F.lit(f"{column}: number outside the INT range")
        outside = ~value.between(*INT_RANGE)
        return F.when(outside, F.raise_error(problem).cast("int")).otherwise(value.cast("int"))
    return value.cast(kind)


def typed(df: DataFrame) -> DataFrame:
    """The frame with the destination's types, failing on any value that does not fit."""
    kinds = sink_columns(df.schema)
    return df.select(
        *(
            _fitted(c, kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
            for c in df.columns
        )
    )


@dataclass(frozen=True)
class TableSink:
    """A catalog table. A replace writes a table beside it, which then takes its name:
    a job that dies before leaves the old rows."""

    name: str
    format: str = "parquet"

    def write(self, df: DataFrame, mode: str) -> None:
        spark = df.sparkSession
        if mode != "overwrite" or not spark.catalog.tableExists(self.name):
            df.write.format(self.format).mode(mode).saveAsTable(self.name)
            return
        following, before = (f"{self.name}_{uuid.uuid4().hex}" for _ in range(2))
        df.write.format(self.format).saveAsTable(following)
        spark.sql(f"ALTER TABLE {self.name} RENAME TO {before}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {self.name}")
        spark.sql(f"DROP TABLE {before}")


@dataclass(frozen=True)
class PathSink:
    """A folder of files, which another writer reads as it is.

    A replace writes a folder beside it, which then takes its name. Between the two
    renames the name is free; ``VersionedSink`` has no such moment.
    """

    path: str
    format: str = "parquet"

    def write(self, df: DataFrame, mode: str) -> None:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if mode != "overwrite" or not files.exists(path):
            df.write.format(self.format).mode(mode).save(self.path)
            return
        following, before = (path.suffix(f"_{uuid.uuid4().hex}") for _ in range(2))
        df.write.format(self.format).save(following.toString())
        for source, target in ((path, before), (following, path)):
            if not files.rename(source, target):
                raise OSError(f"{source.toString()} can't be renamed to {target.toString()}")
        files.delete(before, True)


@dataclass(frozen=True)
class JdbcSink:
    """A database table; executors insert their partitions in batches.

    ``connections`` bounds the partitions written at once. Text columns get the type of the
    database's dialect, which keeps national characters, unless ``text`` names another.
    """

    url: str
    table: str
    connections: int
    options: Mapping[str, str] = field(default_factory=dict)
    text: str | None = None

    def writer_options(self, schema: T.StructType) -> dict[str, str]:
        kinds = {c: self.text if k == TEXT else k for c, k in sink_columns(schema).items()}
        columns = ", ".join(f"`{c}` {k}" for c, k in kinds.items() if k)
        return {
            "batchsize": str(BATCH_ROWS),
            **({COLUMN_TYPES: columns} if columns else {}),
            **self.options,
            "numPartitions": str(self.connections),
            "url": self.url,
            "dbtable": self.table,
        }

    def write(self, df: DataFrame, mode: str) -> None:
        options = self.writer_options(df.schema)
        if COLUMN_TYPES in options:
            # a replace drops the table before Spark reads these types: read them now
            T.StructType.fromDDL(options[COLUMN_TYPES])
        df.write.format("jdbc").options(**options).mode(mode).save()


Sink = TableSink | PathSink | VersionedSink | JdbcSink


def replace(df: DataFrame, sink: Sink) -> None:
    """Make the frame the whole content of the destination."""
    _publish(df, sink, "overwrite")


def append(df: DataFrame, sink: Sink) -> None:
    """Add the frame's rows to the destination."""
    _publish(df, sink, "append")


def _publish(df: DataFrame, sink: Sink, mode: str) -> None:
    """Compute and check the typed frame once in the shared folder, then write it.

    The destination is touched only after every value has passed, and a frame that
    was read from the destination can replace it. The staged files go when it is written.
    """
    with kept(typed(df)) as staged:
        sink.write(staged, mode)
