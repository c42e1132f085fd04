"""Bulk insert that may be repeated: staged attempts, and a ledger of what was committed."""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from campuslake.session import kept
from campuslake.sinks.publish import sink_columns, typed

# Tasks and the commit run in Python workers, which need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 10_000


class BulkTarget(Protocol):
    """A destination with a place for staged rows and a ledger of published batches."""

    def published(self, batch: str) -> bool:
        """Whether the batch is in the ledger."""

    def stage(self, batch: str, attempt: str, columns: Sequence[str], chunks: Iterator[list[tuple]]) -> int:
        """Insert an attempt's rows beside the destination; how many they were."""

    def publish(self, batch: str, attempts: Sequence[str], columns: Sequence[str], replace: bool) -> None:
        """In one step: fill the destination from these attempts and enter the batch."""

    def discard(self, batch: str) -> None:
        """Delete whatever is staged for the batch."""


@dataclass(frozen=True)
class SqlTarget:
    """A database table, its staging table and its ledger, over a DB-API connection.

    ``connect`` opens a connection; it runs on executors too. ``<table>_staged`` has the
    destination's columns behind ``batch_id`` and ``attempt_id``, and ``<table>_batches`` the
    ``batch_id`` as its key: ``definitions`` gives their statements. ``mark`` is the driver's parameter mark.
    """

    connect: Callable[[], Any]
    table: str
    mark: str = "?"

    def definitions(self, schema: StructType) -> list[str]:
        """Statements that make the staging table and the ledger for typed frames of the schema."""
        kinds = sink_columns(schema)
        own = ", ".join(f"{f.name} {kinds.get(f.name, f.dataType.simpleString())}" for f in schema.fields)
        return [
            f"CREATE TABLE {self.table}_staged (batch_id VARCHAR(64), attempt_id VARCHAR(64), {own})",
            f"CREATE TABLE {self.table}_batches (batch_id VARCHAR(64) PRIMARY KEY)",
        ]

    def _run(self, *steps: tuple[str, Sequence[Any]]) -> list[tuple]:
        """The statements in one transaction, and what the last one returns."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement, values in steps:
                cursor.execute(statement, values)
            rows = cursor.fetchall() if steps[-1][0].startswith("SELECT") else []
            connection.commit()
            return rows
        finally:
            connection.close()  # what is not committed is rolled back

    def published(self, batch: str) -> bool:
        query = f"SELECT batch_id FROM {self.table}_batches WHERE batch_id = {self.mark}"
        return bool(self._run((query, [batch])))

    def stage(self, batch: str, attempt: str, columns: Sequence[str], chunks: Iterator[list[tuple]]) -> int:
        marks = ", ".join([self.mark] * (len(columns) + 2))
        names = ", ".join(["batch_id", "attempt_id", *columns])
        statement = f"INSERT INTO {self.table}_staged ({names}) VALUES ({marks})"
        connection, rows = self.connect(), 0
        try:
            cursor = connection.cursor()
            for chunk in chunks:
                cursor.executemany(statement, [(batch, attempt, *row) for row in chunk])
                rows += len(chunk)
            connection.commit()
        finally:
            connection.close()
        return rows

    def publish(self, batch: str, attempts: Sequence[str], columns: Sequence[str], replace: bool) -> None:
        names, mark = ", ".join(columns), self.mark
        # the key of the ledger lets only one of two runs of a batch pass
        steps = [(f"INSERT INTO {self.table}_batches (batch_id) VALUES ({mark})", [batch])]
        if replace:
            steps.append((f"DELETE FROM {self.table}", []))
        fill = (
            f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.table}_staged "
            f"WHERE batch_id = {mark} AND attempt_id = {mark}"
        )
        self._run(*steps, *((fill, [batch, attempt]) for attempt in attempts))

    def discard(self, batch: str) -> None:
        self._run((f"DELETE FROM {self.table}_staged WHERE batch_id = {self.mark}", [batch]))


@dataclass
class _Staged(WriterCommitMessage):
    attempt: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, target: BulkTarget, batch: str, columns: list[str], replace: bool):
        self.target, self.batch, self.columns, self.replace = target, batch, columns, replace

    def write(self, iterator) -> _Staged:
        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{uuid.uuid4().hex}"

        def chunks() -> Iterator[list[tuple]]:
            for batch in iterator:
                for start in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(start, CHUNK)
                    yield list(zip(*(c.to_pylist() for c in part.columns), strict=True))

        return _Staged(attempt, self.target.stage(self.batch, attempt, self.columns, chunks()))

    def commit(self, messages) -> None:
        attempts = [m.attempt for m in messages if m is not None and m.rows]
        self.target.publish(self.batch, attempts, self.columns, self.replace)

    def abort(self, messages) -> None:
        self.target.discard(self.batch)


def _source(target: BulkTarget, batch: str, replace: bool) -> type[DataSource]:
    """A data source that writes one batch to the target."""

    class Bulk(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"bulk_{batch}"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
            return _Writer(target, batch, schema.names, replace)

    return Bulk


def bulk_insert(
    df: DataFrame, target: BulkTarget, batch: str, connections: int, replace: bool = False
) -> bool:
    """Insert the frame's rows once, however often tasks or the whole call are repeated.

    ``batch`` names the publication: one that is in the ledger is not inserted again, and
    the result tells whether this call inserted it. Every task attempt stages its rows under
    a name of its own; the destination is filled, in one transaction, from the attempts that
    Spark committed. Rows of failed attempts and of runs that died are never read, and go
    with the batch. Values are checked before anything is staged. ``replace`` empties the destination within the
    transaction: its old rows stand until the new ones do. At most ``connections`` tasks write.
    """
    if not batch.isidentifier():
        raise ValueError(f"{batch!r}: name the batch by letters, digits and underscores")
    if target.published(batch):
        return False
    target.discard(batch)  # what a run that died has staged
    source = _source(target, batch, replace)
    spark = df.sparkSession
    spark.dataSource.register(source)
    with kept(typed(df)) as staged:
        staged.coalesce(connections).write.format(source.name()).mode("append").save()
    target.discard(batch)
    return True


def batch_of(day: dt.date | str, name: str) -> str:
    """The name of a daily publication."""
    return f"{name}_{str(day).replace('-', '')}"
