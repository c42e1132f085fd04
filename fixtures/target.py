"""A folder that stands in for a database with a staging table and a ledger."""

from __future__ import annotations

import os
import pickle
import shutil
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from campuslake.session import materialized

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class FolderTarget:
    """Rows of an attempt are a file; the ledger has a file for each batch with the files it added.

    The folder is one that the driver and all executors share, by its path or ``file:`` address.
    """

    path: str

    def __post_init__(self) -> None:
        address = urlsplit(self.path)
        if address.scheme not in ("", "file"):
            raise ValueError(f"{self.path}: a folder of files has a path or a file: address")
        if address.scheme:
            object.__setattr__(self, "path", unquote(address.path))

    def _folder(self, *names: str) -> str:
        folder = os.path.join(self.path, *names)
        os.makedirs(folder, exist_ok=True)
        return folder

    def published(self, batch: str) -> bool:
        return os.path.exists(os.path.join(self.path, "ledger", batch))

    def stage(self, batch: str, attempt: str, columns: Sequence[str], chunks: Iterator[list[tuple]]) -> int:
        rows = [row for chunk in chunks for row in chunk]
        with open(os.path.join(self._folder("staged", batch), attempt), "wb") as out:
            pickle.dump((list(columns), rows), out)
        with open(os.path.join(self._folder("log"), attempt), "w"):
            return len(rows)

    def publish(self, batch: str, attempts: Sequence[str], columns: Sequence[str], replace: bool) -> None:
        rows = self._folder("rows")
        if replace:
            shutil.rmtree(rows)
            self._folder("rows")
        for attempt in attempts:
            os.rename(os.path.join(self._folder("staged", batch), attempt), os.path.join(rows, f"{batch}-{attempt}"))
        with open(os.path.join(self._folder("ledger"), batch), "x"):
            pass

    def discard(self, batch: str) -> None:
        shutil.rmtree(os.path.join(self.path, "staged", batch), ignore_errors=True)

    @property
    def staged_attempts(self) -> int:
        return len(os.listdir(self._folder("log")))

    def leftovers(self) -> list[str]:
        return os.listdir(self._folder("staged"))

    def read(self, spark: SparkSession, schema: str | None = None) -> DataFrame:
        """The published rows."""
        columns, rows = [], []
        for name in sorted(os.listdir(self._folder("rows"))):
            with open(os.path.join(self.path, "rows", name), "rb") as source:
                columns, own = pickle.load(source)
                rows += own
        return materialized(spark.createDataFrame(rows, schema or columns))
