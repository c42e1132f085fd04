"""A folder published by swap: whole versions, and a pointer that is changed last."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_POINTER = "pointer-"
# A writer that others overtake so often gives up.
ATTEMPTS = 100


@dataclass(frozen=True)
class VersionedSink:
    """Parts under ``data`` and numbered pointers under ``versions``; the highest number holds.

    A pointer names the parts that make its version. It is written under another name and
    renamed to its number, which fails if that number is taken: of two writers one goes first, and
    the other then builds on it. A job that dies leaves the version that stood; its part, which no
    pointer names, goes with the next replace. A replace keeps the parts of the version
    before it, for readers under way.
    """

    path: str

    def write(self, df: DataFrame, mode: str) -> None:
        spark, part = df.sparkSession, uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{part}")
        for _ in range(ATTEMPTS):
            number, parts = self._latest(spark)
            following = [part] if mode == "overwrite" else [*parts, part]
            if self._point(spark, number + 1, following):
                break
        else:
            raise RuntimeError(f"{self.path}: other writers were first {ATTEMPTS} times")
        if mode == "overwrite":
            self._clean(spark, {*parts, *following}, number)

    def read(self, spark: SparkSession) -> DataFrame:
        """The version that stands when this is called."""
        parts = self._latest(spark)[1]
        if not parts:
            raise FileNotFoundError(f"{self.path}: nothing is published")
        return spark.read.parquet(*(f"{self.path}/data/{p}" for p in parts))

    def _files(self, spark: SparkSession, folder: str):
        """The file system, the folder and the names in it."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        return system, path, names

    def _latest(self, spark: SparkSession) -> tuple[int, list[str]]:
        _, path, names = self._files(spark, "versions")
        numbers = [int(n.removeprefix(_POINTER)) for n in names if n.startswith(_POINTER)]
        if not numbers:
            return 0, []
        lines = spark.read.text(f"{path}/{_POINTER}{max(numbers):020d}").collect()
        return max(numbers), json.loads(lines[0].value)

    def _point(self, spark: SparkSession, number: int, parts: list[str]) -> bool:
        system, path, _ = self._files(spark, "versions")
        hadoop = spark._jvm.org.apache.hadoop.fs
        written = hadoop.Path(path, f"_{uuid.uuid4().hex}")
        stream = system.create(written, True)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        whole = system.makeQualified(written)
        context = hadoop.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
        no_overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            context.rename(whole, hadoop.Path(whole.getParent(), f"{_POINTER}{number:020d}"), no_overwrite)
        except Exception:
            taken = f"{_POINTER}{number:020d}" in self._files(spark, "versions")[2]
            system.delete(written, False)
            if taken:
                return False
            raise
        return True

    def _clean(self, spark: SparkSession, parts: set[str], number: int) -> None:
        """Delete what neither this version nor the one before it names."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder, kept in (
            ("data", parts),
            ("versions", {f"{_POINTER}{n:020d}" for n in (number, number + 1)}),
        ):
            system, path, names = self._files(spark, folder)
            for name in names:
                if name not in kept and (folder == "data" or name < f"{_POINTER}{number:020d}") and not name.startswith("_"):
                    system.delete(hadoop.Path(path, name), True)
