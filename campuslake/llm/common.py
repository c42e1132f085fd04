"""Helpers shared by the operators: written tables, sizes, hashing of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslake.session import materialized

__all__ = ["materialized"]

WORD = r"[^\x20\x09-\x0D]+"

# A side is broadcast only when its counted rows, all of fixed width, stay below this.
BROADCAST_BYTES = 16 << 20

# Python tasks work on slices of about so many bytes of text.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(20240607)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E6C63D0876A68A3)
_PLACES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """The rows no model may learn from: one fifth, by the checksum of the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def sized(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written frame of fixed-width rows, marked for broadcast if its counted size allows."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text; one long text is a slice of its own."""
    ends = np.cumsum(text_lengths(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and where each text ends (null: empty)."""
    joined = "".join(x for x in column.to_pylist() if x).encode()
    return np.frombuffer(joined, np.uint8), np.cumsum(text_lengths(column))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lowered) of all texts, and each text's end among them."""
    raw, ends = text_bytes(column)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    inside = ~_SPACE[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    borders = ends[:-1][ends[:-1] < len(raw)]
    opens[borders] = inside[borders]
    counted = np.cumsum(opens)
    per_text = np.where(ends > 0, counted[np.maximum(ends, 1) - 1], 0)
    starts = np.flatnonzero(opens[inside])
    kept = _LOWER[raw[inside]]
    if not len(starts):
        return np.zeros(0, np.uint64), per_text
    lengths = np.diff(np.append(starts, len(kept)))
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64), dtype=np.uint64)
        sums = np.add.reduceat(_BYTES[kept] * powers[place], starts)
        return mix(sums + lengths.astype(np.uint64)), per_text


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text, as 64-bit hashes.

    A text of fewer words has its whole sequence as its one shingle, one without words none.
    """
    words, ends = word_hashes(column)
    places = _PLACES[:n] if n <= len(_PLACES) else np.resize(_PLACES, n)
    sets, start = [], 0
    with np.errstate(over="ignore"):
        for end in ends.tolist():
            own, count = words[start:end], end - start
            start = end
            k = min(n, count)
            if not k:
                sets.append(own)
                continue
            sums = np.full(count - k + 1, k, np.uint64)
            for i in range(k):
                sums += own[i : count - k + 1 + i] * places[i]
            sets.append(np.unique(mix(sums)))
    return sets
