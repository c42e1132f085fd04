"""Substring dedup by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from campuslake.llm.common import materialized, slices
from campuslake.operators.relational import spread_join
from campuslake.session import scratch

MIN_SENTENCES = 2
MIN_WORDS = 20
# A sentence as long as a passage is a run of its own.
LONG_SENTENCE = 40

_BETWEEN = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")


def sentences(text: str) -> list[int]:
    """Where each sentence starts; a sentence reaches up to the next one's start.

    Sentences end at ``.``, ``!`` or ``?`` before white space, and at line breaks.
    """
    starts = [0, *(m.end() for m in _BETWEEN.finditer(text) if m.end())]
    if starts[-1] == len(text):
        starts.pop()
    return starts


def spans(words: list[int]) -> list[tuple[int, int]]:
    """The runs to compare, first and last sentence: from each sentence on, and up to each
    one, the shortest of MIN_SENTENCES and MIN_WORDS; and each long sentence."""
    total = [0]
    for n in words:
        total.append(total[-1] + n)
    found, count, last = set(), len(words), 0
    for first in range(count):
        if words[first] >= LONG_SENTENCE:
            found.add((first, first))
        last = max(last, first + MIN_SENTENCES - 1)
        while last < count and total[last + 1] - total[first] < MIN_WORDS:
            last += 1
        if last < count:
            found.add((first, last))
    first = count - MIN_SENTENCES
    for last in range(count - 1, MIN_SENTENCES - 2, -1):
        first = min(first, last - MIN_SENTENCES + 1)
        while first >= 0 and total[last + 1] - total[first] < MIN_WORDS:
            first -= 1
        if first >= 0:
            found.add((first, last))
    return sorted(found)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, removed, first_docs)`` of the documents that repeat a passage.

    Every run of several consecutive sentences is hashed (64 bits over its words, white
    space aside) and grouped over the corpus. Of a run that occurs again, the occurrence
    first by id and place stays; ``removed`` lists the sentences that any other occurrence
    covers, in order, ``first_docs`` the documents that hold the first ones. A run may
    repeat within a document.

    A document tells its own repeats, so that the corpus is asked for one occurrence of each
    document only. What is removed travels as runs; a document's runs become its
    sentences where they meet.

    Null, empty or short text has no run. Rows without an id are neither compared nor
    listed. Rows of one id don't repeat each other. Other columns are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        runs = materialized(rows.mapInArrow(_runs, "key long, doc_id long, place long, again boolean"))
        held = runs.groupBy("key").agg(
            F.min("doc_id").alias("source"), F.max("doc_id").alias("end"), F.bool_or("again").alias("again")
        )
        repeated = held.where("source <> end or again").select("key", "source")
        # Both sides are shuffled for the join: then a key with much of the corpus is split.
        gone = spread_join(runs, repeated, "key").where("again or doc_id <> source")
        lists = gone.groupBy("doc_id").agg(F.collect_list("place").alias("places"), F.collect_set("source").alias("sources"))
        return keep(lists.mapInArrow(_covered, "doc_id long, removed array<int>, first_docs array<long>"))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences that the runs of a document cover."""
    for batch in batches:
        removed = []
        for places in batch.column("places"):
            packed = places.values.to_numpy()
            first, last = packed >> 32, packed & 0xFFFFFFFF
            steps = np.zeros(int(last.max()) + 2, np.int64)
            np.add.at(steps, first, 1)
            np.add.at(steps, last + 1, -1)
            removed.append(np.flatnonzero(np.cumsum(steps)))
        sources = [sorted(x) for x in batch.column("sources").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(removed, pa.list_(pa.int32())), pa.array(sources, pa.list_(pa.int64()))],
            names=["doc_id", "removed", "first_docs"],
        )


@F.pandas_udf(StringType())
def cut(text: pd.Series, removed: pd.Series) -> pd.Series:
    """The texts without the removed sentences."""

    def one(t, gone):
        if t is None or gone is None or not len(gone):
            return t
        starts, out = sentences(t), set(np.asarray(gone).tolist())
        ends = [*starts[1:], len(t)]
        return "".join(t[a:b] for i, (a, b) in enumerate(zip(starts, ends, strict=True)) if i not in out)

    return pd.Series([one(t, g) for t, g in zip(text, removed, strict=True)], dtype=object)


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """The documents, columns unchanged, their texts without repeated spans; none is dropped."""
    gone = repeated_spans(docs).select(F.col("doc_id").alias("id"), "removed")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(F.col("doc_id").cast("long").alias("id"), row).join(gone, "id", "left")
    text = cut(F.col("row.text"), F.col("removed"))
    return joined.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each document: their key, first and last sentence in one number, and whether it has the key before."""
    for batch in batches:
        for part in slices(batch):
            keys, ids, places, again = [], [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                starts = sentences(text)
                bodies = [text[a:b].split() for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
                joined, known = [" ".join(b) for b in bodies], set()
                for first, last in spans([len(b) for b in bodies]):
                    key = xxhash.xxh3_64_intdigest(" ".join(joined[first : last + 1]).encode())
                    keys.append(key)
                    ids.append(doc_id)
                    places.append(first << 32 | last)
                    again.append(key in known)
                    known.add(key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(ids, pa.int64()),
                    pa.array(places, pa.int64()),
                    pa.array(again, pa.bool_()),
                ],
                names=["key", "doc_id", "place", "again"],
            )
