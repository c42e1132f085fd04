"""N-gram Jaccard self-join by a universe-partition pigeonhole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, mix, shingle_sets, sized, slices
from campuslake.llm.components import bucket_links, components, shared_buckets
from campuslake.session import scratch

BAND_GROWTH = 1.4
_LOW = np.uint64(0xFFFFFFFF)


def ngram_components(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: groups of texts linked by shingle similarity.

    Two texts link when ``100 * |A n B| >= percent * |A u B|`` over their sets of distinct
    n-word shingles; ``component_id`` is the smallest id reachable by links.

    Method. Linked sets of a size band differ in at most U shingles. The universe is hashed
    into m > U segments, taken in pairs; some pair of segments then differs in at most one
    shingle. Every document indexes the subset each segment holds. Where one segment of a
    pair is empty, its key would meet all documents that lack it; there the cheaper
    allocation is no key for it and the one-deletion neighbourhood of the other. A document
    probes its own band and those that its smaller partners may fall in.

    Documents with equal sets are one class. Within a bucket the classes are compared with
    its smallest member first, those most often met first of all; afterwards only pairs still in
    different components, but for those whose shared shingles can't reach the threshold. So
    every pair of a bucket is in one component, ruled out or compared. Sets are compared as
    64-bit hashes.

    Null or blank text: no shingles, linked with nothing. A null id is no document. Rows
    that repeat an id count as copies: one row, the largest set. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where("id is not null")
    with scratch(docs.sparkSession) as keep:
        ids = materialized(texts.mapInArrow(_classed(n), "id long, size int, class long"))
        rows = ids.where("size > 0").groupBy("class", "id").agg(F.max("size").alias("size"), F.count("*").alias("rows"))
        first = rows.groupBy("class").agg(F.min(F.struct("id", "rows")).alias("first"), F.max("size").alias("size"))
        classes = materialized(first.select("class", F.col("first.id").alias("first"), "size", F.col("first.rows").alias("rows")))
        links = _links(classes, texts, n, percent)
        found = (
            components(links)
            .withColumnRenamed("node", "class")
            .join(classes.select("class", "first"), "class")
        )
        smallest = found.groupBy("component").agg(F.min("first").alias("component_id"))
        placed = found.join(smallest, "component").select("class", "component_id")
        classes = classes.join(placed, "class", "left").select(
            "class", F.coalesce("component_id", "first").alias("component_id")
        )
        whole = ids.join(classes, "class", "left")
        return keep(
            whole.groupBy(F.col("id").alias("doc_id")).agg(
                F.max("size").cast("long").alias("n_shingles"),
                F.min(F.coalesce("component_id", "id")).alias("component_id"),
            )
        )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: of its smallest id, the first row; columns unchanged.

    Of rows that repeat an id, the one with the longest text stays, of equally long ones
    the first by text, then by a hash of the other columns. Rows without an id all stay.
    """
    found = ngram_components(docs, n, percent)
    gone = materialized(found.where("doc_id <> component_id").select("doc_id"))
    left = docs.join(sized(gone, 8), "doc_id", "left_anti").select(docs.columns)
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    many = sized(materialized(ids.where("rows > 1").select("doc_id")), 8)
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    # the row as one value, so that no column of its own can clash with the rank
    whole = left.join(many, "doc_id", "left_semi").select(
        "doc_id", "text", F.xxhash64(F.lit(0), *others).alias("others"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    order = Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last(), "text", "others")
    first = whole.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("row.*")
    return left.join(many, "doc_id", "left_anti").select(docs.columns).union(first)


def band_starts(largest: int) -> list[int]:
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_GROWTH)))
    return starts


def segments(last_size: int, percent: int) -> int:
    """An even number above the difference of two linked sets, the smaller of this size."""
    differ = (100 - percent) * (last_size + last_size * 100 // percent) // (100 + percent)
    return differ + 1 + (differ + 1) % 2


def segment_keys(shingles: np.ndarray, percent: int, starts: list[int]) -> np.ndarray:
    """The bucket keys of one set, over its own band and those of its smaller partners."""
    size = len(shingles)
    lowest = -(-size * percent // 100)
    low, high = shingles & _LOW, shingles >> np.uint64(32)
    place = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    keys = []
    band = int(np.searchsorted(starts, size, "right")) - 1
    while band >= 0 and starts[band + 1] > lowest:
        m = segments(starts[band + 1] - 1, percent)
        at = (place % np.uint64(m)).astype(np.int64)
        count = np.bincount(at, minlength=m)
        lows = np.bincount(at, low.astype(np.float64), m).astype(np.uint64)
        highs = np.bincount(at, high.astype(np.float64), m).astype(np.uint64)
        empty = count == 0
        other = empty.reshape(-1, 2)[:, ::-1].ravel()
        which = np.flatnonzero(~empty | other)
        keys.append(_key(lows[which], highs[which], which, band))
        near = (empty != other) & ~empty
        if near.any():
            own = near[at]
            seg = at[own]
            keys.append(_key(lows[seg] - low[own], highs[seg] - high[own], seg, band))
        band -= 1
    return np.concatenate(keys)


def _key(lows: np.ndarray, highs: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        own = mix(segment.astype(np.uint64) + np.uint64((band + 1) << 32))
        return mix(mix(lows + own) + highs * np.uint64(0xD6E8FEB86659FD93))


def _class(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        own = np.add.reduce(mix(shingles + np.uint64(0xA0761D6478BD642F)))
        return int(mix(np.array([own + np.uint64(len(shingles))]))[0].astype(np.int64))


def _classed(n: int):
    """The size and the class of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([_class(s) for s in sets], pa.int64()),
                    ],
                    names=["id", "size", "class"],
                )

    return run


def _indexed(n: int, percent: int):
    """The keys of the sets that are of the wanted class; another row of the id may be of another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = band_starts(1024)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), n)
                own = [(c, s) for c, s in zip(part.column("class").to_pylist(), sets, strict=True) if _class(s) == c]
                if not own:
                    continue
                largest = max(len(s) for _, s in own)
                if largest >= starts[-1]:
                    starts = band_starts(largest)
                keys = [segment_keys(s, percent, starts) for _, s in own]
                nodes = np.repeat(np.array([c for c, _ in own], np.int64), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).astype(np.uint64).view(np.int64)), pa.array(nodes)],
                    names=["key", "node"],
                )

    return run


def _links(classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links between classes, enough of them to join what belongs together."""
    # One text of each class is indexed; copies of it have the same keys.
    chosen = classes.select(F.col("first").alias("id"), "class")
    keyed = texts.join(sized(chosen, 16), "id").mapInArrow(_indexed(n, percent), "key long, node long")
    buckets = shared_buckets(keyed)
    sizes = classes.select("class", "size")
    involved = buckets.select(F.col("node").alias("class")).distinct().join(classes, "class")
    involved = materialized(involved.select(F.col("first").alias("id"), "class", "rows"))

    def hashed(wanted: DataFrame) -> DataFrame:
        return texts.join(sized(wanted.select("id", "class"), 16), "id").mapInArrow(_hashed(n), "class long, hashes array<long>")

    # Sets are large: only those of repeated rows are shuffled, to keep one.
    repeated = hashed(involved.where("rows > 1")).dropDuplicates(["class"])
    sets = materialized(hashed(involved.where("rows = 1")).union(repeated))

    def compared(pairs: DataFrame) -> DataFrame:
        # Small numbers of pairs go to the sets, so that sets are shuffled once, to their second node.
        fitting = materialized(
            pairs.join(sizes.toDF("a", "size_a"), "a")
            .join(sizes.toDF("b", "size_b"), "b")
            .where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
            .select("a", "b")
        )
        seconds = materialized(fitting.select(F.col("b").alias("class")).distinct())
        second = sets.join(sized(seconds, 8), "class", "left_semi")
        both = sets.toDF("a", "x").join(sized(fitting, 16), "a").join(second.toDF("b", "y"), "b")
        return both.mapInArrow(_verified(percent), "a long, b long")

    def features(nodes: DataFrame, every: int) -> DataFrame:
        found = sets.join(sized(nodes.withColumnRenamed("node", "class"), 8), "class", "left_semi")
        some = F.filter("hashes", lambda h: F.pmod(h, F.lit(every)) == 0) if every > 1 else F.col("hashes")
        size = F.size("hashes").alias("size")
        return found.select(F.col("class").alias("node"), size, F.explode(some).alias("feature"))

    return bucket_links(buckets, compared, features, percent)


def _hashed(n: int):
    """The sets of the rows whose class is the wanted one; another row of the id may have another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), n)
                wanted = part.column("class").to_pylist()
                own = [(c, s) for c, s in zip(wanted, sets, strict=True) if _class(s) == c]
                ends = np.cumsum([0, *(len(s) for _, s in own)])
                hashes = np.concatenate([np.zeros(0, np.uint64), *(s for _, s in own)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c, _ in own], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64))),
                    ],
                    names=["class", "hashes"],
                )

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                a, b = x[i].values.to_numpy(), y[i].values.to_numpy()
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run
