"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import materialized

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKETS = 4096


def shares(sizes: list[int], weights: list[float], most: float = MOST_EPOCHS) -> list[float]:
    """Targets of the sum of all sizes by weight, each at most ``most`` times its size.

    What a capped source can't take is shared among the others by weight, until none is above.
    """
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        whole = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / whole > most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = left * weights[i] / whole
            break
        for i in full:
            targets[i] = float(most * sizes[i])
        free -= set(full)
        left -= sum(targets[i] for i in full)
    return targets


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 17) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every document.

    Sources in code point order, null last, have the weights, repeated in turn. A source
    whose target is q times its size and a rest gives q whole epochs first; the rest is a
    sample without replacement: documents in order of their exponential keys
    ``-ln(u) / w``, u drawn from a hash of seed and id and w the document's quality (a
    quarter, and three quarters by the variety of its words), up to the document whose
    middle passes the rest. Keys fall into buckets whose sums are prefix-summed, so only the one
    bucket at the edge is sorted and summed row by row.

    Null or blank text has size 0 and takes 0. A null id counts as one id. Equal keys are
    ordered by id and size; rows equal in all of them are alike, so any of them may be
    the one taken. One row per source passes through the driver. No rows: no rows.
    """
    all_words = words(F.col("text"))
    read = docs.select("doc_id", F.col("source").alias("source"), all_words.alias("words"))
    size = F.size("words").cast("long")
    quality = F.lit(0.25) + 0.75 * F.size(F.array_distinct("words")) / F.greatest(F.size("words"), F.lit(1))
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = materialized(
        read.select("doc_id", "source", size.alias("size"), (-F.log(draw) / quality).alias("key"))
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    sums.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = shares(
        [r["source_size"] for r in sums], [float(weights[i % len(weights)]) for i in range(len(sums))]
    )
    plan = [
        (i, r["source"], r["source_size"], t, *_epochs(t, r["source_size"]))
        for i, (r, t) in enumerate(zip(sums, targets, strict=True))
    ]
    sources = rows.sparkSession.createDataFrame(
        plan, "sid int, name string, source_size long, target double, epochs long, rest double"
    )
    bucket = F.floor((1 - F.exp(-F.col("key") / 2)) * (BUCKETS - 1)).cast("int")
    placed = rows.join(sources.select("sid", "name"), F.col("source").eqNullSafe(F.col("name"))).select(
        "sid", "doc_id", "size", "key", bucket.alias("bucket")
    )
    ordered = Window.partitionBy("sid").orderBy("bucket")
    buckets = (
        placed.groupBy("sid", "bucket")
        .agg(F.sum("size").alias("in_bucket"))
        .withColumn("up_to", F.sum("in_bucket").over(ordered))
        .join(sources.drop("name"), "sid")
        .select(
            "sid", "bucket", "source_size", "target", "epochs", "rest",
            (F.col("up_to") - F.col("in_bucket")).alias("before"),
            ((F.col("up_to") > F.col("rest")) & (F.col("up_to") - F.col("in_bucket") <= F.col("rest"))).alias("edge"),
            (F.col("up_to") <= F.col("rest")).alias("inside"),
        )
    )
    known = placed.join(buckets, ["sid", "bucket"])
    running = F.sum("size").over(
        Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    middle = F.col("before") + running - F.col("size") / 2
    at_edge = known.where("edge").withColumn("inside", middle <= F.col("rest"))
    both = known.where("not edge").unionByName(at_edge)
    taken = F.col("size") * (F.col("epochs") + F.col("inside").cast("long"))
    return both.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _epochs(target: float, size: int) -> tuple[int, float]:
    """Whole passes, and what is left of the target after them."""
    whole = int(target // size) if size else 0
    return (whole, target - whole * size) if size else (0, -1.0)


def repeat_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 17) -> DataFrame:
    """The documents as often as the mix takes them, with their columns.

    A document of size 0 has no words to take and is kept once. Expects one row per id; of
    rows that repeat an id, each is taken as often as the one taken most.
    A row without an id is kept once.
    """
    mixed = mix_sources(docs, weights, seed).where("size > 0 and doc_id is not null")
    taken = mixed.select("doc_id", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    times = materialized(taken.groupBy("doc_id").agg(F.max("times").alias("times")))
    whole = docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    counted = whole.join(times.withColumnRenamed("doc_id", "id"), "id", "left")
    often = counted.select("row", F.coalesce("times", F.lit(1)).alias("times")).where("times > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
