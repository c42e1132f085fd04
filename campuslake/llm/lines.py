"""Fuzzy line dedup by MinHash and union-find; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, sized
from campuslake.llm.components import bucket_links, components, written_buckets
from campuslake.session import scratch

SHINGLE = 9
BANDS, ROWS = 8, 4
PERCENT = 80
# Lines up to SHORT characters, and those of fewer than FEW anchored shingles, are signed over all shingles.
SHORT, FEW = 72, 12
SHORT_BANDS = 16
# Sets so small get a key from each hash on.
EVERY_RUN = 32

# A shingle is anchored at the start and behind every character that is no letter, or one
# of the scripts that have no blanks between words (Thai to Khmer, and Han with its neighbours).
# A match takes its shingle ahead, then all up to the next anchor (the second character is none). The common
# letters, told by a table, are tried first; a class that asks for each character's kind takes thrice the time.
_UNSPACED = "฀-໿က-႟ក-៿⺀-鿿"
_LATIN = "".join(c for c in map(chr, range(256)) if c.isalpha())
_OTHER = rf"[[^\x00-\xff]&&\p{{L}}&&[^{_UNSPACED}]]"
_WORD_REST = rf"[{_LATIN}]*(?:[\x00-\xff]|(?:{_OTHER}[{_LATIN}]*)*+.?+)"
_ANCHORED = rf"(?s)(?=(.{{{SHINGLE}}}))(?:^[^\x00-\uffff]|(?:^.)?+{_WORD_REST})"
_EVERY = rf"(?s)(?=(.{{{SHINGLE}}}))"


def _shingles(line: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(line, F.lit(pattern), F.lit(1))
    return F.when(F.length(F.substring(line, 1, SHINGLE)) == SHINGLE, found).otherwise(F.array(line))


def _hashes(line: Column) -> Column:
    return F.array_distinct(F.transform(_shingles(line, _EVERY), lambda s: F.xxhash64(s)))


def _similar(x: Column, y: Column) -> Column:
    """Whether the Jaccard similarity of two sets reaches PERCENT, exactly."""
    return (100 + PERCENT) * F.size(F.array_intersect(x, y)) >= PERCENT * (F.size(x) + F.size(y))


def _anchored(line: Column) -> Column:
    return F.sort_array(F.array_distinct(F.transform(_shingles(line, _ANCHORED), lambda s: F.xxhash64(s))))


def _signed(line: Column, anchored: Column) -> list[Column]:
    """The sets that sign a line, sorted: of anchored shingles, and of all; empty if they don't."""
    shortest = PERCENT * (SHORT - SHINGLE + 2) // 100 + SHINGLE - 1
    length = F.length(F.substring(line, 1, SHORT + 1))
    none = F.array().cast("array<long>")
    every = F.when((length <= SHORT) | (F.size(anchored) < FEW), F.sort_array(_hashes(line))).otherwise(none)
    return [F.when(length >= shortest, anchored).otherwise(none).alias("anchored"), every.alias("every")]


def _thresholds(bands: int) -> list[int]:
    return [-(1 << 63) + b * ((1 << 64) // bands) for b in range(bands)]


def _circle(hashes: Column, bands: int) -> Column:
    """A sorted set with the thresholds among it, and on a circle: as far as a run goes beyond its end."""
    few = F.concat(*[hashes] * (ROWS + 1))
    return F.struct(
        F.size(hashes).alias("size"),
        F.sort_array(F.concat(hashes, F.array(*[F.lit(t) for t in _thresholds(bands)]))).alias("marked"),
        F.when(F.size(hashes) < ROWS, few).otherwise(F.concat(hashes, F.slice(hashes, 1, ROWS))).alias("on"),
    )


def _runs(circle: Column, bands: int) -> Column:
    """The hashes of runs of ROWS successive hashes of a sorted set, on a circle.

    The runs are those that follow ``bands`` thresholds; of a set of up to EVERY_RUN that has SHORT_BANDS, all.
    """
    run = lambda start: F.xxhash64(F.slice(circle["on"], start, ROWS))
    found = F.array(*[run((F.array_position(circle["marked"], F.lit(t)) - b).cast("int")) for b, t in enumerate(_thresholds(bands))])
    if bands == SHORT_BANDS:
        found = F.when(circle["size"] <= EVERY_RUN, F.transform(F.sequence(F.lit(1), circle["size"]), run)).otherwise(found)
    return F.when(circle["size"] > 0, found).otherwise(F.array().cast("array<long>"))


def _keys(anchored: Column, every: Column) -> Column:
    return F.array_distinct(F.concat(_runs(anchored, BANDS), _runs(every, SHORT_BANDS)))


def with_keys(lines: DataFrame) -> DataFrame:
    """Lines ``(..., line)`` with the ``keys`` of each, in place of the line.

    Keys of ROWS minima each, out of sorted sets of hashes. A band's minima are the ROWS hashes that
    follow its threshold, on a circle: lines of similarity J agree in all of them with a probability of
    about J to the power of ROWS.

    Short lines, and those of few anchored shingles, have too few of these and are signed over all
    shingles. A set of up to EVERY_RUN has every run as a key: of two such sets with c shingles in common
    and d others, c >= 4 d at PERCENT, so ROWS of the c follow each other on the circle and no link is lost.
    Lines that may link with one beyond SHORT are signed both ways.

    Each step is a column of its own: a lambda of Spark's works on boxed values, a column's arrays hold plain numbers.
    """
    others = [c for c in lines.columns if c != "line"]
    sets = lines.select("*", _anchored(F.col("line")).alias("anchored"))
    sets = sets.select(*others, *_signed(F.col("line"), F.col("anchored")))
    circles = sets.select(*others, _circle(F.col("anchored"), BANDS).alias("anchored"), _circle(F.col("every"), SHORT_BANDS).alias("every"))
    return circles.select(*others, _keys(F.col("anchored"), F.col("every")).alias("keys"))


def band_keys(line: Column) -> Column:
    """The keys of ``with_keys`` as one column."""

    def let(value: Column, body: Callable[[Column], Column]) -> Column:
        return F.transform(F.array(value), body)[0]

    def keys(sets: Column) -> Column:
        circles = F.struct(_circle(sets["anchored"], BANDS).alias("anchored"), _circle(sets["every"], SHORT_BANDS).alias("every"))
        return let(circles, lambda c: _keys(c["anchored"], c["every"]))

    return let(_anchored(line), lambda anchored: let(F.struct(*_signed(line, anchored)), keys))


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, id, line)`` of all lines that aren't blank; id: the line's 64-bit hash."""
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    return rows.where(F.trim("line") != "").select("doc_id", "line_no", F.xxhash64("line").alias("id"), "line")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, removed)``: the lines to remove, by number, of the documents that have some.

    Lines link when the sets of their character shingles have a Jaccard similarity of
    PERCENT or more; of each component the line first by id and place stays. Equal lines
    are one node, known by a 64-bit hash. Signatures are minima of hashes of the anchored
    shingles, mostly those that begin a word, one in six of all, and of all shingles of short lines; lines that
    agree in a band are compared by all their shingles, so every link is exact. Lines that agree in
    a band with others they don't link with are signed again, over all shingles. A line
    shorter than a shingle is its own one shingle.

    Blank lines are kept. Null text has no lines; rows without an id are left alone.
    Equal rows of one id share their places and keep the same lines. Other columns are ignored.
    """
    place = F.struct("doc_id", "line_no")
    with scratch(docs.sparkSession) as keep:
        occurrences = lines_of(docs)
        signed = materialized(with_keys(occurrences))
        places = signed.select("doc_id", "line_no", "id")
        buckets = written_buckets(signed.select(F.col("id").alias("node"), F.explode("keys").alias("key")))
        involved = materialized(buckets.select(F.col("node").alias("id")).distinct())
        wanted = occurrences.join(sized(involved, 8), "id", "left_semi").select("id", "line")
        texts = wanted.groupBy("id", "line").agg(F.count("*").alias("n"))
        sets = materialized(texts.select(F.col("id").alias("node"), _hashes(F.col("line")).alias("hashes")))

        def compared(pairs: DataFrame) -> DataFrame:
            # Small numbers of pairs go to the sets, so that sets are shuffled once, to their second node.
            pairs = materialized(pairs)
            seconds = materialized(pairs.select(F.col("b").alias("node")).distinct())
            second = sets.join(sized(seconds, 8), "node", "left_semi")
            both = sets.toDF("a", "x").join(sized(pairs, 16), "a").join(second.toDF("b", "y"), "b")
            return both.where(_similar(F.col("x"), F.col("y"))).select("a", "b")

        def features(found: DataFrame, every: int) -> DataFrame:
            own = sets.join(sized(found, 8), "node", "left_semi")
            told = F.filter("hashes", lambda h: F.pmod(h, F.lit(every)) == 0) if every > 1 else F.col("hashes")
            return own.select("node", F.size("hashes").alias("size"), F.explode(told).alias("feature"))

        def finer(nodes: DataFrame) -> DataFrame:
            found = sets.join(sized(materialized(nodes), 8), "node", "left_semi")
            circles = found.select("node", F.sort_array("hashes").alias("hashes"))
            circles = circles.select("node", _circle(F.col("hashes"), SHORT_BANDS).alias("every"))
            keys = materialized(circles.select("node", _runs(F.col("every"), SHORT_BANDS).alias("keys")))
            return keys.select("node", F.explode("keys").alias("key"))

        placed = materialized(components(bucket_links(buckets, compared, features, PERCENT, finer)))
        # a line that stands once and links with none is no one's copy
        nodes = places.groupBy("id").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        known = nodes.join(sized(placed.withColumnRenamed("node", "id"), 16), "id", "left").where("component is not null or first <> last")
        known = materialized(known.withColumn("group", F.coalesce("component", "id")))
        kept = known.groupBy("group").agg(F.min("first").alias("kept"), F.max("last").alias("end")).where("kept <> end")
        gone = materialized(known.join(kept, "group").select("id", "kept"))
        removed = places.join(sized(gone, 24), "id").where(place != F.col("kept"))
        return keep(removed.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("removed")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents, columns unchanged, their texts without the removed lines; none is dropped."""
    gone = repeated_lines(docs).select(F.col("doc_id").alias("id"), "removed")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(F.col("doc_id").cast("long").alias("id"), row).join(gone, "id", "left")
    kept = F.filter(F.split("row.text", "\n", -1), lambda line, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
