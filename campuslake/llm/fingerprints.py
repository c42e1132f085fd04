"""Document fingerprints by a randomised edit embedding with bit sampling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, mix, parallelism, slices
from campuslake.llm.components import components, mixed_buckets, shared_buckets

# Characters fall into so many kinds, by their code; a last kind stands past the end.
KINDS = 61
SAMPLES = 128
CHUNK = 512
SLICE = 8 << 20
# So many bands of so many sampled bits: fingerprints of likeness 0.8 agree in one with 0.97, of 0.9 always.
BANDS, BAND_BITS = 64, 28
LIKELY = 0.8
SEED = 20250117


def _bits(stream: int, chunk: int) -> np.ndarray:
    """A random bit for each step of a chunk and each kind of character; past the end 0."""
    rng = np.random.default_rng([SEED, stream, chunk])
    out = np.zeros((CHUNK, KINDS + 1), np.uint8)
    out[:, :KINDS] = rng.integers(0, 2, (CHUNK, KINDS), np.uint8)
    return out


def sampled_steps(octave: int) -> np.ndarray:
    """The steps sampled in an octave: all of the first SAMPLES, then one in each of SAMPLES strata."""
    if octave == 0:
        return np.arange(SAMPLES)
    stride = 1 << (octave - 1)
    offsets = np.random.default_rng([SEED, 3, octave]).integers(0, stride, SAMPLES)
    return SAMPLES * stride + np.arange(SAMPLES) * stride + offsets


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text: how many samples it has, then their bits, in hex.

    All texts walk together. At each step a text emits its current character and moves on
    if the random bit of that step and kind of character says so; texts that meet an
    insertion or a deletion fall into step again, so the walks of near texts agree almost
    everywhere. A fingerprint samples one bit of the emitted character at fixed steps,
    equally many from each doubling of the walk's length, up to the end of the text.
    """
    n = len(texts)
    if not n:
        return []
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    kinds = (codes % KINDS).astype(np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kinds[ends] = KINDS
    lane = np.arange(n)
    at = np.append(0, ends[:-1] + 1)
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    octave, wanted, next_at, step = 0, sampled_steps(0).tolist(), 0, 0
    while len(lane):
        moves, emits = _bits(1, step // CHUNK), _bits(2, step // CHUNK)
        for i in range(CHUNK):
            kind = kinds[at]
            if step == wanted[next_at]:
                taken.append((lane, np.where(kind == KINDS, 2, emits[i][kind]).astype(np.uint8)))
                next_at += 1
                if next_at == SAMPLES:
                    octave, next_at = octave + 1, 0
                    wanted = sampled_steps(octave).tolist()
            at = at + moves[i][kind]
            step += 1
            if step & 63 == 0:
                going = kinds[at] != KINDS
                if not going.all():
                    lane, at = lane[going], at[going]
                    if not len(lane):
                        break
    bits = np.full((n, len(taken)), 2, np.uint8)
    for k, (who, values) in enumerate(taken):
        bits[who, k] = values
    counts = (bits != 2).sum(1).tolist()
    return [f"{c:04x}" + np.packbits(bits[i, :c]).tobytes().hex() for i, c in enumerate(counts)]


def _sampled(fingerprint: str) -> np.ndarray:
    count = int(fingerprint[:4], 16)
    return np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint[4:]), np.uint8))[:count]


def sample_weights(count: int) -> np.ndarray:
    """The steps each of the first samples stands for."""
    octaves = np.arange(count) // SAMPLES
    return np.where(octaves == 0, 1.0, 2.0 ** (np.maximum(octaves, 1) - 1))


def distance(a: str, b: str) -> tuple[float, float]:
    """The steps at which the samples differ, a sample that only one has counting half, and the steps of the longer."""
    x, y = _sampled(a), _sampled(b)
    both = min(len(x), len(y))
    weights = sample_weights(max(len(x), len(y)))
    return float(weights[:both][x[:both] != y[:both]].sum() + weights[both:].sum() / 2), float(weights.sum())


def likeness(a: str, b: str) -> float:
    """The share of the walks that agree, 0 to 1: unrelated bits agree half the time, so twice the excess."""
    differ, steps = distance(a, b)
    return max(0.0, 1 - 2 * differ / steps) if steps else 1.0


@lru_cache(maxsize=None)
def _drawn(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The samples of each band of a fingerprint of so many, and a number for each band's choice.

    A race decides: of the samples there are, those with the least exponential times go, at rates of the steps they
    stand for. Fingerprints of nearly equal counts draw nearly always the same. Counts are at most SAMPLES for each doubling.
    """
    octaves = -(-count // SAMPLES)
    times = np.concatenate([np.random.default_rng([SEED, 4, o]).exponential(size=(BANDS, SAMPLES)) for o in range(octaves)], axis=1)
    order = np.argsort(times[:, :count] / sample_weights(count), axis=1)[:, :BAND_BITS]
    chosen = np.sort(order, axis=1)
    return chosen, np.array([xxhash.xxh3_64_intdigest(c.tobytes(), seed=b) for b, c in enumerate(chosen)], np.uint64)


def band_keys(fingerprint: str) -> np.ndarray:
    """A key of each band; a fingerprint of fewer than BAND_BITS samples has one, of them all."""
    bits = _sampled(fingerprint)
    if len(bits) < BAND_BITS:
        return np.array([xxhash.xxh3_64_intdigest(fingerprint)], np.uint64).view(np.int64)
    chosen, salts = _drawn(len(bits))
    values = bits[chosen] @ (np.uint64(1) << np.arange(BAND_BITS, dtype=np.uint64))
    return mix(salts ^ mix(values.astype(np.uint64))).view(np.int64)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    The edited text replaces the last half by the beginning of the next document, in
    ascending order of id, the first following the last. Documents are range partitioned
    and sorted, so a partition streams past its pairs; of each partition only the first
    and the last document go on, to be paired with their neighbours.

    Null text is empty; an empty text is like an empty one only. Null ids come first.
    Rows with one id are ordered by text. One document follows itself. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(parallelism(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    parts = materialized(ordered.mapInArrow(_paired, f"part int, edge int, text string, {_OUT}"))
    edges = parts.where("edge > 0").coalesce(1).sortWithinPartitions("part", "edge")
    inner = parts.where("edge = 0").drop("part", "edge", "text")
    return inner.union(edges.mapInArrow(_joined_edges, _OUT))


def near_groups(prints: DataFrame, likely: float = LIKELY) -> DataFrame:
    """The rows ``(doc_id, fingerprint, ...)`` with ``near_component``: the smallest id whose fingerprint is reachable by links.

    Fingerprints link when their likeness reaches ``likely`` and they agree in a band; equal ones are one
    node, so copies need no pairs. A row alike to none is its own component, one without an id and alike to none has none.
    """
    node = F.xxhash64("fingerprint")
    nodes = materialized(prints.groupBy(node.alias("node")).agg(F.min("doc_id").alias("first"), F.any_value("fingerprint").alias("fingerprint")))
    placed = materialized(components(_links(nodes, likely).select("a", "b")))
    known = placed.join(nodes.select("node", "first"), "node")
    smallest = known.groupBy("component").agg(F.min("first").alias("near_component"))
    found = known.join(smallest, "component").select("node", "near_component")
    # a node without links has the smallest id of its copies, which few nodes have
    whole = nodes.join(found, "node", "left").select("node", F.coalesce("near_component", "first").alias("near_component"))
    row = F.struct(*[F.col(f"`{c}`") for c in prints.columns]).alias("row")
    return prints.select(node.alias("node"), row).join(whole, "node", "left").select("row.*", "near_component")


def near_documents(docs: DataFrame, likely: float = LIKELY) -> DataFrame:
    """Links ``(a, b, likeness)`` of ids whose fingerprints are alike, as many as their components need.

    Documents with one fingerprint are known by their smallest id and link with it. Null text is empty; rows without an
    id link with nothing; likeness of an empty text is 1 to another empty one.
    """
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    found = materialized(rows.mapInArrow(_fingerprinted, "doc_id long, fingerprint string").withColumn("node", F.xxhash64("fingerprint")))
    nodes = materialized(found.groupBy("node").agg(F.min("doc_id").alias("first"), F.any_value("fingerprint").alias("fingerprint")))
    ids = nodes.select("node", "first")
    linked = _links(nodes, likely).join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b")
    linked = linked.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"), "likeness")
    copies = found.join(ids, "node").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    return linked.union(copies.distinct().withColumn("likeness", F.lit(1.0)))


def _links(nodes: DataFrame, likely: float) -> DataFrame:
    """Links ``(a, b, likeness)`` among the nodes ``(node, fingerprint)``, enough of them to join what belongs together.

    Bit-sampled banding: a band's key is BAND_BITS samples, drawn in proportion to the steps that they stand for, so
    alike fingerprints agree in one with the power of their agreement. Every node is compared with the smallest of a
    bucket that it meets most often. In buckets of several components then, all are compared with the hub, the node that
    meets the most others: the text that a group's copies come from. Where one has several still, the distances to
    its hub bound all others, since weighted Hamming distances obey the triangle inequality: two nodes whose distances
    to it differ by more than a link allows are ruled out, the rest is compared by all samples within the join, which
    makes rows of links only. So a bucket's nodes are in one component, ruled out or compared.
    """
    buckets = shared_buckets(nodes.mapInArrow(_banded, "node long, key long"))
    led = buckets.where("node <> leader").groupBy(F.col("node").alias("a"), F.col("leader").alias("b")).agg(F.count("*").alias("met"))
    best = led.groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b"))
    first = materialized(_measured(best, nodes))
    near = F.col("likeness") >= likely
    rest = mixed_buckets(buckets.select("key", "node"), first.where(near))
    sizes = rest.groupBy("key").agg(F.count("*").alias("n"))
    known = rest.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("met"))
    hubs = materialized(rest.join(known, "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("hub")))
    others = rest.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    second = materialized(_measured(others, nodes))
    links = first.union(second).where(near).select("a", "b", "likeness")
    rest = mixed_buckets(rest.select("key", "node"), links).join(hubs, "key")
    count = F.conv(F.substring("fingerprint", 1, 4), 16, 10).cast("int")
    octave = F.floor(count / SAMPLES)
    weight = F.when(octave == 0, count.cast("double")).otherwise((SAMPLES + count % SAMPLES) * F.pow(F.lit(2.0), octave - 1))
    reached = second.select(F.col("a").alias("node"), F.col("b").alias("hub"), "distance")
    told = (
        rest.join(reached, ["node", "hub"], "left")
        .join(nodes.select("node", count.alias("count"), weight.alias("weight"), _words(count).alias("words")), "node")
        .select("key", "node", "at", F.coalesce("distance", F.lit(0.0)).alias("distance"), "count", "weight", "words")
    )
    told = materialized(told)
    return materialized(links.union(_alike(told, likely)))


def _alike(told: DataFrame, likely: float) -> DataFrame:
    """Links ``(a, b, likeness)`` within the keys of ``told`` between nodes that are in several components so far."""
    x, y = told.alias("x"), told.alias("y")
    heavier = F.greatest("x.weight", "y.weight")
    within = F.abs(F.col("x.distance") - F.col("y.distance")) <= heavier * ((1 - likely) / 2 + 1e-9)
    # Weights are powers of two, so sums are exact and a likeness is the one of ``likeness``.
    alike = F.greatest(F.lit(0.0), 1 - 2 * _distance() / heavier)
    pairs = x.join(y, F.col("x.key") == F.col("y.key")).where(F.expr("x.node > y.node and x.at <> y.at") & within & (alike >= likely))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), alike.alias("likeness")).distinct()


def _words(count: Column) -> Column:
    """The fingerprint's samples in 64-bit words, the last one filled up with zeros."""
    word = lambda i: F.conv(F.rpad(F.substring("fingerprint", 16 * i + 5, F.lit(16)), 16, "0"), 16, -10).cast("long")
    none = F.array().cast("array<long>")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.ceil(count / 64).cast("int") - 1), word)).otherwise(none)


def _distance() -> Column:
    """The distance of the fingerprints of ``x`` and ``y``, known by count, weight and words of their samples."""
    both = F.least("x.count", "y.count")

    def differ(word: Column, i: Column) -> Column:
        # of the last word that both have, the samples that both have; then none
        shared = F.least(both - 64 * i, F.lit(64))
        parted = F.call_function("shiftrightunsigned", word.bitwiseXOR(F.get("y.words", i)), 64 - shared)
        return F.when(shared > 0, F.bit_count(parted) * F.pow(F.lit(2.0), F.greatest(F.floor(i / (SAMPLES // 64)) - 1, F.lit(0)))).otherwise(0.0)

    steps = F.transform("x.words", differ)
    return F.aggregate(steps, F.abs(F.col("x.weight") - F.col("y.weight")) / 2, lambda total, n: total + n)


def _measured(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs with the likeness and the distance of their whole fingerprints."""
    prints = nodes.select("node", "fingerprint")
    both = pairs.join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b")
    return both.mapInArrow(_likenesses, "a long, b long, likeness double, distance double")


def _row(text: str, own: str, doc_id: int | None, following: str, next_print: str, changed: str, changed_print: str):
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, changed_print,
        likeness(own, changed_print), likeness(own, next_print),
    )


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    names, kinds = ["part", "edge", "text", *_NAMES], [pa.int32(), pa.int32(), pa.string(), *_KINDS]

    def edge(kind: int, doc: tuple) -> tuple:
        return (part, kind, doc[1], doc[0], len(doc[1]), None, doc[2], None, None, None)

    last = None
    for batch in batches:
        for piece in slices(batch, size=SLICE):
            ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            before = [last[1]] if last else []
            pairs = [edited(a, b) for a, b in zip(before + texts[:-1], texts if last else texts[1:], strict=True)]
            prints = fingerprints(texts + pairs)
            docs = ([last] if last else []) + list(zip(ids, texts, prints, strict=False))
            rows = [] if last else [edge(1, docs[0])]
            for (i, text, own), (_, following, after), changed, changed_print in zip(
                docs, docs[1:], pairs, prints[len(texts) :], strict=False
            ):
                rows.append((part, 0, None, *_row(text, own, i, following, after, changed, changed_print)))
            last = docs[-1]
            if rows:
                yield _batch(rows, names, kinds)
    if last:
        yield _batch([edge(2, last)], names, kinds)


def _joined_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def paired(a: tuple, b: tuple) -> pa.RecordBatch:
        changed = edited(a[1], b[1])
        return _batch([_row(a[1], a[2], a[0], b[1], b[2], changed, fingerprints([changed])[0])], _NAMES, _KINDS)

    first = last = None
    for batch in batches:
        for r in batch.select(["edge", "doc_id", "text", "fingerprint"]).to_pylist():
            doc = (r["doc_id"], r["text"], r["fingerprint"])
            if r["edge"] == 1:
                if last:
                    yield paired(last, doc)
                first = first or doc
            else:
                last = doc
    if last:
        yield paired(last, first)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, size=SLICE):
            prints = pa.array(fingerprints(piece.column("text").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), prints], names=["doc_id", "fingerprint"])


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [band_keys(p) for p in batch.column("fingerprint").to_pylist()]
        nodes = np.repeat(batch.column("node").to_numpy(), [len(k) for k in keys])
        joined = np.concatenate([np.zeros(0, np.int64), *keys])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(joined)], names=["node", "key"])


def _likenesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
        found = [distance(x, y) for x, y in pairs]
        likely = [max(0.0, 1 - 2 * d / w) if w else 1.0 for d, w in found]
        columns = [batch.column("a"), batch.column("b"), pa.array(likely, pa.float64()), pa.array([d for d, _ in found], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "likeness", "distance"])
