"""Exact top-k search by inner product: blocks of a range of vectors, visited by their bounds until these fall below the kth."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, parallelism

SCALE = 1024
BLOCK = 256
# Components that a block may hold, so that a few long vectors make a block of their own.
CELLS = 1 << 20
# Blocks and queries of a cell: the bound of a search task's memory.
STRIPE, QUERIES = 32, 4096
# Vectors that order the index, a fixed number of them; they touch no result.
PIVOTS = 64

_EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)
_NO_ID = (1 << 63) - 1

_BLOCK_SCHEMA = (
    "block long, ids array<long>, dims int, width int, vectors binary, low array<long>, high array<long>, "
    "queries array<int>, query_ids array<long>, query_vectors binary, floors array<long>"
)


def integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: each component times 1024, rounded down, as a long; beyond a long's range its end.

    Vectors that are null or hold a null, NaN or infinite component take no part.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    floor = F.transform("x", lambda v: F.floor(v * SCALE))
    return rows.where(F.col("x").isNotNull() & finite).select("vec_id", floor.alias("vector"))


def _matrix(vectors: list, dims: int | None = None) -> np.ndarray:
    """The vectors as rows; missing components are zero."""
    dims = max((len(v) for v in vectors), default=0) if dims is None else dims
    out = np.zeros((len(vectors), dims), np.int64)
    for k, v in enumerate(vectors):
        out[k, : min(len(v), dims)] = v[:dims]
    return out


def _magnitude(x: np.ndarray) -> float:
    """The largest absolute value; as a float, since a long's least value has no positive twin."""
    return float(max(x.max(initial=0), -float(x.min(initial=0))))


def _exactly(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two as floats where all sums of products are exact in them, else as whole numbers of any size."""
    if _magnitude(a) * _magnitude(b) * max(1, a.shape[-1]) < _EXACT:
        return a.astype(np.float64), b.astype(np.float64)
    return a.astype(object), b.astype(object)


def _clipped(x: np.ndarray) -> np.ndarray:
    """What is beyond a long's range as its end; floats here are far within."""
    return np.minimum(np.maximum(x, _LONG[0]), _LONG[1]) if x.dtype == object else x


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of rows, over the components that both have."""
    n = min(a.shape[1], b.shape[1])
    if not n:
        return np.zeros((len(a), len(b)))
    x, y = _exactly(a[:, :n], b[:, :n])
    return _clipped(x @ y.T)


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """What no vector of a block exceeds: the sum of each component's largest product."""
    n = min(queries.shape[1], low.shape[1])
    if not n:
        return np.zeros((len(queries), len(low)))
    q, _ = _exactly(queries[:, :n], np.concatenate([low[:, :n], high[:, :n]]))
    lo, hi = low[:, :n].astype(q.dtype), high[:, :n].astype(q.dtype)
    return _clipped(np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T)


def _nearest(pivots: np.ndarray):
    """Each vector's closest pivot and the product with it: what brings like vectors into one range."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("length", pa.int32()), ("pivot", pa.int32()), ("near", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            for k in range(0, len(vectors), BLOCK):
                own = vectors[k : k + BLOCK]
                met = np.array([np.zeros(len(pivots)) + (pivots[:, : len(v)] @ np.array(v[: pivots.shape[1]], float)) for v in own])
                pivot = met.argmax(axis=1)
                columns = [
                    batch.column("vec_id").slice(k, len(own)), pa.array(own, pa.list_(pa.int64())),
                    pa.array([len(v) for v in own], pa.int32()), pa.array(pivot, pa.int32()), pa.array(met[np.arange(len(own)), pivot]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _blocks(k: int, every: int):
    """Blocks of consecutive vectors; of the queries among them, the kth best product within the block."""

    def block(number: int, ids: list, vectors: list) -> pa.RecordBatch:
        whole = _matrix(vectors)
        queries = [i for i, own in enumerate(ids) if own is not None and own % every == 0]
        floors = []
        for i in queries:
            met = np.delete(_products(whole[i : i + 1], whole)[0], i)
            floors.append(int(np.sort(met)[-k]) if len(met) >= k else None)
        width = 4 if _magnitude(whole) < 1 << 31 else 8
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([whole.shape[1]], pa.int32()),
                pa.array([width], pa.int32()), pa.array([whole.astype(f"<i{width}").tobytes()], pa.binary()),
                pa.array([whole.min(axis=0).tolist()], pa.list_(pa.int64())), pa.array([whole.max(axis=0).tolist()], pa.list_(pa.int64())),
                pa.array([queries], pa.list_(pa.int32())), pa.array([[ids[i] for i in queries]], pa.list_(pa.int64())),
                pa.array([whole[queries].astype(f"<i{width}").tobytes()], pa.binary()), pa.array([floors], pa.list_(pa.int64())),
            ],
            names=["block", "ids", "dims", "width", "vectors", "low", "high", "queries", "query_ids", "query_vectors", "floors"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, vectors, longest = TaskContext.get().partitionId() << 33, [], [], 0
        for batch in batches:
            for own, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                longest = max(longest, len(vector))
                if ids and (len(ids) == BLOCK or longest * (len(ids) + 1) > CELLS):
                    yield block(number, ids, vectors)
                    number, ids, vectors, longest = number + 1, [], [], len(vector)
                ids.append(own)
                vectors.append(vector)
        if ids:
            yield block(number, ids, vectors)

    return run


def _unpacked(row: dict) -> np.ndarray:
    return np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(len(row["ids"]), row["dims"]).astype(np.int64)


class _Cell:
    """The queries and the blocks that meet in one search task."""

    def __init__(self, k: int):
        self.k, self.queries, self.blocks = k, [], []

    def add(self, row: dict) -> None:
        if row["is_query"]:
            whole = _unpacked(row)
            own = zip(row["queries"], row["ids"], whole, row["floors"], strict=True)
            self.queries += [(row["block"], at, i, vector, floor) for at, i, vector, floor in own]
        else:
            self.blocks.append(row)

    def best(self) -> list[dict]:
        if not self.queries or not self.blocks:
            return []
        queries = _matrix([q[3] for q in self.queries])
        dims = max(b["dims"] for b in self.blocks)
        low, high = (_matrix([b[c] for b in self.blocks], dims) for c in ("low", "high"))
        bounds = _bounds(queries, low, high)
        # From the highest bound down; the sort is over exact numbers, ties by block.
        order = np.argsort(-bounds, axis=1, kind="stable")
        home = np.array([[q[0], q[1]] for q in self.queries])
        keys = [np.array([_NO_ID if i is None else i for i in b["ids"]]) for b in self.blocks]
        least = np.array([own.min() for own in keys])
        whole = [_unpacked(b) for b in self.blocks]
        kth = np.array([-np.inf if q[4] is None else q[4] for q in self.queries], bounds.dtype)
        numbers = np.array([b["block"] for b in self.blocks])
        kth_id = np.full(len(queries), _NO_ID)
        kind = [("q", np.int64), ("id", np.int64), ("b", np.int64), ("at", np.int64)]
        found, scores = np.zeros(0, kind), np.zeros(0, bounds.dtype)
        for step in range(len(self.blocks)):
            at = order[:, step]
            bound = bounds[np.arange(len(queries)), at]
            going = (bound > kth) | ((bound == kth) & (least[at] <= kth_id))
            if not (bound >= kth).any():
                break
            new, paid = [found], [scores]
            for b in np.unique(at[going]):
                own = np.flatnonzero(going & (at == b))
                met = _products(queries[own], whole[b])
                keep = met >= kth[own][:, None]
                same = home[own, 0] == numbers[b]
                keep[np.flatnonzero(same), home[own[same], 1]] = False
                q, place = np.nonzero(keep)
                rows = np.zeros(len(q), kind)
                rows["q"], rows["id"], rows["b"], rows["at"] = own[q], keys[b][place], b, place
                new.append(rows)
                paid.append(met[q, place])
            if len(new) == 1:
                continue
            found, scores = np.concatenate(new), np.concatenate([p.astype(bounds.dtype) for p in paid])
            ranked = np.lexsort((found["at"], numbers[found["b"]], found["id"], -scores, found["q"]))
            found, scores = found[ranked], scores[ranked]
            starts = np.searchsorted(found["q"], np.arange(len(queries)))
            rank = np.arange(len(found)) - starts[found["q"]]
            last = rank == self.k - 1
            kth[found["q"][last]], kth_id[found["q"][last]] = scores[last], found["id"][last]
            found, scores = found[rank < self.k], scores[rank < self.k]
        return [
            {
                "query_block": int(home[r["q"], 0]), "query_at": int(home[r["q"], 1]), "query_id": self.queries[r["q"]][2],
                "vec_id": self.blocks[r["b"]]["ids"][r["at"]], "block": int(numbers[r["b"]]), "at": int(r["at"]),
                "score": int(s),
            }
            for r, s in zip(found, scores, strict=True)
        ]


_FOUND = "query_block long, query_at int, query_id long, vec_id long, block long, at int, score long"


def _searched(k: int):
    kinds = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, own = _Cell(k), None
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if (row["stripe"], row["share"]) != own:
                    if found := cell.best():
                        yield pa.RecordBatch.from_pylist(found, schema)
                    cell, own = _Cell(k), (row["stripe"], row["share"])
                cell.add(row)
        if found := cell.best():
            yield pa.RecordBatch.from_pylist(found, schema)

    return run


def build_index(vectors: DataFrame, k: int, every: int) -> DataFrame:
    """The blocks of all vectors of ``(vec_id, vector)``, written: ids, vectors, and the range of every component.

    Vectors are ordered by length, closest pivot and the product with it, so that a block's vectors are alike; equal ones follow each other by id.
    Pivots are a sample of PIVOTS vectors (the first by hash): they decide which vectors share a block, and nothing else.
    """
    vectors = materialized(vectors)
    sample = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(PIVOTS).collect()  # a fixed number
    pivots = _matrix([r["vector"][: CELLS // PIVOTS] for r in sample]).astype(float)
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1) if pivots.size else 1
    if not sample:
        return materialized(vectors.mapInArrow(_blocks(k, every), _BLOCK_SCHEMA))
    keyed = vectors.mapInArrow(_nearest(pivots), "vec_id long, vector array<long>, length int, pivot int, near double")
    order = ["length", "pivot", "near", "vec_id"]
    dealt = keyed.repartitionByRange(parallelism(vectors), *order).sortWithinPartitions(*order)
    return materialized(dealt.mapInArrow(_blocks(k, every), _BLOCK_SCHEMA))


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every`` the k other rows of highest inner product.

    Products are of whole numbers (see ``integers``), exact, over the components that both vectors have; one beyond
    a long's range counts as its end. Ties go to the smaller ``vec_id``, rows without an id come after
    those with one, equal ids by their place in the index. Every row is a candidate but the query's own: repeated rows of an id
    are candidates of each other, and each is a query. Fewer rows than k: all. Other columns are ignored. No rows: none.

    Queries and blocks meet in cells of about QUERIES queries and STRIPE blocks. In a cell every
    query visits blocks by their bounds, highest first, until the next bound is below its kth score; it
    starts with the kth score of its own block. What cells find is ranked once more.
    """
    index = build_index(integers(vectors), k, every)
    counts = index.agg(F.count("*"), F.sum(F.size("queries"))).first()
    stripes, shares = (max(1, -(-(n or 0) // most)) for n, most in zip(counts, (STRIPE, QUERIES), strict=True))
    deal = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 40))
    asked = index.where("size(queries) > 0")
    none = F.array().cast("array<long>")
    queries = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), (deal("block") % shares).cast("int").alias("share"),
        F.lit(True).alias("is_query"), "block", F.col("query_ids").alias("ids"), "dims", "width", F.col("query_vectors").alias("vectors"),
        "queries", "floors", none.alias("low"), none.alias("high"),
    )
    blocks = index.select(
        (deal("block", F.lit(1)) % stripes).cast("int").alias("stripe"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.lit(False).alias("is_query"), "block", "ids", "dims", "width", "vectors",
        F.array().cast("array<int>").alias("queries"), none.alias("floors"), "low", "high",
    )
    cells = queries.union(blocks).repartition(parallelism(index), "stripe", "share")
    found = cells.sortWithinPartitions("stripe", "share").mapInArrow(_searched(k), _FOUND)
    best = Window.partitionBy("query_block", "query_at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "block", "at")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
