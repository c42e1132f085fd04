"""Exact search against all products, on ties, odd vectors and numbers beyond a float's whole range."""

import math

import duckdb
import numpy as np
import pytest

from campuslake.llm import topk
from campuslake.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(vectors, k=10, every=100):
    clip = lambda x: max(LOW, min(HIGH, x))
    whole = [(i, [clip(math.floor(x * 1024)) for x in v]) for i, v in vectors if usable(v)]
    out = []
    for at, (query, q) in enumerate(whole):
        if query is None or query % every:
            continue
        met = [(-clip(sum(a * b for a, b in zip(q, v, strict=False))), i is None, i or 0, i) for n, (i, v) in enumerate(whole) if n != at]
        out += [(query, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(met, key=lambda m: m[:3])[:k])]
    return sorted(out, key=str)


def found(spark, vectors, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, block string, score int")
    return sorted((tuple(r) for r in topk.search(df, **options).collect()), key=str)


def test_search_is_all_products_and_sql(spark):
    tables = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = rows(QUERIES["op12_topk_search"](spark, FOLDER))
    assert sorted(got, key=str) == expected([tuple(r) for r in tables])
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
    assert sorted(con.execute(ORACLE_SQL["op12_topk_search"]).fetchall()) == got


@pytest.mark.parametrize("block", [1, 3, 256])
def test_ties_and_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "STRIPE", 5)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(4, 6))
    vectors = [(i, np.round(centres[i % 4] + 0.1 * rng.normal(size=6), 1 + i % 2).tolist()) for i in range(150)]
    vectors += [(i, [0.5] * 6) for i in range(150, 230)]  # a third of the rows are one vector
    assert found(spark, vectors, k=5, every=10) == expected(vectors, 5, 10)


def test_bounds_end_the_search_early(spark):
    rng = np.random.default_rng(1)
    centres = np.eye(8) * 9
    whole = np.concatenate([np.round(1024 * (c + 0.05 * rng.normal(size=(40, 8)))) for c in centres]).astype(np.int64)
    blocks = [whole[k : k + 40] for k in range(0, 320, 40)]
    cell = topk._Cell(3)
    for number, own in enumerate(blocks):
        cell.add({"is_query": False, "block": number, "ids": list(range(40 * number, 40 * number + 40)), "dims": 8, "width": 8,
                  "vectors": own.tobytes(), "low": own.min(0).tolist(), "high": own.max(0).tolist()})
    cell.add({"is_query": True, "block": 2, "ids": [80], "dims": 8, "width": 8, "vectors": blocks[2][:1].tobytes(), "queries": [0], "floors": [None]})
    seen, plain = [], topk._products
    try:
        topk._products = lambda a, b: seen.append(len(b)) or plain(a, b)
        got = cell.best()
    finally:
        topk._products = plain
    assert len(seen) == 1 and len(got) == 3 and all(80 < r["vec_id"] < 120 for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, []), (200, None), (300, [nan, 1.0]), (400, [1.0, None]), (None, [3.0]), (None, [3.0]),
               (5, [inf, 0.0]), (6, [-0.0004, 0.5]), (700, [1.0] * 7), (8, [-1.0, 2.0, 3.0]), (9, [0.0, 0.0])]
    assert found(spark, vectors, k=4) == expected(vectors, 4)
    assert found(spark, vectors) == expected(vectors)
    assert found(spark, [(0, [1.0])]) == [] == found(spark, []) == found(spark, [(1, [1.0]), (2, [1.0])])


def test_numbers_beyond_a_floats_whole_range(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, (rng.normal(size=5) * 10.0 ** rng.integers(0, 9)).tolist()) for i in range(60)]
    vectors += [(i, (rng.normal(size=5) * 1e17).tolist()) for i in range(60, 80)]
    assert found(spark, vectors, k=7, every=5) == expected(vectors, 7, 5)
