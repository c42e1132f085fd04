"""Quality scores by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import held_out, materialized, slices
from campuslake.session import scratch

FEATURES = 13
SHRINKAGE = 0.1
RIDGE = 1e-3
THRESHOLD = 0.3

# Kinds of characters that are counted.
_LOWER, _UPPER, _DIGIT, _SPACE, _BREAK, _STOP, _SYMBOL, _OTHER = range(8)


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor and half log determinant."""

    labels: list[int]
    priors: np.ndarray
    means: np.ndarray
    whiteners: list[np.ndarray]
    half_logdets: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics."""
        if self.labels == [0, 1]:
            logs = []
            for k in range(2):
                z = (x - self.means[k]) @ self.whiteners[k].T
                logs.append(self.priors[k] - self.half_logdets[k] - 0.5 * np.einsum("ij,ij->i", z, z))
            return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        return np.full(len(x), float(self.labels[0]) if self.labels else 0.5)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document.

    Statistics of the whole text (lengths, kinds of characters, variety of words and
    lines, entropy), each transformed by a logarithm, square root or log-odds, are modelled
    per class by a Gaussian whose covariance is shrunk towards the pooled diagonal. The
    score is the sigmoid of the difference of the Mahalanobis log densities plus priors;
    the Cholesky factors are computed once. Sums and products of the statistics are
    aggregated over all labelled rows outside the held-out fifth; nothing is sampled.

    Null text counts as empty and is scored too. Null labels or ids teach nothing; an id
    with several labels counts once for each distinct one. With one class only, its label
    is the score; without labels 0.5. Repeated ids are scored row by row. Other columns
    of either table are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = materialized(rows.mapInArrow(_statistics, "doc_id long, x array<double>"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marks = marks.where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    model = fit(stats.join(marks, "doc_id"))
    scored = stats.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted 1, with their columns; the others go.

    The decision joins back by id: of a repeated id with differing texts, all rows go if
    one is rejected. A document without an id stays.
    """
    with scratch(docs.sparkSession) as keep:
        bad = keep(score_quality(docs, labels).where("predicted = 0 and doc_id is not null").select("doc_id").distinct())
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


def fit(marked: DataFrame) -> Discriminant:
    """The model of rows ``(x, label)``, from their moments alone."""
    parts = marked.select("label", "x").mapInArrow(_moments, "label int, k int, v double")
    rows = parts.groupBy("label", "k").agg(F.sum("v").alias("v")).collect()
    found = sorted({r["label"] for r in rows})
    width = 1 + FEATURES + FEATURES * FEATURES
    sums = np.zeros((len(found), width))
    for r in rows:
        sums[found.index(r["label"]), r["k"]] = r["v"]
    counts = sums[:, 0]
    means = sums[:, 1 : 1 + FEATURES] / counts[:, None]
    squares = sums[:, 1 + FEATURES :].reshape(-1, FEATURES, FEATURES)
    own = [squares[k] / counts[k] - np.outer(means[k], means[k]) for k in range(len(found))]
    if len(found) < 2:
        return Discriminant(found, np.zeros(0), means, [], np.zeros(0))
    pooled = sum(n * c for n, c in zip(counts, own, strict=True)) / counts.sum()
    target = np.diag(np.diag(pooled) + RIDGE)
    factors = [np.linalg.cholesky((1 - SHRINKAGE) * c + SHRINKAGE * target) for c in own]
    return Discriminant(
        found,
        np.log(counts / counts.sum()),
        means,
        [np.linalg.inv(f) for f in factors],
        np.array([np.log(np.diag(f)).sum() for f in factors]),
    )


def _kinds() -> np.ndarray:
    """The kind of each code point of the basic plane; the last entry is for all others."""
    kinds = np.full(65536, _OTHER, np.uint8)
    for code in range(65535):
        c = chr(code)
        if c.islower():
            kinds[code] = _LOWER
        elif c.isupper():
            kinds[code] = _UPPER
        elif c.isdigit():
            kinds[code] = _DIGIT
        elif c == "\n":
            kinds[code] = _BREAK
        elif c.isspace():
            kinds[code] = _SPACE
        elif c in ".,;:!?'\"()-":
            kinds[code] = _STOP
        elif not c.isalpha():
            kinds[code] = _SYMBOL
    return kinds


def statistics(text: str, kinds: np.ndarray) -> list[float]:
    """The transformed statistics of one text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(codes)
    count = np.bincount(kinds[np.minimum(codes, 65535)], minlength=8)
    words = text.split()
    lines = text.split("\n")
    different = set(words)
    letters = count[_LOWER] + count[_UPPER]
    spread = np.bincount(codes % 1024)
    spread = spread[spread > 0] / max(n, 1)
    odds = lambda part, whole: float(np.log((part + 0.5) / (whole - part + 0.5)))
    return [
        float(np.log1p(n)),
        float(np.log1p((n - count[_SPACE]) / max(len(words), 1))),
        odds(count[_UPPER], letters),
        odds(count[_DIGIT], n),
        odds(count[_STOP], n),
        odds(count[_SYMBOL], n),
        odds(letters, n),
        float(np.log1p(len(different)) / np.log(len(words) + 2)),
        float(np.sqrt(len(set(lines)) / len(lines))),
        float(-(spread * np.log(spread)).sum()),
        float(np.log1p(len(words) / len(lines))),
        float(np.log1p(max(map(len, different), default=0))),
        odds(count[_OTHER], n),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = _kinds()
    for batch in batches:
        for part in slices(batch):
            rows = [statistics(t or "", kinds) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, 1 + FEATURES + FEATURES * FEATURES))
    for batch in batches:
        x, y = _matrix(batch.column("x")), batch.column("label").to_numpy()
        for label in (0, 1):
            own = x[y == label]
            sums[label] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
    for label in (0, 1):
        if sums[label, 0]:
            width = sums.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(width, label, np.int32)),
                    pa.array(np.arange(width, dtype=np.int32)),
                    pa.array(sums[label]),
                ],
                names=["label", "k", "v"],
            )


def _scored(model: Discriminant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    return run
