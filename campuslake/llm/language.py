"""Language identification by string kernels, Nystroem landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import held_out, mix, slices

# Buckets of the presence features, by n-gram order.
REGIONS = {1: 512, 2: 2048, 3: 5632}
WIDTH = sum(REGIONS.values())
PER_LANGUAGE = 256
LANDMARKS = 192
RIDGE = 1.0
UNKNOWN = "und"


@dataclass
class KernelModel:
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """One-versus-rest outputs: two matrix products for a batch of rows."""
        return (features @ self.landmarks.T) @ self.weights


def identify_language(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every document.

    The kernel of two texts is the mean, over n-gram orders 1 to 3, of the n-grams that
    are present in both (lower case, letters only, anything else one blank), normalised by
    the geometric mean of the numbers present; n-grams are hashed to a fixed width. Ridge
    regression, one output per language, is solved on Nystroem features of LANDMARKS texts.

    It learns from at most PER_LANGUAGE texts of each language, those first by a hash of
    the id, out of rows with text and language outside the held-out fifth; the languages
    learned pass through the driver. Null text or text without a letter: ``und``, score 0.
    Without anything to learn all are ``und``. Repeated ids are predicted row by row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = _learned(docs)
    marked = rows.mapInArrow(_predicted(model), "doc_id long, lang_pred string, score double")
    return marked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _learned(docs: DataFrame) -> KernelModel | None:
    known = docs.where("text is not null and lang is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang_known"))
    first = Window.partitionBy("lang_known").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= PER_LANGUAGE)
    chosen = chosen.select("doc_id", "lang_known").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    # At most PER_LANGUAGE rows a language: a proven bound.
    sample = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(
        _packed, "doc_id long, lang_known string, bits binary"
    )
    found = sorted(sample.collect(), key=lambda r: (r["lang_known"], r["doc_id"], bytes(r["bits"])))
    if not found:
        return None
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in found), np.uint8).reshape(len(found), -1)
    present = np.unpackbits(bits, axis=1)[:, :WIDTH]
    return train(normalised(present), [r["lang_known"] for r in found])


def train(x: np.ndarray, marks: list[str]) -> KernelModel:
    languages = sorted(set(marks))
    y = np.where(np.array(marks)[:, None] == np.array(languages), 1.0, -1.0)
    chosen = np.random.default_rng(7).permutation(len(x))[:LANDMARKS]
    landmarks = x[chosen]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    kept = values > 1e-6 * values[-1]
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = (x @ landmarks.T) @ root
    gram = features.T @ features + RIDGE * np.eye(features.shape[1])
    # Languages count alike, however many texts each has.
    share = (y > 0) @ (1 / np.maximum((y > 0).sum(0), 1)) * len(y) / len(languages)
    weighted = features * share[:, None]
    gram = weighted.T @ features + RIDGE * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(gram, weighted.T @ y)
    return KernelModel(languages, landmarks.astype(np.float32), weights.astype(np.float32))


def normalised(present: np.ndarray) -> np.ndarray:
    """Presence rows scaled so that their products are the blended kernel."""
    x = present.astype(np.float32)
    start = 0
    for width in REGIONS.values():
        part = x[:, start : start + width]
        counts = part.sum(1, keepdims=True)
        part /= np.sqrt(np.maximum(counts, 1) * len(REGIONS))
        start += width
    return x


def letter_codes() -> np.ndarray:
    """Each code point itself if it is a letter, else 0."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32)


def presence(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams each text has, and whether it has a letter."""
    lowered = [t.lower() for t in texts]
    codes = letters[np.frombuffer(" ".join(lowered).encode("utf-32-le"), np.uint32)].astype(np.uint64)
    lengths = np.array([len(t) for t in lowered])
    # The blank between two texts belongs to the first; n-grams that reach beyond it don't count.
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[: len(codes)]
    out = np.zeros((len(texts), WIDTH), np.uint8)
    flat, start = out.reshape(-1), 0
    hashed = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for order, width in REGIONS.items():
            n = len(codes) - order + 1
            if n <= 0:
                break
            hashed = hashed[:n] * np.uint64(0x100000001B3) + codes[order - 1 :] + np.uint64(1)
            own = owner[:n]
            inside = (own == owner[order - 1 :]) & (hashed != 0)
            place = (mix(hashed[inside]) % np.uint64(width)).astype(np.int64)
            flat[own[inside] * WIDTH + start + place] = 1
            start += width
    lettered = np.zeros(len(texts), bool)
    lettered[owner[codes > 0]] = True
    return out, lettered


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_codes()
    for batch in batches:
        for part in slices(batch):
            present, _ = presence(part.column("text").to_pylist(), letters)
            rows = [x.tobytes() for x in np.packbits(present, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang_known"), pa.array(rows, pa.binary())],
                names=["doc_id", "lang_known", "bits"],
            )


def _predicted(model: KernelModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_codes()
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                for start in range(0, len(texts) if model else 0, 1024):
                    present, lettered = presence(texts[start : start + 1024], letters)
                    found = model.scores(normalised(present))
                    best = found.argmax(1)
                    for i in np.flatnonzero(lettered).tolist():
                        names[start + i] = model.languages[best[i]]
                        scores[start + i] = float(np.clip((1 + found[i, best[i]]) / 2, 0, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run
