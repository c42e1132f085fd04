"""Cross-tokenizer alignment: groups of tokens between common borders, and the pairs of ids they link."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, sized, slices
from campuslake.llm.token_output import Encoder

# A pair of ids in one number: the first tokenizer's id above, the second's below.
SHIFT = 32


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as itself, the others as code points from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and for each id of A the id of B with the same bytes (or -1).

    A is a byte-level vocabulary, B one of pieces. A byte piece of B stands for its byte only where no other piece does, so that the map is one to one.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self._a = Encoder(path_a, plain=True)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars, vocabulary = _byte_of_char(), self._a.vocabulary()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in chars for c in token)
            self.bytes_a[i] = bytes(chars[c] for c in token) if known else token.encode()
        b, size = self._b, self._b.get_piece_size()
        self.bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(size)
        ]
        usual = {self.bytes_b[i]: i for i in range(size) if b.is_byte(i)}
        usual |= {self.bytes_b[i]: i for i in range(size) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))}
        self.same = np.array([usual.get(x, -1) for x in self.bytes_a], np.int64)
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # The four forms of an id in the text of groups: A's within and at the end of a group, B's likewise.
        ends = [(len(self.bytes_a), ","), (len(self.bytes_a), "|"), (size, ","), (size, ";")]
        self.forms = np.array([f"{i}{end}" for n, end in ends for i in range(n)], object)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both, A's of the text behind a space; none where the bytes of one are not those of that text."""
        a = [ids.tolist() for ids in self._a.encode([f" {t}" for t in texts])]
        b = self._b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            raw = f" {text}".encode()
            if not text or b"".join(map(self.bytes_a.__getitem__, a[k])) != raw or b"".join(map(self.bytes_b.__getitem__, b[k])) != raw:
                a[k], b[k] = [], []
        return a, b

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: ids of A and B, groups, their checksum, A's ids of plain links, and the other links with numbers."""
        a, b = self.encode(texts)
        counts_a, counts_b = (np.array([len(x) for x in own], np.int64) for own in (a, b))
        a, b = (np.fromiter((i for x in own for i in x), np.int64, int(n.sum())) for own, n in ((a, counts_a), (b, counts_b)))
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        border = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.int8)
        border[ends_a] += 1
        border[ends_b] += 2
        last_a, last_b = border[ends_a] == 3, border[ends_b] == 3
        to_a, to_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        many_a, many_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        link_a, link_b = a[last_a], b[last_b]
        plain = (many_a == 1) & (many_b == 1) & (self.same[link_a] == link_b)
        # Where each token stands when the groups are written one behind the other.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        written = np.zeros(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + (to_b - many_b)[group_a]] = a + len(self.bytes_a) * last_a
        written[np.arange(len(b)) + to_a[group_b]] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * last_b
        stop_a, stop_b = np.cumsum(counts_a), np.cumsum(counts_b)
        groups = np.searchsorted(to_a, stop_a, "right")
        start, first = 0, 0
        for n_a, n_b, stop, group in zip(counts_a.tolist(), counts_b.tolist(), (stop_a + stop_b).tolist(), groups.tolist(), strict=True):
            own = "".join(self.forms[written[start:stop]].tolist())[:-1]
            told = hashlib.sha256(own.encode()).hexdigest() if own else ""
            is_plain = plain[first:group]
            pairs = (link_a[first:group][~is_plain] << SHIFT) | link_b[first:group][~is_plain]
            yield (n_a, n_b, group - first, told, link_a[first:group][is_plain], *np.unique(pairs, return_counts=True))
            start, first = stop, group


def _pair(path_a: str, path_b: str) -> Pair:
    """The worker's tokenizers, kept for its next tasks."""
    kept = sys.__dict__.setdefault("_token_pairs", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Pair(path_a, path_b)
    return kept[path_a, path_b]


_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, plain binary, "
    "pairs array<long>, times array<long>"
)


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = _pair(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in slices(batch):
                found = list(pair.align([t or "" for t in piece.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(found))), piece.column("doc_id"),
                        *[pa.array([f[k] for f in found], pa.int64()) for k in range(3)], pa.array([f[3] for f in found], pa.string()),
                        pa.array([f[4].astype("<i4").tobytes() for f in found], pa.binary()),
                        *[pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (5, 6)],
                    ],
                    names=[c.split()[0] for c in _ALIGNED.split(", ")],
                )
                row += len(found)

    return run


def align_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """Every document's alignment, written: numbers of tokens and groups, the groups' checksum, and its links.

    A text is cut into groups where a token of A and one of B end at the same byte; these two are linked. ``plain`` holds
    A's ids (little-endian 32-bit) of links whose group is one token each, B's by the map of equal bytes; ``pairs`` and
    ``times`` the other links, distinct pairs of ids and how often. Null or empty texts, and those that one of the
    tokenizers does not give back byte by byte, have no tokens. Each row counts for itself, with a ``row``
    number of its own: ids may be null or repeated. Other columns are ignored. No rows: none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialized(rows.mapInArrow(_aligned(tokenizer_a, tokenizer_b), _ALIGNED))


def _plain_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector of the length of A's vocabulary a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch, "plain"):
            ids = np.frombuffer(b"".join(part.column("plain").to_pylist()), "<i4")
            own = np.bincount(ids, minlength=len(total))
            own[: len(total)] += total
            total = own
    ids = np.flatnonzero(total)
    if len(ids):
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["a", "n"])


def pair_counts(aligned: DataFrame, same: np.ndarray) -> DataFrame:
    """``(pair, a, b, n, best)``, written: in how many links each pair of ids stands, and whether no pair of its B id has more.

    Plain links are counted in a vector of A's ids for each task; only the others are shuffled as pairs.
    """
    spark = aligned.sparkSession
    plain = aligned.select("plain").mapInArrow(_plain_counts, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    known = np.flatnonzero(same >= 0)  # one row for each id of the vocabulary
    usual = spark.createDataFrame(list(zip(known.tolist(), same[known].tolist(), strict=True)), "a long, b long")
    plain = plain.join(usual, "a").select(F.shiftleft("a", SHIFT).bitwiseOR(F.col("b")).alias("pair"), "n")
    other = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    both = plain.union(other.agg(F.sum("x.times").alias("n"))).groupBy("pair").agg(F.sum("n").alias("n"))
    told = materialized(
        both.select("pair", F.shiftright("pair", SHIFT).alias("a"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).alias("b"), "n")
    )
    most = told.groupBy("b").agg(F.max("n").alias("most"))
    return materialized(told.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")))


def _plain_sums(counts: np.ndarray, best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, "<i4") for x in batch.column("plain").to_pylist()]
            sums = [[int(own.sum()) for own in (best[i], counts[i])] for i in ids]
            columns = [c for c in batch.schema.names if c != "plain"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *[pa.array([s[k] for s in sums], pa.int64()) for k in range(2)]],
                names=[*columns, "n_best", "count_sum"],
            )

    return run


def link_sums(aligned: DataFrame, counts: DataFrame, same: np.ndarray) -> DataFrame:
    """Each row of ``aligned`` with ``n_best`` links whose count is their B id's highest, and the ``count_sum`` of all.

    Counts of plain pairs travel as two vectors of A's vocabulary; those of the others are joined, by broadcast if few.
    """
    spark = aligned.sparkSession
    usual = spark.createDataFrame([(int(a), int(same[a])) for a in np.flatnonzero(same >= 0)], "a long, b long")
    vector, best = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    for row in counts.join(usual, ["a", "b"]).select("a", "n", "best").collect():  # a row for an id of the vocabulary at most
        vector[row["a"]], best[row["a"]] = row["n"], row["best"]
    base = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "plain")
    told = base.mapInArrow(
        _plain_sums(vector, best),
        "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long",
    )
    each = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    met = each.join(sized(counts.select("pair", "n", "best"), 24), "pair").groupBy("row")
    met = met.agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    zero = F.lit(0).cast("long")
    return told.join(met, "row", "left").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )


def alignment_digests(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row for each document: its tokens, groups and links, and how usual these are in the corpus."""
    same = _pair(tokenizer_a, tokenizer_b).same
    aligned = align_documents(docs, tokenizer_a, tokenizer_b)
    return link_sums(aligned, pair_counts(aligned, same), same).drop("row")
