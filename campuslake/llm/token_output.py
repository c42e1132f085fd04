"""Token ids in Simple-8b words: 64 bits with a selector and as many ids as fit."""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, parallelism, slices

# Fixed values of the format: ids per word and bits per id, by selector. Selector 0 is an
# escape: the next word holds one id whole.
COUNTS = [0, 240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]

BLOCK = 1024
CACHED_PIECES = 600_000
LEARNED_TOGETHER = 10_000
_SEPARATOR = "\n"


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the ids, and where each block of BLOCK ids starts among them.

    Every word takes as many ids as the selector with the most allows. All blocks are
    packed at once, a word of each at a time; a last word holds fewer ids than its selector says.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    lanes = -(-n // BLOCK)
    padded = np.zeros(lanes * BLOCK, np.uint64)
    padded[:n] = ids
    selector = np.zeros(len(padded), np.uint8)
    fits = np.zeros(len(padded), np.int16)
    room = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), lanes)
    highest = {1: padded}
    for s in range(15, 0, -1):
        count = COUNTS[s]
        ok = _sliding_max(padded, count, highest) < (np.uint64(1) << np.uint64(BITS[s]))
        selector[ok], fits[ok] = s, count
    escape = fits == 0
    step = np.minimum(np.where(escape, 1, fits), room)
    at = np.arange(lanes) * BLOCK
    stop = at + BLOCK
    lane, starts, lane_of = np.arange(lanes), [], []
    while len(at):
        starts.append(at)
        lane_of.append(lane)
        at = at + step[at]
        going = at < stop
        at, lane, stop = at[going], lane[going], stop[going]
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts, lane_of = np.concatenate(starts), np.concatenate(lane_of)
    order = np.argsort(starts, kind="stable")
    starts, lane_of = starts[order], lane_of[order]
    width = 1 + escape[starts].astype(np.int64)
    places = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint64)
    chosen = selector[starts]
    for s in range(1, 16):
        own = chosen == s
        if own.any() and BITS[s]:
            first = starts[own]
            word = np.full(len(first), s, np.uint64) << np.uint64(60)
            room_left = room[first]
            for i in range(COUNTS[s]):
                value = padded[np.minimum(first + i, len(padded) - 1)]
                word |= np.where(i < room_left, value, 0).astype(np.uint64) << np.uint64(i * BITS[s])
            out[places[own]] = word
        elif own.any():
            out[places[own]] = np.uint64(s) << np.uint64(60)
    own = escape[starts]
    out[places[own] + 1] = padded[starts[own]]
    block_starts = places[np.searchsorted(lane_of, np.arange(lanes))]
    return out, block_starts


def _sliding_max(values: np.ndarray, count: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """The largest of ``count`` values from each place on; beyond the end there are none."""
    half = 1
    while half * 2 <= count:
        if half * 2 not in known:
            known[half * 2] = _shifted_max(known[half], half)
        half *= 2
    if half == count:
        return known[half]
    tail = known[half]
    out = tail.copy()
    k = count - half
    out[:-k] = np.maximum(tail[:-k], tail[k:]) if k < len(tail) else tail[:-k]
    return out


def _shifted_max(values: np.ndarray, k: int) -> np.ndarray:
    out = values.copy()
    if k < len(values):
        np.maximum(values[:-k], values[k:], out=out[:-k])
    return out


def decode_blocks(words: np.ndarray, block_starts: np.ndarray, n: int) -> np.ndarray:
    """The n ids of the words; blocks are independent, so all are decoded at once."""
    words = np.asarray(words, np.uint64)
    lanes = len(block_starts)
    out = np.zeros(lanes * BLOCK, np.uint64)
    at = np.asarray(block_starts, np.int64).copy()
    filled = np.arange(lanes) * BLOCK
    stop = np.minimum(filled + BLOCK, n)
    counts, places, payload = [], [], []
    while len(at):
        word = words[at]
        s = (word >> np.uint64(60)).astype(np.int64)
        escaped = s == 0
        count = np.where(escaped, 1, np.array(COUNTS)[s])
        count = np.minimum(count, stop - filled)
        body = np.where(escaped, words[np.minimum(at + 1, len(words) - 1)], word)
        counts.append(np.where(escaped, 0, s))
        places.append(filled)
        payload.append(body)
        filled = filled + count
        at = at + 1 + escaped
        going = filled < stop
        at, filled, stop = at[going], filled[going], stop[going]
    if not counts:
        return out[:0]
    kind, place, body = np.concatenate(counts), np.concatenate(places), np.concatenate(payload)
    out[place[kind == 0]] = body[kind == 0]
    last = np.minimum((place // BLOCK + 1) * BLOCK, n)
    for s in range(2, 16):
        own = kind == s
        if own.any():
            first, word, end = place[own], body[own], last[own]
            mask = (np.uint64(1) << np.uint64(BITS[s])) - np.uint64(1)
            for i in range(COUNTS[s]):
                ok = first + i < end
                out[first[ok] + i] = (word[ok] >> np.uint64(i * BITS[s])) & mask
    return out[:n]


# Kinds of characters, as the vocabulary's own splitting tells them apart.
_VISIBLE, _SPACE, _LETTER, _MARK, _END = range(5)
# No piece has a blank behind a visible character.
_BORDER = "| |"


def _kinds() -> np.ndarray:
    """The kind of each code point. 1C to 1F are white space to Python, not to the vocabulary."""
    kinds = np.full(0x110000, _VISIBLE, np.uint8)
    space = [c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
    kinds[space] = _SPACE
    kinds[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = _MARK
    kinds[[c for c in range(0x100) if chr(c).isalpha() and (c < 0x80 or c >= 0xC0)]] = _LETTER
    return kinds


class Encoder:
    """Ids of texts; equal pieces of a text are encoded once.

    The vocabulary's own splitting starts a new unit at every white space behind a visible
    character, and gives the word behind a run of white space its last blank at most; a
    letter and ASCII punctuation behind it are never of one unit. So a run's rest, each word
    with its blank and the punctuation behind it have their ids each for itself. New words are
    encoded together, line by line, and split at the line breaks.

    Special strings of the vocabulary have their own ids where they stand in a text, as the
    library gives them, and split it; with ``plain`` they are text like any other.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        self._kinds = _kinds()
        self._known: dict[str, bytes] = {}
        added = {} if plain else self._tokenizer.get_added_tokens_decoder()
        self._special = {t.content: np.array([i], np.uint32).tobytes() for i, t in added.items()}
        self._known.update(self._special)
        longest = sorted(self._special, key=len, reverse=True)
        self._split = re.compile("|".join(map(re.escape, longest))) if longest else None
        (self._break,) = self._whole(_SEPARATOR).tolist()

    def vocabulary(self) -> dict[str, int]:
        """All tokens as the vocabulary writes them, and their ids."""
        return self._tokenizer.get_vocab(with_added_tokens=True)

    def _whole(self, text: str) -> np.ndarray:
        (found,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _learn(self, words: list[str]) -> None:
        """Encode new pieces, the words among them together."""
        ids = self._whole(_SEPARATOR.join(words))
        cuts = np.flatnonzero(ids == self._break)
        if len(cuts) != len(words) - 1:
            self._known.update((w, self._whole(w).tobytes()) for w in words)
            return
        raw = ids.tobytes()
        starts, ends = np.append(0, 4 * (cuts + 1)).tolist(), np.append(4 * cuts, len(raw)).tolist()
        self._known.update((w, raw[a:b]) for w, a, b in zip(words, starts, ends, strict=True))

    def _cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """All texts in one, its code points, where its pieces start, and what ends the texts' parts.

        A part ends with a character of its own, whose piece stands for a special string of the
        text or, as _BORDER, for its end; the last two tell these and their places among the pieces.
        """
        parts, borders, at = [], [], -1
        for text in texts:
            cuts = [*self._split.finditer(text)] if self._split and any(s in text for s in self._special) else []
            start = 0
            for cut in [*cuts, None]:
                stop = cut.start() if cut else len(text)
                parts.append(text[start:stop])
                at += stop - start + 1
                borders.append((at, cut.group() if cut else _BORDER))
                start = cut.end() if cut else stop
        joined = "\0".join([*parts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self._kinds[points]
        ends = np.array([b for b, _ in borders])
        kind[ends] = _END
        blank = points == 0x20
        space = kind == _SPACE
        visible = ~space & (kind != _END)
        before = np.append(False, visible[:-1])  # a visible character stands before
        after = np.append(visible[1:], False)
        own_blank = np.append(False, blank[:-1])
        word = visible & ~before
        starts = (word & ~own_blank) | (space & after) | (space & ~np.append(False, space[:-1]))
        starts[ends] = True
        # Letters at a word's start are a piece of their own where ASCII punctuation follows.
        firsts, others = np.flatnonzero(word), np.flatnonzero(visible & (kind != _LETTER))
        found = np.append(others, len(kind) - 1)[np.searchsorted(others, firsts)]
        cut = (found > firsts) & (kind[found] == _MARK)
        # the characters between are letters, unless the word ended before
        gaps = np.cumsum(~visible)
        cut &= gaps[found] == gaps[firsts]
        starts[found[cut]] = True
        place = np.flatnonzero(starts)
        return joined, points, place, [mark for _, mark in borders], np.searchsorted(place, ends)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Equal pieces are found by Arrow, as numbers; only one of each is a string."""
        if not texts:
            return []
        joined, points, place, marks, stops = self._cut(texts)
        raw = joined.encode()
        if len(raw) > len(joined):  # where each code point starts in UTF-8
            width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            place = (np.cumsum(width) - width)[place]
        bounds = np.append(place, len(raw)).astype(np.int64)
        cut = pa.LargeStringArray.from_buffers(len(place), pa.py_buffer(bounds), pa.py_buffer(raw))
        numbered = cut.dictionary_encode()
        own, number = numbered.dictionary.to_numpy(False).tolist(), numbered.indices.to_numpy().copy()
        got = self._ids(own)
        others = {mark: len(own) + k for k, mark in enumerate(dict.fromkeys(marks))}
        got += [b"" if mark == _BORDER else self._special[mark] for mark in others]
        number[stops] = [others[mark] for mark in marks]
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        counts = sizes[number]
        ends = np.cumsum(counts)
        # each piece's ids stand behind one another in those of the distinct pieces
        shift = (np.cumsum(sizes) - sizes)[number] - (ends - counts)
        ids = np.frombuffer(b"".join(got), np.uint32)[np.arange(int(ends[-1])) + np.repeat(shift, counts)]
        return np.split(ids, ends[stops[[mark == _BORDER for mark in marks]]][:-1])

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, as bytes; new ones are learned."""
        known = self._known
        got = list(map(known.get, pieces))
        at = [k for k, x in enumerate(got) if x is None]
        new = [pieces[k] for k in at]
        known.update((p, self._whole(p).tobytes()) for p in new if p.isspace())
        words = [p for p in new if not p.isspace()]
        for k in range(0, len(words), LEARNED_TOGETHER):
            self._learn(words[k : k + LEARNED_TOGETHER])
        for k, p in zip(at, new, strict=True):
            got[k] = known[p]
        if len(known) > CACHED_PIECES:  # the pieces met first, which are the common ones, stay
            for p in new:
                del known[p]
        return got


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encode all documents to files in ascending id order; the files as a frame.

    A file holds a range of ids. Each of its rows is a run of consecutive documents:
    ``part`` (the file's place in the order), ``run``, ``doc_ids``, ``lengths`` (ids of
    each document, end id counted), ``block_starts`` and ``words`` (little-endian 64-bit
    Simple-8b words). Null text is empty: its end id alone. Null ids come first. Rows
    with equal ids stand next to each other, each encoded for itself, ordered by text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(parallelism(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, run int, doc_ids array<long>, lengths array<int>, block_starts array<int>, words binary"
    return materialized(ordered.mapInArrow(_written(tokenizer, end_id), schema))


def read_token_files(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files.

    ``start`` is the number of ids of all documents before it, by sums over the files.
    """
    per_run = files.select("part", "run", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n"))
    per_part = per_run.groupBy("part").agg(F.sum("n").alias("n"))
    parts = {r["part"]: r["n"] for r in per_part.collect()}  # one row per file
    before, base = 0, {}
    for part in sorted(parts):
        base[part], before = before, before + parts[part]
    earlier = Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = per_run.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    spark = files.sparkSession
    starts = spark.createDataFrame(list(base.items()), "part int, base long")
    offsets = runs.join(starts, "part").select("part", "run", (F.col("base") + F.col("inside")).alias("start"))
    decoded = files.mapInArrow(
        _decoded, "part int, run int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(offsets, ["part", "run"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def _encoder(tokenizer: str) -> Encoder:
    """The worker's encoder, kept for its next tasks."""
    kept = sys.__dict__.setdefault("_encoders", {})
    if tokenizer not in kept:
        kept[tokenizer] = Encoder(tokenizer)
    return kept[tokenizer]


def _written(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for piece in slices(batch):
                ids = encoder.encode([t or "" for t in piece.column("text").to_pylist()])
                lengths = [len(x) + 1 for x in ids]
                words, starts = encode_blocks(np.concatenate([x for own in ids for x in (own, end)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([number], pa.int32()),
                        pa.array([piece.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([lengths], pa.list_(pa.int32())),
                        pa.array([starts.tolist()], pa.list_(pa.int32())),
                        pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    ],
                    names=["part", "run", "doc_ids", "lengths", "block_starts", "words"],
                )
                number += 1

    return run


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            (row,) = batch.slice(k, 1).to_pylist()
            lengths = np.array(row["lengths"], np.int64)
            ids = decode_blocks(np.frombuffer(row["words"], "<u8"), np.array(row["block_starts"]), int(lengths.sum()))
            ends = np.cumsum(lengths)
            raw = ids.astype("<u4").tobytes()
            sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), row["part"], np.int32)),
                    pa.array(np.full(len(ends), row["run"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "run", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )
