"""Chat formatting that survives a round trip through its own grammar."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, parallelism

# Fixed values of the template: the strings that open and close a turn of each role.
# Another role's name stands in its opening string, with unusual characters as %XX.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
OTHER_CLOSE = "<|end|>"

_MARK = r"<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<\|[\w.%~-]*\|>"
_LIVE = re.compile(rf"(?<!\\)(?:{_MARK})")
_ANY = re.compile(rf"(?={_MARK})")
_ESCAPED = re.compile(rf"\\(?={_MARK})")
_ROLES = {opening: role for role, (opening, _) in MARKS.items()}


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str) -> str:
    """A backslash before every control string, whatever stands there already."""
    return _ANY.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def _marks(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"<|role-{quote(role, safe='')}|>", OTHER_CLOSE)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns ``(role, text, start, end)`` of a formatted text; the span is that of the escaped text."""
    turns, at = [], 0
    marks = _LIVE.finditer(text)
    for opening in marks:
        closing = next(marks, None)
        if opening.start() != at or closing is None:
            raise GrammarError("a turn must open where the last one closed, and close")
        name = opening.group()
        role = _ROLES.get(name)
        if role is None and name.startswith("<|role-"):
            role = unquote(name[7:-2])
        start, end = opening.end() + 1, closing.start() - 1
        if role is None or closing.group() != _marks(role)[1]:
            raise GrammarError("the strings around a turn don't belong together")
        if start > end or text[start - 1] != " " or text[end] != " ":
            raise GrammarError("a turn's text stands between spaces")
        turns.append((role, unescape(text[start:end]), start, end))
        at = closing.end()
    if at != len(text):
        raise GrammarError("text outside the turns")
    return turns


def render(role: str, text: str) -> str:
    """One turn, its text escaped as often as it takes for the parser to return the source."""
    opening, closing = _marks(role)
    body = text
    while True:
        turn = f"{opening} {body} {closing}"
        try:
            if [t[:2] for t in parse(turn)] == [(role, text)]:
                return turn
        except GrammarError:
            pass
        longer = escape(body)
        if longer == body:
            raise ValueError("a text without control strings must round trip")
        body = longer


def format_conversations(rows: DataFrame) -> DataFrame:
    """Formatted conversations ``(conv_id, text, loss_spans)``, written and read back.

    ``loss_spans`` lists start and end of each assistant text, as it stands in ``text``.
    Turns are ordered by turn, then role and text, so ties and repeated rows have a fixed
    order and all stay. Null text or role: empty; a null turn comes first; rows without
    an id form one conversation. Other columns are ignored. A conversation is one output
    row, put together from sorted rows by a stream that holds no other one.
    """
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = clean.repartition(parallelism(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return materialized(dealt.mapInArrow(_formatted, "conv_id long, text string, loss_spans array<int>"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, parsed from the formatted texts."""
    return formatted.mapInArrow(
        _digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


_NOTHING = object()


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(own: object, parts: list[str], spans: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([own], pa.int64()),
                pa.array(["".join(parts)], pa.string()),
                pa.array([spans], pa.list_(pa.int32())),
            ],
            names=["conv_id", "text", "loss_spans"],
        )

    current, parts, spans, length = _NOTHING, [], [], 0
    for batch in batches:
        ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for own, role, text in zip(ids, roles, texts, strict=True):
            if current is _NOTHING or own != current:
                if current is not _NOTHING:
                    yield row(current, parts, spans)
                current, parts, spans, length = own, [], [], 0
            turn = render(role, text)
            if role == "assistant":
                opening, closing = MARKS["assistant"]
                spans += [length + len(opening) + 1, length + len(turn) - len(closing) - 1]
            parts.append(turn)
            length += len(turn)
    if current is not _NOTHING:
        yield row(current, parts, spans)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            text, spans = row["text"], row["loss_spans"]
            turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            found = parse(text)
            for role, body, _, _ in found:
                turns.update(f"{role}\n{body}\n".encode())
            for start, end in zip(spans[::2], spans[1::2], strict=True):
                body = unescape(text[start:end])
                loss.update(body.encode())
                chars += len(body)
            out.append((row["conv_id"], len(found), turns.hexdigest(), chars, loss.hexdigest(), len(text)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kinds[i]) for i in range(6)], names=names
        )
