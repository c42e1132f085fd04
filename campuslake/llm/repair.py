"""Conversation structure repair: cheapest edits by an auction for shortest paths, ties by the traced letters.

The lattice has a node for each row and each state of the grammar ``(s?(ua)+)?`` of role
initials; arcs keep, rerole or delete the row, or insert a turn before it.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, parallelism

SPACE = " \t\n\x0b\x0c\r"

# Costs of the edits; a truncated row that stays costs its own beside.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States by the last initial: none, s, u, a. The initial that follows, those that may be
# kept, what the end costs (inserted turns that complete the grammar), and these turns.
FOLLOWS = (2, 2, 3, 2)
KEEPS = ((1, 2), (2,), (3,), (2,))
END_COSTS = (0, 2 * INSERT, INSERT, 0)
END_MARKS = ("", "ua", "a", "")
LEGAL = {(1, 2), (2, 3), (3, 2)}

# A row's code: its initial (0: any other), plus 4 if truncated, plus 8 if it must go.
LATE, GONE = 4, 8

# Marks of edits: K kept, D deleted, U and A reroled to user and assistant, u and a inserted.
ROLES = {"U": "user", "A": "assistant", "u": "user", "a": "assistant"}

BLOCK = 16
# Exits of a block cost at most 7 apart, since a state reaches what another does by a few
# edits; an exit that costs so much more is never on a cheapest path.
FAR = 16


def _arcs(code: int, state: int) -> tuple[tuple[int, int, str], ...]:
    """``(cost, step, mark)`` of the arcs out of a node, in the order of the edits' initials."""
    after = FOLLOWS[state]
    name = "ua"[after - 2]
    arcs = [(DELETE, 4, "D"), (INSERT, after - state, name)]
    if code < GONE:
        own = TRUNCATED if code & LATE else 0
        if code & 3 in KEEPS[state]:
            arcs.append((own, 4 + (code & 3) - state, "K"))
        arcs.append((own + REROLE, 4 + after - state, name.upper()))
    return tuple(arcs)


ARCS = tuple(tuple(_arcs(code, state) for state in range(4)) for code in range(16))


def _least(code: int) -> int:
    """What a row costs at least, whatever the state."""
    return min(cost for state in range(4) for cost, _, mark in ARCS[code][state] if mark not in "ua")


LEAST = tuple(_least(code) for code in range(16))


def _start(codes: bytes, exits: list[int]) -> list[int]:
    """Prices that no arc undercuts: the rows' least costs from each node on."""
    prices = [min(exits)] * (4 * len(codes)) + list(exits)
    total = min(exits)
    for i in range(len(codes) - 1, -1, -1):
        total += LEAST[codes[i]]
        prices[4 * i : 4 * i + 4] = [total] * 4
    return prices


def _auction(codes: bytes, prices: list[int], entry: int) -> tuple[list[str], int]:
    """The cheapest path from the entry to an exit, by path extension and contraction.

    The path's last node raises its price to the least of its arcs' costs plus their ends'
    prices and leaves the path; where it has that price already, the path grows by such a
    tight arc, the one whose letter is least. The entry's price rises last to its distance,
    with the path empty: from then on only arcs that turn out to lead nowhere are left
    again, so the path traced is the least by its letters among the cheapest.
    """
    goal, path, marks = 4 * len(codes), [entry], []
    while path[-1] < goal:
        node = path[-1]
        best = to = how = None
        for cost, step, mark in ARCS[codes[node >> 2]][node & 3]:
            reach = cost + prices[node + step]
            if best is None or reach < best:
                best, to, how = reach, node + step, mark
        if prices[node] < best:
            prices[node] = best
            if marks:
                path.pop()
                marks.pop()
        else:
            path.append(to)
            marks.append(how)
    return marks, path[-1] & 3


def _settled(codes: bytes, exits: list[int]) -> list[int]:
    """The distances of the four states at the start, given those at the end; block by block from the end."""
    for start in range((len(codes) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        block = codes[start : start + BLOCK]
        prices = _start(block, exits)
        for state in range(4):
            _auction(block, prices, state)
        exits = prices[:4]
    return list(exits)


def _traced(codes: bytes, exits: list[int], entry: int) -> tuple[str, int]:
    """The marks of the cheapest path from the entry on, and the state it ends in."""
    bounds, starts = [exits], range(0, len(codes), BLOCK)
    for start in reversed(starts[1:]):
        bounds.append(_settled(codes[start : start + BLOCK], bounds[-1]))
    marks = []
    for start, ends in zip(starts, reversed(bounds), strict=True):
        block = codes[start : start + BLOCK]
        own, entry = _auction(block, _start(block, ends), entry)
        marks += own
    return "".join(marks), entry


@lru_cache(maxsize=1 << 14)
def repair(codes: bytes) -> str:
    """The marks of the cheapest edits of a conversation's rows; at a tie the least by their initials."""
    if not codes:
        return ""
    marks, state = _traced(codes, list(END_COSTS), 0)
    return marks + END_MARKS[state]


def between(codes: bytes) -> list[int]:
    """What rows cost from each state before them to each behind, 16 numbers."""
    columns = [_settled(codes, [0 if r == q else FAR for q in range(4)]) for r in range(4)]
    return [columns[r][q] for q in range(4) for r in range(4)]


def damaged(rows: DataFrame) -> DataFrame:
    """The rows ``(conv_id, turn, role, text)`` with one in five hurt, by the checksum of ``conv_id:turn``.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the
    user's. Null role or text becomes one space, a null id or turn is one in the checksum.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    hurt = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    each = hurt.select("*", F.explode(F.sequence(F.lit(1), F.greatest("times", F.lit(1)))).alias("copy"))
    return each.where("times > 0").drop("times", "copy")


def _faults(rows: DataFrame) -> DataFrame:
    """The rows in their order, written: ``place`` counts them within each range of the order."""
    order = ["conv_id", "turn", "role", "text"]
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    dealt = rows.select(*order).repartitionByRange(parallelism(rows), *order).sortWithinPartitions(*order)
    return materialized(
        dealt.select(
            *order,
            F.monotonically_increasing_id().alias("place"),
            (end == "").alias("blank"),
            ((end != "") & ~F.substring(end, -1, 1).isin(*".!?")).alias("late"),
        )
    )


def _coded(placed: DataFrame) -> DataFrame:
    """``(conv_id, turn, place, code, fault)`` of every row, written; a later like row of its conversation must go."""
    alike = F.unhex(F.concat(F.md5(F.col("role").cast("binary")), F.md5(F.col("text").cast("binary"))))
    firsts = placed.groupBy("conv_id", alike.alias("alike")).agg(F.min("place").alias("place"))
    told = placed.select("conv_id", "turn", "place", "blank", "late", F.substring("role", 1, 1).alias("initial"))
    told = told.join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("late"), "truncated")
    initial = F.instr(F.lit("sua"), F.col("initial"))  # an empty role has no initial: no state takes it
    initial = F.when(F.col("initial") == "", 0).otherwise(initial)
    code = initial + F.when(fault == "truncated", LATE).when(fault.isNull(), 0).otherwise(GONE)
    return materialized(told.select("conv_id", "turn", "place", code.cast("int").alias("code"), fault.alias("fault")))


_SEGMENT = (
    "conv_id long, first long, codes binary, cut boolean, marks string, between array<int>, illegal long, "
    "head int, tail int"
)
_NOTHING = object()


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation with consecutive places; those whose conversation may go on elsewhere are ``cut``."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("first", pa.int64()), ("codes", pa.binary()), ("cut", pa.bool_()), ("marks", pa.string()),
         ("between", pa.list_(pa.int32())), ("illegal", pa.int64()), ("head", pa.int32()), ("tail", pa.int32())]
    )

    def row(conv: int | None, first: int, codes: bytes, cut: bool) -> dict:
        pairs = zip(codes, codes[1:], strict=False)
        return {
            "conv_id": conv, "first": first, "codes": codes, "cut": cut,
            "marks": None if cut else repair(codes), "between": between(codes) if cut else None,
            "illegal": sum((a & 3, b & 3) not in LEGAL for a, b in pairs), "head": codes[0] & 3, "tail": codes[-1] & 3,
        }

    def runs() -> Iterator[tuple]:
        conv, first, codes = _NOTHING, 0, bytearray()
        for batch in batches:
            for own, place, code in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "code")), strict=True):
                if own != conv or place != first + len(codes):
                    if codes:
                        yield conv, first, bytes(codes)
                    conv, first, codes = own, place, bytearray()
                codes.append(code)
        if codes:
            yield conv, first, bytes(codes)

    out, before = [], _NOTHING
    for own, after in itertools.pairwise(itertools.chain(runs(), [None])):
        # The first and the last run of the task, and neighbours of one conversation, are parts of it.
        cut = before is _NOTHING or after is None or before == own[0] or after[0] == own[0]
        out.append(row(*own, cut))
        before = own[0]
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _exits(parts):
    """The distances behind each part of a conversation, from the last part to the first."""
    parts, exits = parts.sort_values("first"), list(END_COSTS)
    found = []
    for matrix in reversed(list(parts["between"])):
        found.append(exits)
        exits = [min(int(matrix[4 * q + r]) + exits[r] for r in range(4)) for q in range(4)]
    head, tail = parts["head"].tolist(), parts["tail"].tolist()
    borders = [int((a, b) not in LEGAL) for a, b in zip(tail, head[1:], strict=False)] + [0]
    return parts[["first"]].assign(exits=found[::-1], border=borders)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest path of a part from each state it may be entered in."""
    for batch in batches:
        for row in batch.to_pylist():
            both = [_traced(row["codes"], row["exits"], entry) for entry in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["conv_id"]], pa.int64()), pa.array([row["first"]], pa.int64()),
                 pa.array([[m for m, _ in both]], pa.list_(pa.string())), pa.array([[s for _, s in both]], pa.list_(pa.int32()))],
                names=["conv_id", "first", "paths", "ends"],
            )


def _entries(parts):
    """The state each part of a conversation is entered in, and the turns inserted behind the last."""
    parts, state, found = parts.sort_values("first"), 0, []
    for ends in parts["ends"]:
        found.append(state)
        state = int(ends[state])
    return parts[["first"]].assign(entry=found, behind=[""] * (len(found) - 1) + [END_MARKS[state]])


def _solved(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, first, marks)`` of all runs, and ``(conv_id, illegal)`` counts of rows that follow wrongly."""
    dealt = coded.select("conv_id", "place", "code").repartitionByRange(parallelism(coded), "place")
    runs = materialized(dealt.sortWithinPartitions("place").mapInArrow(_segments, _SEGMENT))
    # At most two runs of a task and of a range of places are parts of a conversation cut there.
    cut = runs.where("cut")
    exits = cut.select("conv_id", "first", "between", "head", "tail").groupBy("conv_id")
    exits = materialized(exits.applyInPandas(_exits, "first long, exits array<int>, border int"))
    parts = cut.select("conv_id", "first", "codes").join(exits.select("first", "exits"), "first")
    paths = materialized(parts.mapInArrow(_paths, "conv_id long, first long, paths array<string>, ends array<int>"))
    entries = paths.select("conv_id", "first", "ends").groupBy("conv_id")
    entries = entries.applyInPandas(_entries, "first long, entry int, behind string")
    chosen = F.concat(F.col("paths")[F.col("entry")], F.col("behind"))
    marks = paths.join(entries, "first").select("conv_id", "first", chosen.alias("marks"))
    marks = materialized(runs.where("not cut").select("conv_id", "first", "marks").union(marks))
    borders = cut.select("conv_id", "first").join(exits, "first").select("conv_id", F.col("border").cast("long").alias("illegal"))
    illegal = runs.select("conv_id", "illegal").union(borders).groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    return marks, illegal


def _edited(placed: DataFrame, marks: DataFrame) -> DataFrame:
    """``(conv_id, place, step, edit, role, text, cost)``: every edit in its order, deleted rows with their text."""
    pieces = F.regexp_extract_all("marks", F.lit("([ua]*[KDUA][ua]*$|[ua]*[KDUA])"), F.lit(1))
    each = marks.select("first", F.posexplode(pieces).alias("k", "piece"))
    each = each.select((F.col("first") + F.col("k")).alias("place"), "piece")
    told = placed.join(each, "place")
    told = told.select("conv_id", "place", "role", "text", "late", F.posexplode(F.split("piece", "")).alias("step", "mark"))
    told = told.where("mark <> ''")
    new, mark = F.lower(F.col("mark")), F.col("mark")
    own = mark.isin("K", "U", "A") & F.col("late")
    return told.select(
        "conv_id", "place", "step",
        F.translate(mark, "UAua", "RRII").alias("edit"),
        F.when(new == "u", "user").when(new == "a", "assistant").otherwise(F.col("role")).alias("role"),
        F.when(mark.isin("u", "a"), "").otherwise(F.col("text")).alias("text"),
        (
            F.when(mark == "K", 0).when(mark == "D", DELETE).when(mark.isin("U", "A"), REROLE).otherwise(INSERT)
            + F.when(own, TRUNCATED).otherwise(0)
        ).cast("long").alias("cost"),
    )


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits that repair conversations, and the faults of each conversation.

    The first frame has a row for each edit, in the order of place and step: ``edit`` K, R, D or I, the role and text
    it leaves (of a deleted row: what it had) and its cost. Those other than D are the repaired conversations. The second has,
    for each conversation with rows, ``gaps`` in its turns and counts of ``blank``, ``duplicate``, ``truncated``
    rows, each by its first fault, and ``illegal`` neighbours.

    Rows are ordered by turn, nulls first; rows of one turn by role and text, so that equal rows, all of which stay,
    have a fixed order. Null role or text counts as empty; rows without an id are one conversation.
    An empty role or one with another initial fits nowhere. Other columns are ignored. No rows: none.

    A conversation of any length is cut where ranges of rows end. Its parts are solved
    apart: each gives its costs between states, these are summed up from the end, one row a part,
    and the states entered are found from the start.
    """
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    placed = _faults(clean)
    coded = _coded(placed)
    marks, illegal = _solved(coded)
    kinds = [F.sum((F.col("fault") == k).cast("long")).alias(k) for k in ("blank", "duplicate", "truncated")]
    counts = coded.groupBy("conv_id").agg(*[F.coalesce(c, F.lit(0)).alias(k) for c, k in zip(kinds, ("blank", "duplicate", "truncated"), strict=True)])
    turns = coded.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    faults = _beside(_beside(counts, illegal), gaps).withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))
    return _edited(placed, marks), faults


def _beside(rows: DataFrame, more: DataFrame) -> DataFrame:
    """The rows with another frame's columns by conversation; a null id meets a null id."""
    named = more.withColumnRenamed("conv_id", "other_id")
    return rows.join(named, F.col("conv_id").eqNullSafe(F.col("other_id")), "left").drop("other_id")


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows``, which are damaged and repaired: faults, cost, letters, checksum."""
    edits, faults = repair_conversations(damaged(rows))
    dealt = edits.repartition(parallelism(rows), "conv_id").sortWithinPartitions("conv_id", "place", "step")
    sums = dealt.mapInArrow(_digests, "conv_id long, cost long, audit string, repaired_sha256 string")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    told = _beside(_beside(ids, faults), sums)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return told.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted edits: holds one letter an edit, and no text beside the batch."""

    def row() -> pa.RecordBatch:
        found = {"conv_id": conv, "cost": cost, "audit": "".join(letters), "repaired_sha256": text.hexdigest()}
        kinds = [("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        return pa.RecordBatch.from_pylist([found], pa.schema(kinds))

    conv, cost, letters, text, parts = _NOTHING, 0, [], hashlib.sha256(), 0
    for batch in batches:
        names = ("conv_id", "edit", "role", "text", "cost")
        for own, edit, role, body, paid in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if conv is _NOTHING or own != conv:
                if conv is not _NOTHING:
                    yield row()
                conv, cost, letters, text, parts = own, 0, [], hashlib.sha256(), 0
            cost += paid
            letters.append(edit)
            if edit != "D":
                text.update(f"{chr(10) * (parts > 0)}{role}:{body}".encode())
                parts += 1
    if conv is not _NOTHING:
        yield row()
