"""Conversation repair against the best way to each state, against SQL, and on cut conversations."""

import itertools
import random

import duckdb
import pytest

from campuslake.llm import repair
from campuslake.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def best(codes):
    """Least cost, then least letters, for each state, row by row; with the marks."""

    def inserted(now):
        for _ in range(3):
            for q, (cost, letters, marks) in list(now.items()):
                after = repair.FOLLOWS[q]
                more = (cost + 3, letters + "I", marks + "ua"[after - 2])
                now[after] = min(now.get(after, more), more)
        return now

    now = inserted({0: (0, "", "")})
    for code in codes:
        then = {}
        for q, (cost, letters, marks) in now.items():
            ways = [(q, 4, "D", "D")]
            if code < repair.GONE:
                late, after = 3 * bool(code & repair.LATE), repair.FOLLOWS[q]
                ways += [(after, 3 + late, "R", "UA"[after - 2])]
                ways += [(code & 3, late, "K", "K")] * ((code & 3) in repair.KEEPS[q])
            for to, paid, letter, mark in ways:
                more = (cost + paid, letters + letter, marks + mark)
                then[to] = min(then.get(to, more), more)
        now = inserted(then)
    return min(now[q] for q in (0, 3) if q in now)


@pytest.mark.parametrize("block", [1, 3, 16])
def test_auction_finds_the_least_cheapest_path(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    repair.repair.cache_clear()
    rng = random.Random(block)
    for _ in range(1500):
        codes = bytes(rng.choice([0, 1, 2, 2, 3, 3, *range(12)]) for _ in range(rng.randrange(14)))
        cost, _, marks = best(codes)
        assert repair.repair(codes) == marks
        cuts = sorted(rng.sample(range(1, len(codes)), min(3, len(codes) - 1))) if len(codes) > 1 else []
        parts = [codes[a:b] for a, b in itertools.pairwise([0, *cuts, len(codes)]) if b > a]
        behind, exits = [], list(repair.END_COSTS)
        for matrix in reversed([repair.between(p) for p in parts]):
            behind.append(exits)
            exits = [min(matrix[4 * q + r] + exits[r] for r in range(4)) for q in range(4)]
            assert max(exits) - min(exits) < repair.FAR
        assert exits[0] == cost
        state, whole = 0, ""
        for part, ends in zip(parts, reversed(behind), strict=True):
            own, state = repair._traced(part, ends, state)
            whole += own
        assert whole + repair.END_MARKS[state] == marks
    repair.repair.cache_clear()


def test_every_short_conversation():
    for n in range(5):
        for codes in itertools.product(range(12), repeat=n):
            assert repair.repair(bytes(codes)) == best(codes)[2]


def sql(rows, spark):
    con = duckdb.connect()
    frame = rows.toArrow()
    con.register("conversations", frame)
    return con.execute(ORACLE_SQL["op13_repair"]).fetchall()


def test_query_is_the_sql(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert sorted(tuple(r) for r in QUERIES["op13_repair"](spark, FOLDER).collect()) == sorted(sql(rows, spark))


def odd_rows(rng, ids, n):
    texts = ["Yes.", "No", " ", "", None, "What?\n", "a.b", "end! \x0b\x0c", "é…", "\xa0", ".", "x" * 50 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "User"]
    return [(rng.choice(ids), rng.choice([*range(40), None]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_odd_rows_are_the_sql(spark):
    rows = odd_rows(random.Random(2), [*range(60), None], 700)
    found = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, first int")
    got = repair.repair_digests(found)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(sql(found.select("conv_id", "turn", "role", "text"), spark), key=str)
    assert repair.repair_digests(found.where("false")).count() == 0
    dropped = spark.createDataFrame([(3, t, "user", "Hi.") for t in range(400)], "conv_id long, turn long, role string, text string")
    gone = dropped.where("crc32(concat(conv_id, ':', turn)) % 20 = 0")
    assert gone.count() > 0
    (row,) = repair.repair_digests(gone).collect()
    assert tuple(row)[:8] == (3, 0, 0, 0, 0, 0, 0, "") and row["repaired_sha256"].startswith("e3b0c442")


def test_a_conversation_cut_by_ranges(spark):
    rng = random.Random(7)
    rows = odd_rows(rng, [1, 1, 1, 2, None], 900)
    rows = [(i, n, r, f"{t} {n}." if rng.random() < 0.7 else t) for n, (i, _, r, t) in enumerate(rows)]
    found = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    placed = repair._faults(found.na.fill(" "))
    runs = repair._solved(repair._coded(placed))[0]
    assert runs.where("conv_id = 1").count() > 3
    assert sorted((tuple(r) for r in repair.repair_digests(found).collect()), key=str) == sorted(sql(found, spark), key=str)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "And?"), (1, 2, "assistant", "Well"), (1, 2, "assistant", "Well"), (2, 5, "", "Odd."), (3, None, None, None)]
    found = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits, faults = repair.repair_conversations(found)
    order = edits.orderBy("conv_id", "place", "step").collect()
    assert [(r["conv_id"], r["edit"], r["role"], r["text"]) for r in order] == [
        (1, "K", "user", "Hi."), (1, "I", "assistant", ""), (1, "K", "user", "And?"), (1, "K", "assistant", "Well"), (1, "D", "assistant", "Well"),
        (2, "D", "", "Odd."), (3, "D", "", ""),
    ]
    assert sum(r["cost"] for r in order if r["conv_id"] == 1) == 10
    got = {r["conv_id"]: r.asDict() for r in faults.collect()}
    assert got[1] == {"conv_id": 1, "blank": 0, "duplicate": 1, "truncated": 1, "illegal": 2, "gaps": 0}
    assert (got[3]["blank"], got[3]["gaps"], got[2]["illegal"]) == (1, 0, 0)
