"""Split reads: each row in one part, parts of equal depth, for keys of any type."""

import datetime as dt
import decimal

import pytest

from campuslake.sources.splits import cut_query, cuts, literal, predicates
from campuslake.sources.warehouse import Warehouse

KEYS = {
    "STRING": lambda n: f"O'{n % 97:02d}" if n % 10 else None,
    "LONG": lambda n: n * n % 1009 if n % 11 else None,
    "DATE": lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n % 300),
    "DECIMAL(9,2)": lambda n: decimal.Decimal(n % 77) / 4,
    "TIMESTAMP_NTZ": lambda n: dt.datetime(2000, 1, 1, 7) + dt.timedelta(hours=n % 99),
}


@pytest.mark.parametrize("kind", KEYS)
def test_every_row_is_read_once_in_parts_of_equal_depth(spark, kind):
    data = [(KEYS[kind](n), n) for n in range(3000)]
    spark.createDataFrame(data, f"k {kind}, n INT").createOrReplaceTempView("keyed")
    cuts = [r.cut for r in spark.sql(cut_query("keyed", "k", 6)).collect()]
    found = [[r.n for r in spark.sql(f"SELECT n FROM keyed WHERE {p}").collect()] for p in predicates("k", cuts)]
    assert sorted(n for part in found for n in part) == list(range(3000))
    known = [sum(data[n][0] is not None for n in part) for part in found]
    assert len(found) == 6 and max(known) <= 1.3 * min(known)


def test_a_hot_key_is_one_part_and_new_keys_are_read(spark):
    data = [("m" if n % 3 == 0 else f"k{n:04d}", n) for n in range(900)]
    spark.createDataFrame(data, "k STRING, n INT").createOrReplaceTempView("hot")
    cuts = [r.cut for r in spark.sql(cut_query("hot", "k", 9)).collect()]
    parts = predicates("k", cuts)
    spark.createDataFrame([("zz", -1), ("a", -2), (None, -3)], "k STRING, n INT").createOrReplaceTempView("later")
    counts = [spark.sql(f"SELECT * FROM (SELECT * FROM hot UNION ALL SELECT * FROM later) WHERE {p}").count() for p in parts]
    assert sum(counts) == 903 and len(parts) < 9


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("rows", [0, 4, 3001])
def test_a_frames_cuts_are_those_of_the_query(spark, kind, rows):
    df = spark.createDataFrame([(KEYS[kind](n),) for n in range(rows)], f"k {kind}").repartition(5)
    df.createOrReplaceTempView("counted_keys")
    wanted = sorted(r.cut for r in spark.sql(cut_query("counted_keys", "k", 7)).collect())
    assert cuts(df, "k", 7) == wanted


def test_a_frames_hot_key_has_all_its_cuts(spark):
    df = spark.createDataFrame([("m" if n % 3 else f"k{n:04d}",) for n in range(900)], "k STRING")
    df.createOrReplaceTempView("hot_keys")
    found = cuts(df, "k", 9)
    assert found == sorted(r.cut for r in spark.sql(cut_query("hot_keys", "k", 9)).collect())
    assert found.count("m") > 3


def test_a_registered_split_sorts_no_whole_table_in_one_task(spark):
    from fixtures.registered import split_read

    names = spark.createDataFrame([(f"L{n % 40:02d}",) for n in range(500)], "last_name STRING").repartition(4)
    asked, sql = [], type(spark).sql
    try:
        type(spark).sql = lambda self, text, *a, **k: asked.append(text) or sql(self, text, *a, **k)
        found = split_read(names).collect()
    finally:
        type(spark).sql = sql
    assert sum(r.rows for r in found) == 500 and not [q for q in asked if "NTILE" in q]


def test_odd_cuts():
    assert predicates("k", []) == predicates("k", [5, 5]) == ["1 = 1"]
    assert predicates("k", ["b'c", "a", "d"]) == ["k <= 'a' OR k IS NULL", "k > 'a' AND k <= 'b''c'", "k > 'b''c'"]
    assert literal(dt.date(2000, 1, 2)) == "DATE '2000-01-02'"
    for value in (1.5, True, b"x"):
        with pytest.raises(TypeError):
            literal(value)


def test_the_database_is_asked_for_its_cuts(spark, monkeypatch):
    """The reader, with a stand-in for a database: what it is asked and how the answer is used."""
    asked = []

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return type("Cuts", (), {"collect": lambda _: [("a",), ("c",), ("b",)]})()

        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))
            return spark.createDataFrame([], Warehouse_schema("p_names_av"))

    from campuslake.sources.relations import SCHEMAS

    def Warehouse_schema(name):
        return SCHEMAS[name]

    session = type("Session", (), {"read": Reader()})()
    warehouse = Warehouse.from_jdbc(session, "jdbc:x", "s", {"user": "u"}, splits={"p_names_av": ("emplid", 3)})
    assert warehouse["p_names_av"].columns == SCHEMAS["p_names_av"].names
    assert asked[0]["dbtable"] == f"({cut_query('s.p_names_av', 'emplid', 3)}) cuts" and asked[0]["user"] == "u"
    assert asked[1][:2] == ("jdbc:x", "s.p_names_av")
    assert asked[1][2] == ["emplid <= 'a' OR emplid IS NULL", "emplid > 'a' AND emplid <= 'b'", "emplid > 'b'"]
    assert asked[1][3] == {"fetchsize": "10000", "user": "u"}
    with pytest.raises(ValueError, match="p_person_av: give its partitioning"):
        warehouse["p_person_av"]
