"""Benchmark decontamination by template windows with slot consistency; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, sized
from campuslake.session import scratch

WINDOW = 8
MIN_LITERAL = 4
COVERAGE = 0.3

# Units of measure that count as a slot after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb oz ml cl l ms s sec min h hr hrs day days week weeks month months year "
    "years hz khz mhz ghz kb mb gb tb w kw mw v kv a ma j kj cal kcal pa kpa bar k c f meter meters metre metres "
    "mile miles gram grams liter liters litre litres second seconds minute minutes hour hours dollar dollars euro "
    "euros cent cents percent degree degrees usd eur gbp"
).split()

# Words that are numbers.
ONES = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
OTHERS = (
    "zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million billion"
).split()
# With twenty-one to ninety-nine, whose hyphens are taken away.
NUMBERS = [*ONES, *TENS, *OTHERS, *(ten + one for ten in TENS for one in ONES)]
# Units behind a number in words; in, a, c and the like are mostly other words there.
LONG_UNITS = [u for u in UNITS if len(u) > 2]

# Marks that stand before a name, a unit, a word that may be a name and a number in words; digits show themselves.
_NAME, _UNIT, _MAYBE, _COUNT = "\u0001", "\u0002", "\u0003", "\u0004"
# Repeated groups are possessive: the matcher keeps no way back, so a text of any length takes no stack.
_WORD = r"[\p{L}\p{M}\p{N}]+(?:[.,'’][\p{L}\p{M}\p{N}]+)*+"
_TOKEN = rf"({_NAME}{_WORD}(?:\s+{_NAME}{_WORD})*+|[{_UNIT}{_MAYBE}]?{_WORD})"
# A capitalised word is a name within a sentence; the first of a sentence may be one.
_CAPITAL = r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{M}\p{N}]|[\p{L}\p{M}\p{N}][.,'’])"
_FIRST = rf"{_NAME}(?<![\p{{L}}\p{{M}}\p{{N}},;]\s{_NAME})"
_MEASURE = rf"(?<=\p{{N}}\s?)({'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
_HYPHEN = rf"(?<=({'|'.join(TENS)}))-(?=(?:{'|'.join(ONES)})(?![\p{{L}}\p{{M}}\p{{N}}]))"
# A sign of a currency stands before or behind its number; either way it is the number's unit.
_SIGN_FIRST = r"\p{Sc}\s?(\p{N}++(?:[.,]\p{N}++)*+)"
_SIGN_LAST = r"(\p{N})\s?\p{Sc}"


def tokens(text: Column) -> Column:
    """The words of a text, lower case, punctuation aside.

    Names, units, capitalised first words and numbers in words carry a mark; names that follow each other are one
    word, and so is ``twenty-one``. A sign of a currency becomes a unit behind its number.
    """
    clean = F.translate(F.coalesce(text, F.lit("")), _NAME + _UNIT + _MAYBE + _COUNT, "    ")
    named = F.lower(F.regexp_replace(F.regexp_replace(clean, _CAPITAL, _NAME), _FIRST, _MAYBE))

    def joined(t: Column) -> Column:
        return F.when(t.contains("ty-"), F.regexp_replace(t, _HYPHEN, "")).otherwise(t)

    def measured(t: Column) -> Column:
        money = F.lit(f"$1 {_UNIT}money")
        priced = F.regexp_replace(F.regexp_replace(t, F.lit(_SIGN_FIRST), money), F.lit(_SIGN_LAST), money)
        return F.when(t.rlike(r"\p{N}"), F.regexp_replace(priced, _MEASURE, f" {_UNIT}$1")).otherwise(t)

    def words(t: Column) -> Column:
        return F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(1))

    # One step reads the last one's result, which is not computed again for it.
    told = F.array(named)
    for step in (joined, measured, words, counted):
        told = F.transform(told, step)
    return told[0]


def counted(words: Column) -> Column:
    """The words, numbers in words and units behind these with their marks."""
    spelled = lambda t: t.isin(NUMBERS) | ((F.ascii(t) == 3) & F.substring(t, 2, 1 << 30).isin(NUMBERS))

    def one(t: Column, i: Column) -> Column:
        measures = t.isin(LONG_UNITS) & F.when(i > 0, spelled(F.get(words, i - 1))).otherwise(False)
        return (
            F.when(t.isin(NUMBERS), F.concat(F.lit(_COUNT), t))
            .when((F.ascii(t) == 3) & F.substring(t, 2, 1 << 30).isin(NUMBERS), F.concat(F.lit(_COUNT), F.substring(t, 2, 1 << 30)))
            .when(measures, F.concat(F.lit(_UNIT), t))
            .otherwise(t)
        )

    return F.transform(words, one)


def is_slot(token: Column, first_too: bool = True) -> Column:
    """Whether the token is a slot; a capitalised first word only with ``first_too``."""
    code = F.ascii(token)
    return (code <= (3 if first_too else 2)) | (code == 4) | code.between(48, 57)


def plain(token: Column) -> Column:
    """The token without a mark of a name or of a number in words."""
    return F.when(F.ascii(token).isin(1, 3, 4), F.substring(token, 2, 1 << 30)).otherwise(token)


def template(words: Column) -> Column:
    """A number for each word: the type of a slot, the hash of any other word."""

    def one(t: Column) -> Column:
        code = F.ascii(t)
        digit = F.when((code == 4) | code.between(48, 57), F.lit(3).cast("long"))
        first = F.when(code == 3, F.xxhash64(F.substring(t, 2, 1 << 30)))
        return (
            F.when(code > 57, F.xxhash64(t)).when(code <= 2, code.cast("long"))
            .otherwise(F.coalesce(digit, first, F.xxhash64(t)))
        )

    return F.transform(words, one)


def named_first(words: Column, values: Column) -> Column:
    """The template with the capitalised first words as names."""
    return F.zip_with(words, values, lambda t, v: F.when(F.ascii(t) == 3, F.lit(1).cast("long")).otherwise(v))


def literals(words: Column) -> Column:
    return F.transform(words, lambda t: F.xxhash64(F.when(F.ascii(t) == 3, F.substring(t, 2, 1 << 30)).otherwise(t)))


def windows(values: Column, length: int, exact: bool = False) -> Column:
    """The hash of each run of ``length`` values, by kind of window."""

    def of(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(h) - length),
            lambda i: F.xxhash64(*[h[i + k] for k in range(length)], F.lit(2 * length + exact)),
        )
        return F.when(F.size(h) >= length, runs)

    return F.transform(F.array(values), of)[0]


def both_windows(words: Column, length: int) -> Column:
    """The two variants of each window, one behind the other; a second one that is like the first is null."""

    def of(pair: Column) -> Column:
        return F.concat(pair[0], F.zip_with(pair[0], pair[1], lambda x, y: F.when(x != y, y)))

    def told(values: Column) -> Column:
        two = F.array(windows(values, length), windows(named_first(words, values), length))
        return F.transform(F.array(two), of)[0]

    return F.transform(F.array(template(words)), told)[0]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, matched, windows, literal)``: documents that hold a benchmark item.

    Words become a template: numbers (digits or words), names, and units of measure or money are typed slots. Windows
    of WINDOW template words (an item of fewer words: all of them) are joined by hash. A
    capitalised first word of a sentence is a literal in one variant of a window and a name in
    the other; either may meet. An item is also looked for in lower case, where the document has no names. Windows that
    line up at one distance belong together if their slots agree: a value of the item
    meets the same value of the document wherever it stands; two values may become one.
    Where it meets several, the one met at most places counts (at a tie none), and the windows that hold
    another don't. A distance of which no more windows agree than disagree is no copy. An item is in a
    document if consistent windows reach COVERAGE of its windows. ``literal`` tells that
    every slot of these has the item's own value.

    Windows of fewer than MIN_LITERAL words beside slots say too little; an item that has
    no other window is looked for whole: by its template at one distance, if it has so many words beside slots
    altogether, else word by word. Null, empty or wordless texts and rows
    without an id match nothing. Repeated items and documents count once. Other columns
    are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_leaks(docs, benchmark))


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = benchmark.where("item_id is not null").select(
        "item_id", F.posexplode(F.array_distinct(F.array(tokens(F.col("text")), tokens(F.lower("text"))))).alias("form", "words")
    )
    items = items.where("size(words) > 0").distinct()
    items = materialized(items.withColumn("length", F.least(F.lit(WINDOW), F.size("words"))))
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most WINDOW values
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, matched long, windows long, literal boolean")

    indexed = materialized(_index(items, lengths))
    literal_too = {r["length"] for r in indexed.where("exact").select("length").distinct().collect()}
    index = sized(indexed.select("key", "item_id", "form", "at", "length"), 36)

    read = texts.select("doc_id", F.array(tokens(F.col("text"))).alias("words"))
    hits = None
    for n in lengths:
        own = read.select("doc_id", _probes(n, n in literal_too).alias("k"))
        found = own.select("doc_id", "k.n", F.posexplode("k.keys").alias("at_key", "key"))
        found = found.select("doc_id", (F.col("at_key") % F.col("n")).alias("place"), "key")
        part = found.join(index, "key").select("doc_id", "place", "item_id", "form", "at", "length")
        hits = part if hits is None else hits.union(part)
    hits = materialized(hits)
    return _consistent(hits, indexed, items, texts)


def _probes(n: int, exact: bool) -> Column:
    """The keys of all windows of a text, and how many windows it has."""

    def of(words: Column) -> Column:
        literal = [windows(literals(words), n, True)] if exact else []
        return F.struct(F.concat(both_windows(words, n), *literal).alias("keys"), (F.size(words) - n + 1).alias("n"))

    return F.transform("words", of)[0]


def _index(items: DataFrame, lengths: list[int]) -> DataFrame:
    """``(key, item_id, form, at, length, exact, whole)`` for the windows by which each item is known.

    ``whole``: all windows must meet.
    """
    out = None
    for n in lengths:
        words = F.col("words")
        own = items.where(F.col("length") == n).select(
            "item_id", "form", "words",
            F.arrays_zip(
                windows(template(words), n).alias("one"), windows(named_first(words, template(words)), n).alias("two"),
                windows(literals(words), n, True).alias("three"),
            ).alias("keys"),
        )
        each = own.select("item_id", "form", "words", F.posexplode("keys").alias("at", "k"))
        run = F.slice("words", F.col("at") + 1, n)
        beside = lambda w, first: F.size(F.filter(w, lambda t: ~is_slot(t, first)))
        least = min(MIN_LITERAL, n)
        told = each.select(
            "item_id", "form", "at", "k", (beside(run, False) >= least).alias("telling"), (beside(run, True) >= least).alias("first_telling"),
            (beside(F.col("words"), False) >= MIN_LITERAL).alias("enough"), (beside(F.col("words"), True) >= MIN_LITERAL).alias("first_enough"),
        )
        best = told.groupBy("item_id", "form").agg(F.max("telling").alias("any"))
        told = told.join(best, ["item_id", "form"]).where("telling or not any")
        none = F.lit(None).cast("long")
        kinds = F.array(
            F.struct(F.when(F.col("any") | F.col("enough"), F.col("k.one")).otherwise(none).alias("key"), F.lit(False).alias("exact")),
            F.struct(F.when(F.expr("case when any then first_telling else first_enough end"), F.col("k.two")).otherwise(none).alias("key"), F.lit(False).alias("exact")),
            F.struct(F.when(F.expr("not any and not enough"), F.col("k.three")).otherwise(none).alias("key"), F.lit(True).alias("exact")),
        )
        part = told.select("item_id", "form", "at", F.expr("not any and enough").alias("whole"), F.explode(kinds).alias("x"))
        part = part.where("x.key is not null").select(
            "x.key", "item_id", "form", "at", F.lit(n).alias("length"), "x.exact", "whole"
        ).distinct()
        out = part if out is None else out.union(part)
    return out


def _consistent(hits: DataFrame, indexed: DataFrame, items: DataFrame, texts: DataFrame) -> DataFrame:
    known = ["doc_id", "item_id", "form"]
    aligned = hits.withColumn("distance", F.col("place") - F.col("at")).distinct()
    totals = indexed.groupBy("item_id", "form").agg(F.countDistinct("at").alias("windows"), F.max("whole").alias("whole"))
    totals = sized(materialized(totals), 32)
    needed = F.when(F.col("whole"), F.col("windows")).otherwise(F.ceil(F.col("windows") * F.lit(COVERAGE)))
    enough = F.col("matched") >= F.greatest(F.lit(1.0), needed)

    def covered(rows: DataFrame) -> DataFrame:
        at_one = rows.join(totals, ["item_id", "form"])
        at_one = at_one.withColumn("line", F.when(F.col("whole"), F.col("distance")))
        by_item = at_one.groupBy(*known, "line", "windows", "whole").agg(F.countDistinct("at").alias("matched"))
        return by_item.where(enough).groupBy(*known).agg(F.max("matched").alias("matched"), F.max("windows").alias("windows"))

    likely = materialized(aligned.join(covered(aligned).select(known), known, "left_semi"))
    wanted = sized(materialized(likely.select("doc_id").distinct()), 8)
    words = texts.join(wanted, "doc_id", "left_semi").select("doc_id", tokens(F.col("text")).alias("doc_words"))
    side = items.select("item_id", "form", F.col("words").alias("item_words"))
    both = likely.join(words, "doc_id").join(side, ["item_id", "form"])
    # The item in lower case is that of a passage without names only.
    span = F.slice("doc_words", F.greatest(F.col("distance"), F.lit(0)) + 1, F.size("item_words"))
    both = both.where((F.col("form") == 0) | ~F.exists(span, lambda t: F.ascii(t).isin(1, 3)))
    slots = both.select(
        *known, "distance", "at", "place",
        F.slice("doc_words", F.col("place") + 1, F.col("length")).alias("x"),
        F.slice("item_words", F.col("at") + 1, F.col("length")).alias("y"),
    )
    at = F.col("at")
    pairs = F.transform(F.arrays_zip("x", "y"), lambda p, i: F.struct((at + i).alias("i"), p["x"].alias("x"), p["y"].alias("y")))
    pairs = F.filter(pairs, lambda p: is_slot(p["y"]))
    pairs = F.transform(pairs, lambda p: F.struct(p["i"].alias("i"), plain(p["x"]).alias("x"), plain(p["y"]).alias("y")))
    line = [*known, "distance"]
    valued = materialized(slots.where(F.size("x") == F.size("y")).select(*line, "at", F.explode_outer(pairs).alias("p")).select(*line, "at", "p.*"))
    met = valued.where("y is not null").groupBy(*line, "y", "x").agg(F.countDistinct("i").alias("n"))
    most = met.groupBy(*line, "y").agg(F.max(F.struct("n", "x")).alias("one"), F.min(F.struct(-F.col("n"), "x")).alias("two"))
    # The greatest and the smallest of the values met most often are one unless there is a tie.
    told = most.select(*line, "y", F.when(F.col("one.x") == F.col("two.x"), F.col("one.x")).alias("only"))
    judged = valued.join(told, [*line, "y"], "left").groupBy(*line, "at").agg(
        F.min(F.expr("int(y is null or coalesce(x = only, false))")).alias("agrees"),
        F.min(F.expr("int(y is null or x = y)")).alias("same"),
    )
    fair = judged.groupBy(*line).agg(F.sum("agrees").alias("for"), F.count("*").alias("of")).where("2 * `for` > of")
    agreed = materialized(judged.where("agrees = 1").join(fair.select(line), line, "left_semi"))
    literal = agreed.groupBy(*known).agg((F.min("same") == 1).alias("literal"))
    found = covered(agreed).join(literal, known)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "literal", "windows")).alias("best"))
    return best.select("doc_id", "item_id", "best.matched", "best.windows", "best.literal")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, columns unchanged; rows without an id stay."""
    leaks = materialized(find_leaks(docs, benchmark).select("doc_id").distinct())
    return docs.join(sized(leaks, 8), "doc_id", "left_anti").select(docs.columns)
