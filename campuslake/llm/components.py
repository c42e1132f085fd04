"""Links within buckets, and connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslake.llm.common import materialized, sized
from campuslake.session import discard

# 64-bit words of parities that stand for a set.
PARITY_WORDS = 8
_WORDS = [f"w{k}" for k in range(PARITY_WORDS)]
# Buckets of up to so many nodes are compared pair by pair.
FEW = 32
# Features are counted in parts, so that only a part is shuffled at a time; few rows in fewer.
PARTS, PART_ROWS = 4, 4_000_000


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; component: smallest node.

    Each round points every neighbour at the smallest node known, by grouped minima
    (combined before the shuffle) and joins that adaptive execution can split, and writes
    the edges to the shared folder, until they are stars: every node points at one root, which
    points at none. Edges that are stars from the start take no round. Self loops and repeated edges
    change nothing; an edge with a null end is no edge. No edges: no rows.
    """
    edges = materialized(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while not _stars(edges):
        before = edges
        edges = materialized(_small_star(_large_star(edges)))
        discard(before)
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or only edges from larger ones."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = edges.select(F.col("a").alias("node"), one.alias("down"), none.alias("up"))
    ends = ends.union(edges.select(F.col("b").alias("node"), none.alias("down"), one.alias("up")))
    met = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return met.where("down + up > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """``(key, node, leader)`` of the buckets that hold two nodes or more, written; leader: the smallest.

    The keys, most of which occur once, are shuffled once: a bucket's rows pass by its smallest
    and its largest node. A node has many keys, and each once, so no key holds a large share of all rows.
    """
    bucket = Window.partitionBy("key")
    ends = keyed.select("key", "node", F.min("node").over(bucket).alias("leader"), F.max("node").over(bucket).alias("last"))
    return materialized(ends.where("leader <> last").select("key", "node", "leader").distinct())


def written_buckets(keyed: DataFrame) -> DataFrame:
    """The rows of ``shared_buckets``, of keys that are written already: those of several nodes are counted, then looked up.

    Reading twice takes less than to pass each key's rows by its ends, where hardly a key is shared.
    """
    ends = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    shared = materialized(ends.where("leader <> last").select("key", "leader"))
    found = materialized(keyed.join(sized(shared, 16), "key").select("key", "node", "leader").distinct())
    discard(shared)
    return found


def bucket_links(
    buckets: DataFrame,
    compared: Callable[[DataFrame], DataFrame],
    features: Callable[[DataFrame, int], DataFrame],
    percent: int,
    finer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Edges ``(a, b)`` that join the nodes as their links within buckets do: components of links, or links.

    ``compared`` keeps the pairs of nodes whose sets reach ``percent`` of Jaccard
    similarity; ``features`` gives rows ``(node, size, feature)`` of the sets of some nodes, one
    feature in so many by its hash.

    Every node is compared with the leader it meets most often. With ``finer``, which gives rows
    ``(key, node)`` of more keys of some nodes, the nodes of buckets that have several components then meet by those
    too, and buckets of up to FEW nodes are settled pair by pair: all pairs of different components that their
    sizes and parities don't rule out are compared. Where a (larger) bucket has several components, two counts of each node tell more: its features, and those that
    another such node has too. Only the latter can be in an intersection, which bounds the
    similarity of a node to any other and of a pair; what can't link goes (a node without
    features stays). The bounds are exact: no pair that links is ruled out. The bucket's node
    with the least of its own, the cleanest copy, is compared with the others.

    Of the nodes left then, each is known by its rarest features: as many, counted from the rarest
    on, as it may have beyond those that a node it links with must share, and one. Two nodes that
    link share one of these, so nodes meet by them, and copies that are near but not near enough,
    whose rare features differ, mostly don't meet at all.
    """
    led = materialized(
        buckets.where("node <> leader")
        .groupBy(F.col("node").alias("a"), F.col("leader").alias("b"))
        .agg(F.count("*").alias("met"))
    )
    best = materialized(led.groupBy("a").agg(F.max_by("b", F.struct("met", "b")).alias("b")))
    discard(led)
    placed = placements(compared(best))
    rest = _mixed(buckets.select("key", "node"), placed)
    if finer is not None:
        more, coarser = written_buckets(finer(rest.select("node").distinct())), rest
        rest = _mixed(coarser.select("key", "node").union(more.select("key", "node")), placed)
        discard(more, coarser)
        links, large = _small_bucket_links(rest, compared, features, percent)
        placed, before = placements(placed.toDF("a", "b").union(links)), placed
        rest, mixed = _mixed(large, placed), rest
        discard(before, mixed, links, large)
        if rest.isEmpty():
            discard(best, rest)
            return placed.toDF("a", "b")
    nodes = materialized(rest.select("node").distinct())
    # A share of the features tells most nodes apart; all features only of those left.
    coarse = max(1, int(100 / (1.6 * (100 - percent))))
    likely = _able(nodes, features(nodes, coarse), percent)
    able = _able(likely, features(likely.select("node"), 1), percent)
    discard(nodes, likely)
    sides = rest.join(able, "node")
    purity = F.struct((F.col("shared") + 1) / (F.col("size") + 1), "size", "node")
    cleanest = sides.groupBy("key").agg(F.max_by("node", purity).alias("hub"))
    # A bucket is known by its cleanest node from here on: far fewer groups hold the same pairs.
    hubs = materialized(sides.join(cleanest, "key").select(F.col("hub").alias("key"), "node").distinct())
    discard(rest)

    def told(rows: DataFrame, side: str) -> DataFrame:
        counts = F.struct("size", "shared", "bits").alias(side)
        own = [F.col(c).alias(f"{side}_{c}") for c in ("node", "at", "rank") if c in rows.columns]
        return rows.join(able, "node").select("key", *own, counts)

    now = _mixed(hubs, placed)
    pure = told(now, "a").join(told(now.where("node = key"), "b"), "key").where("a_at <> b_at")
    pure = materialized(pure.where(_within(percent)).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    # What is placed stands for its links, which further ones join.
    placed, before = placements(placed.toDF("a", "b").union(compared(pure))), placed
    discard(now, before)
    now = _mixed(hubs, placed)
    left = materialized(now.select("node", "at").distinct())
    discard(now, hubs)
    rare = _rarest(left, features(left.select("node"), 1), percent)
    # both carry the key's rows, of which a rare feature has few
    cross = told(rare, "a").join(told(rare, "b"), "key").where("a_node > b_node and a_at <> b_at")
    # At the first feature that two sets share, what follows in each must hold all that they share.
    rest_of_both = F.least(F.col("a.size") - F.col("a_rank"), F.col("b.size") - F.col("b_rank"))
    cross = cross.where(_within(percent) & ((100 + percent) * rest_of_both >= percent * (F.col("a.size") + F.col("b.size"))))
    cross = cross.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    done = best.union(pure).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    found = materialized(placed.toDF("a", "b").union(compared(cross.join(done, ["a", "b"], "left_anti"))))
    discard(best, pure, placed, able, left, rare)
    return found


def _small_bucket_links(
    rest: DataFrame,
    compared: Callable[[DataFrame], DataFrame],
    features: Callable[[DataFrame, int], DataFrame],
    percent: int,
) -> tuple[DataFrame, DataFrame]:
    """Links of the buckets of up to FEW nodes in several components, and ``(key, node)`` of the larger ones; both written."""
    sizes = materialized(rest.groupBy("key").agg(F.count("*").alias("n")))
    small = rest.join(sizes.where(F.col("n") <= FEW), "key")
    pairs = small.toDF("key", "a", "a_at", "n").join(small.select("key", F.col("node").alias("b"), F.col("at").alias("b_at")), "key")
    pairs = materialized(pairs.where("a > b and a_at <> b_at").select("a", "b").distinct())
    nodes = materialized(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    told = _parities(features(nodes, 1))
    told = materialized(told.select("node", F.struct("size", F.col("size").alias("shared"), F.array(*_WORDS).alias("bits")).alias("told")))
    both = pairs.toDF("first", "second").join(told.toDF("first", "a"), "first").join(told.toDF("second", "b"), "second")
    likely = materialized(both.where(_within(percent)).select(F.col("first").alias("a"), F.col("second").alias("b")))
    links = materialized(compared(likely))
    large = materialized(rest.join(sizes.where(F.col("n") > FEW), "key").select("key", "node"))
    discard(sizes, pairs, nodes, told, likely)
    return links, large


def _parts(rows: DataFrame, column: str) -> list[DataFrame]:
    """The rows of a written frame, dealt out by the hash of a column."""
    n = min(PARTS, 1 + rows.count() // PART_ROWS)
    return [rows.where(F.pmod(F.xxhash64(column), F.lit(n)) == part) if n > 1 else rows for part in range(n)]


def _written_in_parts(rows: list[DataFrame], run: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    return [materialized(run(part)) for part in rows]


def _often(rows: DataFrame) -> DataFrame:
    """``(feature, n)`` of the features that several nodes have."""
    return rows.groupBy("feature").agg(F.count("*").alias("n")).where("n > 1")


def _rarest(nodes: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """``(key, node, at, rank)``, written: each node's rarest features, among these nodes, by which it meets any that it links with.

    A node of ``size`` features shares at least ``percent`` of them with one it links with, so one of
    its ``size`` less that number, and one more, rarest is among those of both. All nodes order features alike;
    ``rank`` counts those before. The features that no other node has come first, and nodes can't meet by them:
    their number is enough.
    """
    own = materialized(features)
    counted = _written_in_parts(_parts(own, "feature"), _often)
    often = reduce(DataFrame.union, counted)

    def rarest(part: DataFrame) -> DataFrame:
        each = part.join(often, "feature").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "feature"))).alias("f"))
        alone = F.col("size") - F.size("f")
        most = F.col("size") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
        some = F.slice("f", F.lit(1), F.greatest(most - alone, F.lit(0)))
        met = each.select("node", alone.alias("alone"), F.posexplode(some).alias("i", "x"))
        return met.select(F.col("x.feature").alias("key"), "node", (F.col("alone") + F.col("i")).alias("rank"))

    found = _written_in_parts(_parts(own, "node"), rarest)
    discard(own, *counted)
    placed = materialized(reduce(DataFrame.union, found).join(nodes, "node"))
    discard(*found)
    return placed


def placements(edges: DataFrame) -> DataFrame:
    """``(node, at)``, written: the components of the edges ``(a, b)``."""
    return materialized(components(edges).toDF("node", "at"))


def mixed_buckets(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``(key, node, at)`` of the buckets whose nodes are in several components so far."""
    return _mixed(rows, components(links.select("a", "b")).toDF("node", "at"))


def _mixed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    at = rows.join(placed, "node", "left").select("key", "node", F.coalesce("at", "node").alias("at"))
    at = materialized(at)
    mixed = at.groupBy("key").agg(F.min("at").alias("one"), F.max("at").alias("two")).where("one <> two")
    found = materialized(at.join(mixed.select("key"), "key").select("key", "node", "at"))
    discard(at)
    return found


def _within(percent: int) -> Column:
    """Whether the pair ``(a, b)`` may reach the similarity: by its counts, and by its parities.

    Each feature that one of two sets has alone turns one parity bit, so the bits that
    differ are at most the features that differ.
    """
    size_a, size_b = F.col("a.size"), F.col("b.size")
    both = F.least("a.shared", "b.shared")
    turned = [F.bit_count(F.col("a.bits")[k].bitwiseXOR(F.col("b.bits")[k])) for k in range(PARITY_WORDS)]
    differ = reduce(lambda x, y: x + y, turned)
    enough = 100 * both >= percent * (size_a + size_b - both)
    return enough & ((100 + percent) * differ <= (100 - percent) * (size_a + size_b))


def _parities(features: DataFrame) -> DataFrame:
    """``(node, size, told, w0, ...)``: how many features are told of each node, and the words of their parities."""
    place = F.pmod(F.xxhash64("feature"), F.lit(64 * PARITY_WORDS)).cast("int")
    placed = features.select("node", "size", place.alias("p"))
    placed = placed.select("node", "size", F.floor(F.col("p") / 64).alias("word"), F.expr("shiftleft(1L, p % 64)").alias("bit"))
    words = [F.bit_xor(F.when(F.col("word") == k, F.col("bit")).otherwise(F.lit(0).cast("long"))) for k in range(PARITY_WORDS)]
    words = [w.alias(name) for w, name in zip(words, _WORDS, strict=True)]
    return placed.groupBy("node").agg(F.max("size").alias("size"), F.count("*").alias("told"), *words)


def _able(nodes: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """``(node, size, shared, bits)``, written, of the nodes that may still link: features, those
    another node may have, and parities of the features by hash. The features are written once."""
    own = materialized(features)
    met = _written_in_parts(
        _parts(own, "feature"),
        lambda part: part.join(_often(part).select("feature"), "feature").groupBy("node").agg(F.count("*").alias("met")),
    )
    shared = reduce(DataFrame.union, met).groupBy("node").agg(F.sum("met").alias("met"))
    sizes = _parities(own)
    counted = nodes.select("node").join(sizes, "node", "left").join(shared, "node", "left").na.fill(0)
    shared_most = (F.col("size") - F.col("told") + F.col("met")).alias("shared")
    counted = counted.select("node", "size", shared_most, F.array(*_WORDS).alias("bits"))
    found = materialized(counted.where(100 * F.col("shared") >= percent * F.col("size")))
    discard(own, *met)
    return found
