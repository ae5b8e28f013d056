"""Connected components of a distributed graph, and links found inside buckets.

Components: in turns every node is linked to the smallest node around it, until each node
hangs on the smallest one it can reach. A hub's minimum is taken before the shuffle and
written, so the join with it is one that adaptive execution can split; every round is
written to the shared folder.

Buckets: members of a bucket may be linked; whether they are is decided by a costly test
on their contents. A bucket is not compared all with all. First every member is tested
against one pivot of its bucket, a number of tests that grows as the members do; groups of
near copies hang together after that. Then only members of different components that
share a bucket are compared, in blocks of bounded size, each a task's work of its own. Pairs
inside one component need no test, since a component is all that is asked for; no link
between two components can be missed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """id and component (the smallest id it reaches) of every node of edges (a, b: long)."""
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = scratch.keep(ordered, f"{name}-0")
    print_of = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    state, turn = print_of(now), 0
    while state[0]:
        turn += 1
        # every larger neighbour of a node moves to the node's smallest neighbour
        both = now.union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = scratch.keep(least, f"{name}-{turn}-least", 2 * state[0])
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node and its smaller neighbours move to the smallest of them
        small = scratch.keep(large.distinct(), f"{name}-{turn}-small", state[0])
        least = scratch.keep(small.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{turn}-smallest", state[0])
        joined = small.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = scratch.keep(moved.where("u <> v").distinct(), f"{name}-{turn}", 2 * state[0])
        scratch.drop(f"{name}-{turn}-*", f"{name}-{turn - 1}")
        after = print_of(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


#: Tests pairs by their contents: frames of (a, b) and of (id, content) to the linked (a, b).
PairTest = Callable[[DataFrame, DataFrame], DataFrame]

#: Numbers that turn the order of ids into several other ones.
_ORDERS = [0x1F3A5B7C9D2E4F60, 0x2B992DDFA23249D6, 0x5851F42D4C957F2D, 0x3C6EF372FE94F82B]


def linked_components(
    members: DataFrame,
    contents_of: Callable[[DataFrame], DataFrame],
    linked: PairTest,
    linked_inside: Callable[[DataFrame], DataFrame],
    scratch: Scratch,
    block: int = 128,
) -> DataFrame:
    """Components of the ids that linked pairs of bucket members form: id, component. Ids
    that are linked with nothing are left out.

    members: bucket, id (both long); a pair may be there more than once. contents_of: a
    frame of ids to those ids and whatever the tests need, one row each. linked: the linked
    ones among given pairs. linked_inside: takes rows of (cell, side, id, component,
    contents...) and returns linked pairs (a, b) of one cell, of different components and
    not both of side 1; it may leave out links that follow from those it returns."""
    # the pivot of a bucket is the least in one of four orders, so a group of near copies
    # meets several pivots, and few enough for every pair to be tested
    order = F.element_at(F.array(*[F.lit(c) for c in _ORDERS]), (F.pmod(F.col("bucket"), F.lit(len(_ORDERS))) + 1).cast("int"))
    drawn = members.withColumn("draw", F.col("id").bitwiseXOR(order))
    more = F.count(F.lit(1)) > 2
    buckets = drawn.groupBy("bucket").agg(F.min("draw").alias("least"), F.max("draw").alias("most"), more.alias("more")).where("least <> most")
    inside = members.join(buckets, "bucket").select("bucket", "id", F.col("least").bitwiseXOR(order).alias("pivot"), "more")
    inside = scratch.keep(inside.distinct(), "inside")
    # written first: a join with what has just been counted could not be split at a hot id
    ids = scratch.keep(inside.select("id").distinct(), "ids")
    contents = scratch.keep(contents_of(ids), "contents")
    pairs = inside.where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    links = scratch.keep(linked(pairs, contents), "links-pivot")
    first = components(links, scratch, "first")

    # two members need no further look. The others get their component once: written, as both
    # the counts and the members of open buckets read it
    known = inside.where("more").join(first, "id", "left").select("bucket", "id", "pivot", F.coalesce("component", "id").alias("component"))
    known = scratch.keep(known, "known")
    scratch.drop("inside")
    # buckets in which components still meet. The pivot was compared with everyone: it stands
    # for its component's members, not for itself
    is_pivot = F.col("id") == F.col("pivot")
    parts = known.groupBy("bucket", "component").agg(F.count_if(~is_pivot).alias("n"), F.bool_or(is_pivot).alias("of_pivot"))
    counted = parts.groupBy("bucket").agg(
        F.max(F.when(F.col("of_pivot"), F.col("component"))).alias("head"),
        F.sum("n").alias("n_all"),
        F.sum(F.when(F.col("of_pivot"), 0).otherwise(F.col("n"))).alias("n_other"),
    )
    open_ = known.where(~is_pivot).join(counted.where("n_other > 0 and n_all > 1"), "bucket")
    of = lambda n: F.ceil(F.col(n) / block).cast("int")
    # side 0: members outside the pivot's component, against each other; side 1: those inside it
    other = F.col("component") != F.col("head")
    n_inside = F.col("n_all") - F.col("n_other")
    placed = open_.withColumn("_rows", of("n_other")).withColumn("_cols", F.ceil(n_inside / block).cast("int"))
    at = F.pmod(F.xxhash64("id"), F.when(other, F.col("_rows")).otherwise(F.greatest("_cols", F.lit(1)))).cast("int")
    placed = placed.withColumn("_at", at)
    upto = F.transform(F.sequence(F.lit(0), F.col("_at")), lambda i: F.struct(F.col("_at").alias("x"), i.alias("y"), F.lit(0).alias("z")))
    beyond = F.transform(F.sequence(F.col("_at"), F.col("_rows") - 1), lambda i: F.struct(i.alias("x"), F.col("_at").alias("y"), F.lit(0).alias("z")))
    across = F.transform(F.sequence(F.lit(0), F.col("_cols") - 1), lambda i: F.struct(F.col("_at").alias("x"), i.alias("y"), F.lit(1).alias("z")))
    down = F.transform(F.sequence(F.lit(0), F.col("_rows") - 1), lambda i: F.struct(i.alias("x"), F.col("_at").alias("y"), F.lit(1).alias("z")))
    own = F.array_union(upto, beyond)
    own = F.when(F.col("_cols") > 0, F.concat(own, across)).otherwise(own)
    cells = placed.withColumn("_cell", F.explode(F.when(other, own).otherwise(down)))
    cells = cells.select(F.struct("bucket", "_cell").alias("cell"), F.when(other, 0).otherwise(1).alias("side"), "id", "component")
    late = scratch.keep(linked_inside(cells.join(contents, "id")), "links-blocks")
    found = components(links.union(late), scratch, "all")
    scratch.drop("known", "ids", "contents", "links-*", "first-*")
    return found
