"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern
(the set of their sources); the words of a pattern are a supply that may be used up to
max_repeats times, each further time at a higher, convex cost; every source has a quota.
The cheapest flow from patterns to sources says how many words each pattern gives. Whole
documents are then chosen in the order of a seeded hash until their pattern's words are
given: all of them as often as fits, and the first ones in that order once more. That
choice is a cut in the order, so one small row for each pattern says of any document,
wherever it lies, how often it is taken: texts are neither numbered nor shuffled.

What reaches the driver is one row per pattern. Patterns are combinations of the sources
that a mix names, so a mix of too many is refused (max_patterns), never cut.

Defined cases: a null text has size 0 and gives nothing; a null source is a source, last
in order; rows with the same id are documents of their own that follow each other in the
order, by size and by the column tie (a hash of the text, say); rows equal in all three are
taken or left together; empty tables give empty results; without any word every target is
0. Other columns pass through; "place" and "mix_times" are replaced, "_mix_cut" and "no"
must not be there.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words, without building an array of them; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quotas(sizes: dict[str | None, int], total: int, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> dict[str | None, float]:
    """total shared out by weight, no target above max_repeats times the source's size. Sources in the
    order of code points, null last, take the weights in turn; what a source cannot take is
    shared among the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    limit = {s: float(max_repeats * sizes[s]) for s in order}
    full: dict[str | None, float] = {}
    # sources fill up in the order of limit per weight: once one is not full, none after it is
    open_weight, left = float(sum(weight.values())), float(total)
    for s in sorted(order, key=lambda s: limit[s] / weight[s]):
        if left * weight[s] / open_weight < limit[s]:
            break
        full[s] = limit[s]
        left -= limit[s]
        open_weight -= weight[s]
    return {s: full[s] if s in full else left * weight[s] / open_weight for s in order}


def cheapest_flow(supplies: list[tuple[frozenset, float]], targets: dict, max_repeats: int = 3) -> list[float]:
    """Words that each pattern gives so that the quotas are met at the least cost of
    repetition. The r-th use of a word costs r * (r - 1) / 2, so first uses come first and
    repetition is spread over the patterns that can serve the source.

    Successive cheapest paths: a path leads from a pattern's next use to a source with an
    open quota, or through sources that pass on to others what they already take."""
    sources = list(targets)
    used = [0.0] * len(supplies)
    given: dict[tuple[int, int], float] = {}
    open_quota = [float(targets[s]) for s in sources]
    serves = [[k for k, s in enumerate(sources) if s in members] for members, _ in supplies]
    reach: list[list[int]] = [[] for _ in sources]
    for p, ks in enumerate(serves):
        for k in ks:
            reach[k].append(p)
    tiny = 1e-9 * max([1.0, *open_quota])

    def step(p: int) -> tuple[float, float]:
        """Cost of the pattern's next use and how many words may be used at that cost."""
        size = supplies[p][1]
        if size <= 0:
            return float("inf"), 0.0
        r = int((used[p] + tiny) // size)
        return (float("inf"), 0.0) if r >= max_repeats else (r * (r + 1) / 2, (r + 1) * size - used[p])

    while True:
        # cheapest pattern for every source, directly or by taking over what another source takes
        best: dict[int, tuple[float, int, int]] = {}
        queue: list[tuple[float, int, int, int]] = []  # cost, source, pattern, source that lets go of it or -1
        for p, ks in enumerate(serves):
            cost, _ = step(p)
            if cost < float("inf"):
                for k in ks:
                    heapq.heappush(queue, (cost, k, p, -1))
        end = None
        while queue:
            cost, k, p, via = heapq.heappop(queue)
            if k in best:
                continue
            best[k] = (cost, p, via)
            if open_quota[k] > tiny:
                end = k
                break
            # source k may be served anew and let go of a pattern that other sources share
            for q in reach[k]:
                if given.get((q, k), 0.0) > tiny:
                    for other in serves[q]:
                        if other not in best:
                            heapq.heappush(queue, (cost, other, q, k))
        if end is None:
            return used
        path, k = [], end
        while True:
            _, p, via = best[k]
            path.append((p, k, via))
            if via < 0:
                break
            k = via
        amount = min([open_quota[end], step(path[-1][0])[1], *(given[p, via] for p, _, via in path if via >= 0)])
        for p, k, via in path:
            given[p, k] = given.get((p, k), 0.0) + amount
            if via < 0:
                used[p] += amount
            else:
                given[p, via] -= amount
        open_quota[end] -= amount


def place(members: Column, size: Column, key: Column, tie: Column | None = None, seed: int = 7, slices: int = 256) -> Column:
    """Where a document stands: its membership pattern, and its place in the pattern's seeded
    order, first by the hash of its key, then by size and tie. slices splits the order into
    ranges that are summed apart from each other, so that a pattern with a third of all
    rows is no hot spot; the choice does not depend on it."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return F.struct(
        F.array_sort(F.array_distinct(members)).alias("pattern"),
        F.shiftright(draw, 52 - (slices - 1).bit_length()).cast("int").alias("slice"),
        F.struct(draw.alias("draw"), size.cast("long").alias("size"), (F.lit(0) if tie is None else tie).cast("long").alias("tie")).alias("at"),
    )


def _name(pattern: Column) -> Column:
    """A number for a pattern. The hash of an array passes over nulls, so its size counts too."""
    return F.xxhash64(F.size(pattern), pattern)


def plan(placed: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, max_patterns: int = 10_000) -> tuple[DataFrame, dict[str | None, float], dict[str | None, int]]:
    """What to take of each pattern (one row for each, at most max_patterns), and the sources'
    targets and sizes. placed has the column place and is read several times: hand in a
    written table. Only the slice in which a pattern's cut lies is ever sorted."""
    rows = placed.select(_name(F.col("place.pattern")).alias("no"), "place.pattern", "place.slice", "place.at", F.col("place.at.size").alias("size"))
    patterns = rows.groupBy("pattern").agg(F.sum("size").alias("words")).limit(max_patterns + 1).collect()
    if len(patterns) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns: name fewer sources in the mix")
    supplies = [(frozenset(r["pattern"]), float(r["words"])) for r in patterns]
    source_words: dict[str | None, int] = {}
    for r in patterns:
        for s in set(r["pattern"]):
            source_words[s] = source_words.get(s, 0) + r["words"]
    # the corpus is shared out: a word that several sources have is there once
    targets = quotas(source_words, sum(r["words"] for r in patterns), weights, max_repeats)
    flow = cheapest_flow(supplies, targets, max_repeats)

    given = [(r["pattern"], int(f // r["words"]) if r["words"] else 0, float(f % r["words"]) if r["words"] else 0.0) for r, f in zip(patterns, flow, strict=True)]
    schema = T.StructType([rows.schema["pattern"], T.StructField("whole", T.IntegerType()), T.StructField("rest", T.DoubleType())])
    shares = placed.sparkSession.createDataFrame(given, schema).select(_name(F.col("pattern")).alias("no"), "whole", "rest")
    return _cuts(rows.drop("pattern"), shares, max_repeats), targets, source_words


def _cuts(rows: DataFrame, shares: DataFrame, max_repeats: int) -> DataFrame:
    """A row for each pattern: whole (times that all of it is taken), and which documents are
    taken once more: those in slices before cut_slice, those of it up to cut, and closing,
    the one further document that comes closest to what is left.

    What has one row a pattern is broadcast, or else every document of a pattern would
    move to one task to meet that row."""
    in_order = Window.partitionBy("no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("no", "slice").agg(F.sum("size").alias("here"))
    sums = sums.withColumn("before", F.coalesce(F.sum("here").over(in_order), F.lit(0))).join(F.broadcast(shares), "no")
    crossed = F.struct("slice", F.col("before").alias("before"))
    open_ = sums.groupBy("no").agg(F.min(F.when(F.col("before") + F.col("here") > F.col("rest"), crossed)).alias("crossed"), F.sum("here").alias("all"))
    shares = shares.join(open_, "no").select("no", "whole", "rest", "all", F.coalesce("crossed.slice", F.lit(1 << 30)).alias("cut_slice"), F.coalesce("crossed.before", "all").alias("before"))

    # rows that share a place are taken or left together
    upto = Window.partitionBy("no").orderBy("at")
    inside = rows.join(F.broadcast(shares), "no").where("slice = cut_slice").withColumn("reached", F.col("before") + F.sum("size").over(upto))
    last = inside.where("reached <= rest").groupBy("no").agg(F.max("at").alias("cut"), F.max("reached").alias("reached"))
    shares = shares.join(last, "no", "left").withColumn("gap", F.col("rest") - F.coalesce("reached", "before")).drop("reached", "all", "before")

    off = F.abs(F.col("size") - F.col("gap"))
    left = rows.join(F.broadcast(shares), "no").where(~_fits() & (off < F.col("gap")) & (F.col("whole") < max_repeats))
    closing = left.groupBy("no").agg(F.min(F.struct(off.alias("off"), "at")).alias("closing"))
    return shares.join(closing, "no", "left").select("no", "whole", "cut_slice", "cut", F.col("closing.at").alias("closing"))


def _fits() -> Column:
    return (F.col("slice") < F.col("cut_slice")) | ((F.col("slice") == F.col("cut_slice")) & F.coalesce(F.col("at") <= F.col("cut"), F.lit(False)))


def with_times(placed: DataFrame, plan: DataFrame, name: str = "mix_times") -> DataFrame:
    """placed with how often each row is taken. The rows stay where they are: what is
    broadcast has one row a pattern."""
    cuts = F.broadcast(plan.select("no", F.struct("*").alias("_mix_cut")))
    joined = placed.join(cuts, _name(F.col("place.pattern")) == F.col("no")).drop("no")
    at, cut = F.col("place.at"), F.col("_mix_cut")
    before = (F.col("place.slice") < cut["cut_slice"]) | ((F.col("place.slice") == cut["cut_slice"]) & (at <= cut["cut"]))
    more = F.coalesce(before, F.lit(False)) | F.coalesce(at == cut["closing"], F.lit(False))
    times = F.when(F.col("place.at.size") > 0, cut["whole"] + more.cast("int")).otherwise(0)
    return joined.withColumn(name, times.cast("int")).drop("_mix_cut")


def taken(
    docs: DataFrame,
    members: Column,
    size: Column,
    key: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
    seed: int = 7,
    max_patterns: int = 10_000,
    slices: int = 256,
    tie: Column | None = None,
) -> tuple[DataFrame, dict[str | None, float], dict[str | None, int]]:
    """docs (a written table, as it is read several times) with mix_times, how often each
    document is taken, the sources' targets and sizes. members is an array of sources."""
    placed = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("place", "mix_times")), place(members, size, F.col(key), tie, seed, slices).alias("place"))
    found, targets, words = plan(placed.select("place"), weights, max_repeats, max_patterns)
    return with_times(placed, found).drop("place"), targets, words
