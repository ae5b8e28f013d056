"""Near-duplicate documents by SimHash with pigeonring filtering.

A fingerprint has 64 bits: bit k is 1 if more than half of the document's runs of n words
have it in their XXH64. Two documents are linked when their fingerprints differ in at most
distance bits; the result is each document's component.

The 64 bits are cut into segments that stand in a ring. If a pair differs in at most t bits
over m segments, there is a segment from which on every chain of l consecutive segments
differs in at most l * t / m bits (the pigeonring principle). There are as few segments as
keep the budget of a chain of two at two bits: three for a distance of 4. Such chains are
the index: a fingerprint is entered under each chain of two segments as it is, with every
single bit of the second one turned, and, if the first one has an odd number of ones, with
every bit of that turned. So two whose chains differ by (0, 0), (0, 1), (1, 0), (0, 2) or (1, 1)
bits meet, and these are all that the budgets allow. A chain has some 42 bits, so hardly any others
meet, however many documents there are.
Pairs that meet must keep the budgets of all chains from some segment on before all bits
are compared.

Equal fingerprints are one node. Members of a bucket meet pivots first and the pairs of a
group are never emitted (components.linked_components); the result holds every link.

Defined cases: texts with fewer than n words have one run, the whole sequence; null texts
and texts without words have the fingerprint 0 and are linked like any other; rows without
id take part, and a component without any id has a null one; rows with the same id are each
classed by their own text; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.llm.components import linked_components
from reachmill.llm.neardup import _forest
from reachmill.llm.scratch import Scratch
from reachmill.llm.textarrays import portions

BITS = 64
_PORTION = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(raw: bytes, n: int) -> Iterator[list[bytes]]:
    """The words of a text in lists of about a million bytes; each but the first begins with
    the n - 1 words before it, so that every run of n words stands in one list."""
    begin, tail = 0, []
    while begin < len(raw):
        cut = _SPACE.search(raw, min(begin + _PORTION, len(raw)))
        end = cut.start() if cut else len(raw)
        words = tail + raw[begin:end].lower().split()
        yield words
        begin, tail = end, words[len(words) - n + 1 :] if len(words) >= n > 1 else words if n > 1 else []


def run_hashes(raw: bytes, n: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of n words, joined by spaces, A-Z folded."""
    few: list[bytes] = []
    hashed = False
    for words in _word_lists(raw, n):
        if len(words) < n:
            few = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)
        hashed = True
    if few and not hashed:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(few), seed)], dtype=np.uint64)


def _fingerprint(raw: bytes, n: int, seed: int) -> int:
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in run_hashes(raw, n, seed):
        for begin in range(0, len(hashes), 1 << 14):
            part = hashes[begin : begin + (1 << 14)].astype("<u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, n: int = 4, seed: int = 42) -> Column:
    """The fingerprint of every whole text, as a signed long."""

    @F.arrow_udf("bigint")
    def run(column: pa.Array) -> pa.Array:
        found = np.zeros(len(column), dtype=np.uint64)
        for begin, texts in portions(column.cast(pa.binary())):
            for k, raw in enumerate(texts):
                if raw:
                    found[begin + k] = _fingerprint(raw, n, seed)
        return pa.array(found.view(np.int64))

    return run(text)


def n_segments(distance: int) -> int:
    """The fewest segments of which two may differ in two bits at most."""
    return max(2, 2 * distance // 3 + 1)


def segments(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each segment of the ring."""
    parts = n_segments(distance)
    widths = [BITS // parts + (k < BITS % parts) for k in range(parts)]
    return [(sum(widths[:k]), width) for k, width in enumerate(widths)]


def budget(length: int, distance: int) -> int:
    """Bits in which a chain of some segments may differ."""
    return length * distance // n_segments(distance)


def entries(prints: DataFrame, distance: int) -> DataFrame:
    """bucket and id: every fingerprint (column print) under its chains of two segments."""
    ring, keys = segments(distance), []
    for k, (at, width) in enumerate(ring):
        next_at, next_width = ring[(k + 1) % len(ring)]
        own = F.shiftrightunsigned("print", at).bitwiseAND(F.lit((1 << width) - 1))
        following = F.shiftrightunsigned("print", next_at).bitwiseAND(F.lit((1 << next_width) - 1))
        after = [0, *(_bit(b) for b in range(next_width))]
        before = [_bit(next_width + b) for b in range(width)] if budget(1, distance) else []
        bits = [F.array(*(F.lit(b) for b in some)).cast("array<bigint>") for some in (after, [*after, *before])]
        # of two segments that differ in one bit, one has an odd number of ones: it is turned
        turned = F.when(F.bit_count(own) % 2 == 1, bits[1]).otherwise(bits[0])
        keys.append(F.transform(turned, _named(k, F.shiftleft(own, next_width).bitwiseOR(following))))
    return prints.select(F.explode(F.concat(*keys)).alias("bucket"), F.col("print").alias("id"))


def _bit(place: int) -> int:
    """A signed long with one bit."""
    return 1 << place if place < BITS - 1 else -(1 << place)


def _named(k: int, chain: Column) -> Callable[[Column], Column]:
    """The bucket of the chain from segment k on, a bit of which is turned."""
    return lambda bit: F.xxhash64(F.lit(k), chain.bitwiseXOR(bit))


def linked_pairs(pairs: DataFrame, distance: int) -> DataFrame:
    """Those of the pairs (a, b) of fingerprints that are linked."""
    differing = F.col("a").bitwiseXOR(F.col("b"))
    parts = [F.bit_count(F.shiftrightunsigned(differing, at).bitwiseAND(F.lit((1 << width) - 1))) for at, width in segments(distance)]
    in_ring = F.lit(False)
    for begin in range(len(parts)):
        chain = F.lit(True)
        for length in range(1, len(parts)):
            chain = chain & (sum((parts[(begin + k) % len(parts)] for k in range(length)), F.lit(0)) <= budget(length, distance))
        in_ring = in_ring | chain
    return pairs.where(in_ring).where(F.bit_count(differing) <= distance).select("a", "b")


def _linked_inside(distance: int):
    ring = segments(distance)

    def compare(table: pa.Table) -> pa.Table:
        ids, component, side = (table[c].to_numpy() for c in ("id", "component", "side"))
        apart = np.triu((component[:, None] != component[None, :]) & ((side[:, None] == 0) | (side[None, :] == 0)), 1)
        left, right = np.nonzero(apart)
        differing = (ids[left] ^ ids[right]).view(np.uint64)
        parts = np.array([np.bitwise_count((differing >> np.uint64(at)) & np.uint64((1 << width) - 1)) for at, width in ring], dtype=np.int64)
        in_ring = np.zeros(len(left), dtype=bool)
        for begin in range(len(ring)):
            sums = np.cumsum(np.roll(parts, -begin, axis=0)[:-1], axis=0)
            in_ring |= (sums <= np.array([budget(length, distance) for length in range(1, len(ring))])[:, None]).all(axis=0)
        left, right, differing = left[in_ring], right[in_ring], differing[in_ring]
        close = np.bitwise_count(differing) <= distance
        return _forest(ids, component, left[close], right[close])

    return lambda cells: cells.groupBy("cell").applyInArrow(compare, "a bigint, b bigint")


def classes(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", n: int = 4, seed: int = 42, distance: int = 4) -> DataFrame:
    """One row per document: id, print (signed long), component_id."""
    if not 1 <= distance < BITS // 2:
        raise ValueError(f"the distance lies between 1 and {BITS // 2 - 1}")
    printed = scratch.keep(docs.select(F.col(key).alias("id"), fingerprint(F.col(text), n, seed).alias("print")), "prints")
    groups = scratch.keep(printed.groupBy("print").agg(F.min("id").alias("least")), "groups")
    # one shuffle by key serves both the counting of a bucket and the look at its members
    members = entries(groups, distance).repartition("bucket")
    linked = linked_components(members, lambda ids: ids, lambda pairs, _: linked_pairs(pairs, distance), _linked_inside(distance), scratch)
    classed = groups.join(linked.withColumnRenamed("id", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    firsts = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    resolved = scratch.keep(classed.join(firsts, "component").select("print", "component_id"), "resolved")
    # copies may be a third of all rows; adaptive execution splits them in this join
    return printed.join(resolved, "print").select("id", "print", "component_id")
