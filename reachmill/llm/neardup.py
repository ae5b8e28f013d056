"""Near-duplicate documents by circulant MinHash.

A document's set is its distinct runs of n words, A-Z folded. Two permutations of D
positions make the whole signature: the first spreads the set over the positions, the
second, shifted round by k, gives coordinate k as the least value it puts on any of them.
Coordinates in bands are bucket keys; documents that share a bucket are candidates, and
a link is confirmed on the full sets: |A and B| / |A or B| >= threshold. Components of the
links are found by components.linked_components, which compares members with pivots first
and never emits the pairs of a group. Documents with equal sets are one candidate.

With 25 bands of 5 rows a pair at 0.8 shares no bucket with a chance of 5 in 100,000; with
20 bands of 6 rows a pair at 0.85 does so with one of 8 in 100,000.

Sets are compared by 64-bit hashes of their members. Defined cases: texts with fewer than
n words have one run, the whole sequence; null texts and texts without words have none and
are linked with nothing; rows with the same id are each classed by their own text and
all kept if their id stands for the class; rows without id are linked with nothing and
kept; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.components import linked_components
from reachmill.llm.scratch import Scratch
from reachmill.llm.textarrays import Block, blocks, distinct, mix, portions, shingles

_BLOCK = 1 << 18
_D = 1 << 20
_U = np.uint64


def _blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, Block]]:
    for begin, texts in portions(column):
        for first, block in blocks(texts, limit, lower=True):
            yield begin + first, block


def _sets(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every text's distinct runs of n words, sorted."""
    starts, ends, text = block.words()
    words = block.hashes(starts, ends)
    runs, owner = shingles(words, text, n)
    runs, owner = runs[owner >= 0], owner[owner >= 0]
    # texts of fewer words: all of them as one run, told apart by their number
    count = block.per_text(text)
    few = (count > 0) & (count < n)
    if few.any():
        short = few[text]
        folded = np.zeros(block.n, dtype=_U)
        for k in range(n - 1):
            nth = short & (np.arange(len(text)) - np.searchsorted(text, text) == k)
            folded[text[nth]] = folded[text[nth]] * _U(0x9E3779B97F4A7C15) + words[nth]
        at = np.flatnonzero(few)
        runs = np.concatenate([runs, mix(folded[at] + count[at].astype(_U))])
        owner = np.concatenate([owner, at])
    return distinct(runs, owner)


@lru_cache(maxsize=4)
def _permutations(seed: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The two permutations; the second one as windows of k values, read on round its end."""
    random = np.random.default_rng(seed)
    first = random.permutation(_D)
    second = random.permutation(_D).astype(np.int32)
    return first, np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:k]]), k)


def signatures(sets: np.ndarray, owner: np.ndarray, n_texts: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have a set, and their signatures, one row each."""
    spread, circulant = _permutations(seed, k)
    place = spread[(sets & _U(_D - 1)).astype(np.int64)]
    has = np.flatnonzero(np.bincount(owner, minlength=n_texts))
    cuts = np.searchsorted(owner, has)
    found = np.empty((len(has), k), dtype=np.int32)
    # some ten thousand windows at a time
    upto = np.append(cuts[1:], len(place))
    begin = 0
    while begin < len(has):
        end = max(begin + 1, int(np.searchsorted(upto, cuts[begin] + 20_000, side="right")))
        rows = circulant[place[cuts[begin] : upto[end - 1]]]
        found[begin:end] = np.minimum.reduceat(rows, cuts[begin:end] - cuts[begin], axis=0)
        begin = end
    return has, found


def prints(docs: DataFrame, key: str, text: str, n: int, bands: int, rows: int, seed: int = 11) -> DataFrame:
    """id, n_shingles, two hashes that name the set, and the bands' bucket keys."""
    schema = "id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mix(np.arange(1, bands * rows + 1, dtype=_U)) | _U(1)
        for batch in batches:
            ids = batch.column(0)
            for done, block in _blocks(batch.column(1), _BLOCK):
                sets, owner = _sets(block, n)
                count = block.per_text(owner)
                has, found = signatures(sets, owner, block.n, bands * rows, seed)
                keys = (found.astype(_U) * weights).reshape(len(has), bands, rows).sum(axis=2, dtype=_U)
                keys = mix(keys + np.arange(bands, dtype=_U)).astype(np.int64)
                names = []
                for salt in (0x1234567, 0x89ABCDEF):
                    total = np.zeros(block.n, dtype=_U)
                    np.add.at(total, owner, mix(sets + _U(salt)))
                    names.append(pa.array(total.view(np.int64)))
                sizes = np.zeros(block.n, dtype=np.int32)
                sizes[has] = bands
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([ids.slice(done, block.n), pa.array(count), *names, lists], names=["id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, schema)


def _contents(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """id and set of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for done, block in _blocks(batch.column(1), _BLOCK):
                sets, owner = _sets(block, n)
                offsets = np.searchsorted(owner, np.arange(block.n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(done, block.n), lists], names=["id", "members"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "id bigint, members array<bigint>")


def _linked(percent: int):
    def test(pairs: DataFrame, contents: DataFrame) -> DataFrame:
        a = contents.select(F.col("id").alias("a"), F.col("members").alias("_a"))
        b = contents.select(F.col("id").alias("b"), F.col("members").alias("_b"))
        small, large = F.least(F.size("_a"), F.size("_b")), F.greatest(F.size("_a"), F.size("_b"))
        joined = pairs.join(a, "a").join(b, "b").where(100 * small >= percent * large)
        both = F.size(F.array_intersect("_a", "_b"))
        return joined.withColumn("_both", both).where(100 * F.col("_both") >= percent * (F.size("_a") + F.size("_b") - F.col("_both"))).select("a", "b")

    return test


def _linked_inside(percent: int):
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, ids = table["side"].to_numpy(), table["id"].to_numpy()
        component = table["component"].to_numpy()
        lists = table["members"].chunk(0) if table.num_rows else None
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        values = values[offsets[0] : offsets[-1]]
        size = np.diff(offsets)
        owner = np.repeat(np.arange(len(size)), size)
        # members that only one document has count in no intersection
        _, which, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times[which] > 1
        which, owner = which[shared], owner[shared]
        _, which = np.unique(which, return_inverse=True)
        both = np.zeros((len(size), len(size)), dtype=np.float32)
        for begin in range(0, int(which.max(initial=-1)) + 1, 4096):
            part = (which >= begin) & (which < begin + 4096)
            has = np.zeros((len(size), 4096), dtype=np.float32)
            has[owner[part], which[part] - begin] = 1
            both += has @ has.T
        union = size[:, None] + size[None, :] - both
        links = np.triu((100 * both >= percent * union) & (component[:, None] != component[None, :]) & ((side[:, None] == 0) | (side[None, :] == 0)), 1)
        return _forest(ids, component, *np.nonzero(links))

    return lambda cells: cells.groupBy("cell").applyInArrow(compare, "a bigint, b bigint")


def _forest(ids: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.Table:
    """Of the links those that join what no earlier one has joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    kept = []
    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        a, b = find(int(component[i])), find(int(component[j]))
        if a != b:
            root[a] = b
            kept.append((int(ids[i]), int(ids[j])))
    return pa.table({"a": pa.array([k[0] for k in kept], pa.int64()), "b": pa.array([k[1] for k in kept], pa.int64())})


def classes(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, bands: int = 25, rows: int = 5) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    printed = scratch.keep(prints(docs, key, text, n, bands, rows), "prints")
    named = printed.where(F.col("n_shingles") > 0).where(F.col("id").isNotNull())
    # equal sets have equal bands, so any copy's will do
    groups = named.groupBy("set_a", "set_b").agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands"))
    groups = scratch.keep(groups, "groups")
    members = groups.select(F.explode("bands").alias("bucket"), F.col("rep").alias("id"))

    def contents_of(ids: DataFrame) -> DataFrame:
        # by sort and merge at every size: what is broadcast must not grow with the input
        wanted = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(ids.hint("merge"), "id", "left_semi")
        return _contents(wanted, "id", "text", n)

    linked = linked_components(members, contents_of, _linked(percent), _linked_inside(percent), scratch)
    resolved = groups.drop("bands").join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    resolved = resolved.select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    # copies of one set may be a third of all rows; adaptive execution splits them in this join
    joined = printed.drop("bands").join(resolved, ["set_a", "set_b"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return joined.select("id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
