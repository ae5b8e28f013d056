"""Filter interaction audit by min-plus removal ranks.

A pipeline of filters removes a document at the first filter that it fails, so what a
filter removes depends on the order. Documents are reduced to the mask of filters that
they fail and counted by part and mask. With M[mask, filter] = 0 where the mask has the
filter and "never" elsewhere, and P[filter, order] = the filter's place in the order (the
inverse permutation), the min-plus product

    rank[mask, order] = min over filters of M[mask, filter] + P[filter, order]

is the step at which the order removes these documents. Counts, weighted by documents and
by labels, are scattered to (order, step) by that rank; what fails a filter at a later step
than its rank is redundant there.

A part has at most 2 ** filters masks, however many documents, so the product runs in one
small task for each part. Copies are found by digest: the smallest id of each text is
joined on digest and id together, so a text that a third of all rows share is no hot key.

Different words are told apart by 64-bit hashes, texts by SHA-256. Defined cases: a null text
counts as empty, a null part as the empty string; equal texts under the same id are no
copies of each other; rows without id are copies of nothing, and nothing is a copy of
them; they have no label; of several labels of one id the largest counts; an empty table
gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmill.llm.scratch import Scratch
from reachmill.llm.textarrays import blocks, distinct, portions

COUNTS = ["n_words", "n_distinct", "n_upper", "n_chars", "n_special"]
_COUNTS = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])
_BLOCK = 1 << 17
_SPECIAL = np.zeros(128, dtype=bool)
_SPECIAL[[ord(c) for c in "#$%&*|"]] = True
#: Filters whose orders are all tried; eight of them have 40,320 orders a part.
_MOST = 8


def _counted(column: pa.Array) -> pa.Array:
    parts = [np.zeros((len(COUNTS), 0), dtype=np.int64)]
    for block in (b for _, texts in portions(column) for _, b in blocks(texts, _BLOCK)):
        starts, ends, text = block.words()
        _, owner = distinct(block.hashes(starts, ends), text)
        low = np.minimum(block.codes, 127)
        upper = np.flatnonzero((block.codes >= 65) & (block.codes <= 90))
        special = np.flatnonzero(_SPECIAL[low] & (block.codes < 128))
        found = [block.per_text(text), block.per_text(owner), block.per_text(block.owner(upper)), block.ends - block.starts, block.per_text(block.owner(special))]
        parts.append(np.array(found))
    whole = np.concatenate(parts, axis=1)
    return pa.StructArray.from_arrays([pa.array(x) for x in whole], names=COUNTS)


#: COUNTS of every whole text. Called nondeterministic so that it is not taken once for
#: each condition on it.
counts = F.arrow_udf(_counted, _COUNTS).asNondeterministic()


def text_filters(min_words: int = 200, distinct_percent: int = 50, upper_percent: int = 3) -> dict[str, Column]:
    """The failure conditions that one text decides by itself, on a struct column "counts"."""
    n = {name: F.col(f"counts.{name}") for name in COUNTS}
    return {
        "A": n["n_words"] < min_words,
        "B": 100 * n["n_distinct"] < distinct_percent * n["n_words"],
        "C": 100 * n["n_upper"] > upper_percent * n["n_chars"],
        "D": n["n_special"] > 0,
    }


def failures(docs: DataFrame, scratch: Scratch, part: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, part and a boolean for each of the filters A to E of every row. E: the text is
    that of a smaller id, removed or not."""
    whole = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.col(key).alias("id"), part.alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), counts(whole).alias("counts"))
    rows = scratch.keep(named.select("id", "part", "digest", *(c.alias(name) for name, c in text_filters().items())), "rows")
    firsts = rows.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id"))
    # digest and id together: rows of one text are spread over all tasks
    joined = rows.join(firsts.withColumn("is_first", F.lit(True)), ["digest", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    return joined.select("id", "part", "A", "B", "C", "D", copy.alias("E"))


def with_labels(rows: DataFrame, labels: DataFrame, names: list[str], key: str = "doc_id") -> DataFrame:
    """rows with a boolean for each label: whether the id has it as 1."""
    one = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*(F.max(name).alias(name) for name in names))
    has = (F.coalesce(F.col(name) == 1, F.lit(False)).alias(name) for name in names)
    return rows.join(one, "id", "left").select(*rows.columns, *has)


def removal_ranks(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Step (from 1) at which each order removes documents of each mask, one more than the
    number of filters where it never does. masks: bit f for filter f; orders: rows of filters."""
    n = orders.shape[1]
    has = (masks[:, None] >> np.arange(n)) & 1
    never = np.where(has == 1, 0, n + 1)
    places = np.argsort(orders, axis=1) + 1
    return np.minimum((never[:, :, None] + places.T[None, :, :]).min(axis=1), n + 1)


def audit(failed: DataFrame, filters: str, weights: dict[str, str]) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant and
    unique_fails, what is removed of each weight (a name in the result to a boolean column),
    and shapley: what the step's filter removes over all orders.

    failed has part, a boolean column for each letter of filters, and the weights' columns."""
    if len(set(filters)) != len(filters) or not 0 < len(filters) <= _MOST:
        raise ValueError(f"name 1 to {_MOST} different filters")
    mask = sum((F.col(f).cast("int") * (1 << k) for k, f in enumerate(filters)), F.lit(0))
    lost = {name: F.sum(F.col(c).cast("long")).alias(name) for name, c in weights.items()}
    counted = failed.groupBy("part", mask.alias("mask")).agg(F.count(F.lit(1)).alias("documents"), *lost.values())
    orders = np.array(list(permutations(range(len(filters)))))
    names = ["".join(filters[f] for f in order) for order in orders.tolist()]
    columns = ["kept", "removed", "redundant", "unique_fails", *weights, "shapley"]
    schema = T.StructType([failed.schema["part"], T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in columns)])

    def run(table: pa.Table) -> pa.Table:
        n_orders, n = orders.shape
        masks = table["mask"].to_numpy()
        documents = table["documents"].to_numpy()
        rank = removal_ranks(masks, orders)
        step = np.arange(1, n + 1)

        def scattered(weight: np.ndarray) -> np.ndarray:
            """The weight removed at each order and step."""
            found = np.zeros((n_orders, n + 1), dtype=np.int64)
            np.add.at(found, (np.arange(n_orders)[None, :], rank - 1), weight[:, None])
            return found[:, :n]

        removed = scattered(documents)
        fails = ((masks[:, None, None] >> orders[None, :, :]) & 1) == 1
        late = fails & (rank[:, :, None] < step)
        redundant = (late * documents[:, None, None]).sum(axis=0)
        alone = np.array([documents[masks == 1 << f].sum() for f in range(n)])
        shapley = np.array([removed[orders == f].sum() for f in range(n)])
        found = {
            "kept": documents.sum() - np.cumsum(removed, axis=1),
            "removed": removed,
            "redundant": redundant,
            "unique_fails": alone[orders],
            **{name: scattered(table[name].to_numpy()) for name in weights},
            "shapley": shapley[orders],
        }
        cells = n_orders * n
        arrays = [
            pa.repeat(table["part"][0], cells),
            pa.array(np.repeat(np.array(names, dtype=object), n)),
            pa.array(np.tile(step, n_orders).astype(np.int32)),
            *(pa.array(found[c].reshape(-1)) for c in columns),
        ]
        return pa.Table.from_arrays(arrays, names=schema.names)

    return counted.groupBy("part").applyInArrow(run, schema)
