"""Vector code compression: product codebooks by exact k-means with norm-of-sum bounds.

Vectors of integers are cut into equal parts; every part position has a codebook, fitted by
rounds of assigning each part to its nearest entry and moving each entry to the floor of
its parts' mean. A vector's code is the numbers of its entries.

A part that was once compared with all entries keeps the distance of its second nearest
one, and the round in which that was: the bound and its stamp. The codebooks of all rounds
are kept. At round t no entry other than the part's own can be nearer than

    bound - max over other entries j of |C_t[j] - C_stamp[j]|

The displacement is the true net one between the two rounds, the norm of the summed moves;
it is never more than the moves' norms added up round by round, and less whenever an entry
turns back. Where the distance to the own entry, which is always taken exactly, is below
that, nothing can have changed; else the part is compared with all entries anew. Distances
are integers, comparisons strict, bounds rounded down: the result is that of comparing
every part with every entry in every round.

Every round is one pass over a written table that holds the vectors and their bounds. The
same pass adds up each task's parts by entry; these sums are rows of the table, and Spark
adds the tasks' sums. The driver has the codebooks, whose size depends on the vectors'
length alone.

Defined cases: a vector that is null or empty, or holds a null, NaN or infinity, is dropped;
fewer kept vectors than entries make that many entries; ids may repeat and are then told
apart by their vectors, null ids come last; a null label is a label; without any vector the
result is empty. Vectors of different lengths, lengths that cannot be cut into equal
parts, and components so large that a squared distance would leave 64 bits end the job
with an error. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmill.llm.scratch import Scratch

_ROWS = 4096


@dataclass(frozen=True)
class Shape:
    """How vectors are cut: parts of width components, each with entries to choose from."""

    parts: int
    width: int
    entries: int


def whole_numbers(rows: DataFrame, scale: int) -> DataFrame:
    """id, label and x, the floors of the scaled components, of rows (id, label, vector) with
    a usable vector."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    usable = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if len(values) and np.abs(values).max() >= 2**31:
                raise ValueError("a component is too large for exact distances")
            offsets = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "label", "x"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("x", T.ArrayType(T.IntegerType()))])
    return rows.where(usable).select("id", "label", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(run, schema)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the entry in the same row."""
    apart = x - entries
    return np.einsum("nd,nd->n", apart, apart)


def assigned(x: np.ndarray, history: np.ndarray, own: np.ndarray, stamp: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Bring the state of the parts of one position up to the last codebook of history:
    own (the nearest entry), stamp and bound, which are changed in place. stamp is -1 where
    a part was never compared with all entries. Returns the squared distances."""
    now, latest = len(history) - 1, history[-1]
    squares = _squares(x, latest[own])
    # net displacement since each stamp, the largest among the entries other than the own
    moved = np.sqrt(((latest[None] - history).astype(np.float64) ** 2).sum(axis=2))
    others = np.where(np.eye(len(latest), dtype=bool)[None], 0.0, moved[:, None, :]).max(axis=2)
    sure = (stamp >= 0) & (np.sqrt(squares.astype(np.float64)) * (1 + 1e-12) < bound - others[stamp, own] * (1 + 1e-12))
    again = np.flatnonzero(~sure)
    if len(again):
        part = x[again]
        every = np.stack([_squares(part, entry[None, :]) for entry in latest], axis=1)
        nearest = every.argmin(axis=1)
        rows = np.arange(len(again))
        squares[again] = every[rows, nearest]
        every[rows, nearest] = np.iinfo(np.int64).max
        second = np.sqrt(every.min(axis=1).astype(np.float64))
        own[again], stamp[again] = nearest, now
        bound[again] = np.nextafter(second.astype(np.float32), np.float32(0))
    return squares


def _passed(state: DataFrame, history: np.ndarray, shape: Shape, last: bool) -> DataFrame:
    """One round over the state: with the codebooks history[:, part, entry] brought up to
    date, and the sums for the next codebook; or, in the last round, codes and errors."""
    fields = [state.schema["id"], state.schema["label"]]
    if last:
        fields += [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    else:
        fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("x", "own", "stamp")]
        fields += [T.StructField("bound", T.ArrayType(T.FloatType())), T.StructField("is_sum", T.BooleanType()), T.StructField("sums", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields)
    size = shape.parts * shape.width

    def listed(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        n, width = values.shape
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((shape.parts, shape.entries, shape.width + 1), dtype=np.int64)
        ids = pa.array([], T_ID)
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                n = batch.num_rows
                x = batch.column(2).flatten().to_numpy().reshape(n, shape.parts, shape.width).astype(np.int64)
                if batch.num_columns > 3:
                    own, stamp, bound = (batch.column(c).flatten().to_numpy().reshape(n, shape.parts).copy() for c in (3, 4, 5))
                else:
                    own, stamp = np.zeros((n, shape.parts), dtype=np.int32), np.full((n, shape.parts), -1, dtype=np.int32)
                    bound = np.zeros((n, shape.parts), dtype=np.float32)
                error = np.zeros(n, dtype=np.int64)
                for p in range(shape.parts):
                    error += assigned(x[:, p], history[:, p], own[:, p], stamp[:, p], bound[:, p])
                    if not last:
                        chosen = (own[:, p, None] == np.arange(shape.entries)).astype(np.int64)
                        sums[p, :, :-1] += chosen.T @ x[:, p]
                        sums[p, :, -1] += chosen.sum(axis=0)
                if last:
                    digits = own.astype(np.uint8).tobytes().hex()
                    step = 2 * shape.parts
                    found = [pa.array([digits[k : k + step] for k in range(0, len(digits), step)]), pa.array(error)]
                else:
                    found = [batch.column(2), listed(own, pa.int32()), listed(stamp, pa.int32()), listed(bound, pa.float32()), pa.array(np.zeros(n, dtype=bool)), pa.nulls(n, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=schema.names)
        if not last and sums[:, :, -1].any():
            empty = [pa.nulls(1, pa.list_(pa.int32()))] * 3 + [pa.nulls(1, pa.list_(pa.float32()))]
            row = [pa.nulls(1, T_ID), pa.nulls(1, T_LABEL), *empty, pa.array([True]), listed(sums.reshape(1, -1), pa.int64())]
            yield pa.RecordBatch.from_arrays(row, names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    T_ID, T_LABEL = to_arrow_type(state.schema["id"].dataType), to_arrow_type(state.schema["label"].dataType)
    if size * (2 * np.abs(history).max(initial=0)) ** 2 >= 2**62:
        raise ValueError("a component is too large for exact distances")
    return state.mapInArrow(run, schema)


def _next_codebook(sums: DataFrame, latest: np.ndarray, shape: Shape) -> np.ndarray:
    """Each entry at the floor of its parts' mean; an entry without parts stays."""
    added = sums.where("is_sum").select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(shape.parts * shape.entries * (shape.width + 1), dtype=np.int64)
    for row in added.collect():  # a row for each component of each entry, and one for each entry
        flat[row["at"]] = row["value"]
    found = flat.reshape(shape.parts, shape.entries, shape.width + 1)
    count = found[:, :, -1:]
    return np.where(count > 0, found[:, :, :-1] // np.maximum(count, 1), latest)


def digest(codebook: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebook.reshape(-1).tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, scratch: Scratch, key: str, vector: str, label: Column, scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6
) -> tuple[DataFrame, np.ndarray]:
    """id, label, code and error (squared distances summed over the parts) of every usable
    vector, and the final codebooks [part, entry, place]. Codebooks begin with the vectors
    of the smallest ids."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hexadecimal digits")
    rows = vectors.select(F.col(key).alias("id"), label.alias("label"), F.col(vector).alias("vector"))
    state = scratch.keep(whole_numbers(rows, scale), "vectors")
    lengths = state.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high"), F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("most")).first()
    if lengths["low"] is None:
        return state.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), dtype=np.int64)
    if lengths["low"] != lengths["high"] or lengths["low"] % parts:
        raise ValueError(f"vectors of {lengths['low']} to {lengths['high']} components cannot be cut into {parts} equal parts")
    if lengths["low"] * (2 * lengths["most"]) ** 2 >= 2**62:
        raise ValueError("a component is too large for exact distances")
    first = state.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    shape = Shape(parts, lengths["low"] // parts, len(first))
    start = np.array([row["x"] for row in first], dtype=np.int64).reshape(len(first), parts, shape.width)
    history = [start.transpose(1, 0, 2)]
    for turn in range(rounds):
        passed = scratch.keep(_passed(state, np.array(history), shape, last=False), f"round-{turn}")
        history.append(_next_codebook(passed, history[-1], shape))
        scratch.drop("vectors" if turn == 0 else f"round-{turn - 1}")
        state = passed.where("not is_sum").select("id", "label", "x", "own", "stamp", "bound")
    return _passed(state, np.array(history), shape, last=True), history[-1]


def with_label_error(coded: DataFrame, large: int = 1000, most_large: int = 10_000) -> DataFrame:
    """coded with label_error: the errors of its label added up, nulls together.

    A label may have a third of all rows, so rows of large labels do not meet their sum in
    a shuffle: of labels with more than total / most_large rows there are fewer than
    most_large, which are broadcast; all others are joined by sort and merge."""
    sums = coded.groupBy(F.col("label").alias("name")).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    total = coded.count()
    is_large = F.col("n") > max(large, total // most_large)
    hot, rest = F.broadcast(sums.where(is_large).drop("n")), sums.where(~is_large).drop("n")
    same = F.col("label").eqNullSafe(F.col("name"))
    left = coded.join(hot, same, "left_anti")
    return coded.join(hot, same).unionByName(left.join(rest.hint("merge"), same)).drop("name")
