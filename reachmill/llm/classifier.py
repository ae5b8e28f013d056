"""Supervised subword embeddings for quality.

Every document is the average of learned vectors: one for each word, one for each pair of
neighbouring words, one for whether a word follows itself, and one for each run of 3 and of
5 characters, found by hashing into a table of fixed size. A softmax over the
average gives the probability of each label. Vectors and weights are trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents; the
sample is the max_documents with the smallest hash of their id, and a document's whole
text counts. The driver gets their hashed counts (at most `buckets` numbers a document).

Scoring adds up, for every feature of a text, how far its vector moves the logit; that
number is one column of (vectors x weights), so scoring looks up one float a feature and
needs no vectors. Only this column is sent to the tasks, 4 bytes a bucket.

Defined cases: null and empty texts have no feature and get the score of the bias alone;
null labels and labels without document are not learned from, repeated rows are scored
each; without labelled documents of both kinds every score is the share of label 1, or
0.5 without any. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.llm.textarrays import Block, blocks, portions, shingles

_BLOCK = 1 << 17
_GRAMS = (3, 5)


def _features(block: Block, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of every word, pair of words and character run."""
    starts, ends, text = block.words()
    if len(starts):
        word = block.hashes(starts, ends)
        yield (word % np.uint64(buckets)).astype(np.int64), text
        again = np.where(word[1:] == word[:-1], buckets - 1, buckets - 2)
        pair = text[1:] == text[:-1]
        yield again[pair], text[1:][pair]
        pairs, owner = shingles(word, text, 2)
        yield (pairs[owner >= 0] % np.uint64(buckets)).astype(np.int64), owner[owner >= 0]
    position = np.arange(len(block.codes))
    owner = np.repeat(np.arange(block.n), block.ends - block.starts)
    for n in _GRAMS:
        at = position[: max(0, len(position) - n + 1)]
        at = at[owner[at] == owner[at + n - 1]] if len(at) else at
        if len(at):
            yield (block.hashes(at, at + n, seed=n) % np.uint64(buckets)).astype(np.int64), owner[at]


def _counts(texts: list[str | None], buckets: int) -> Iterator[bytes]:
    """Each text's buckets and how many features fell into them, as 32-bit numbers: all the
    buckets, then all the counts. Bytes stay small on the driver, where lists would not."""
    for _, block in blocks(texts, _BLOCK):
        found = list(_features(block, buckets))
        joint = np.concatenate([text * buckets + bucket for bucket, text in found]) if found else np.zeros(0, np.int64)
        keys, counts = np.unique(joint, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(block.n + 1) * buckets)
        for i in range(block.n):
            part = slice(cuts[i], cuts[i + 1])
            yield np.concatenate([keys[part] - i * buckets, counts[part]]).astype("<u4").tobytes()


def hashed_counts(text: Column, buckets: int) -> Column:
    @F.arrow_udf("binary")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array((c for _, some in portions(texts) for c in _counts(some, buckets)), pa.binary())

    return count(text)


@dataclass(frozen=True)
class Model:
    """What scoring needs: the logit of label 1 against label 0 that each bucket adds."""

    pull: np.ndarray
    bias: float

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def train(rows: list[tuple[bytes, int]], buckets: int, width: int = 8, epochs: int = 12, rate: float = 2.0, seed: int = 1) -> Model:
    """Fit vectors and softmax weights to rows of hashed counts and label."""
    labels = np.array([r[1] for r in rows], dtype=np.int64)
    share = labels.mean() if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        odds = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(buckets, dtype=np.float32), float(np.log(odds / (1 - odds))))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / width, 1 / width, (buckets, width)).astype(np.float32)
    weights = random.uniform(-1, 1, (width, 2)).astype(np.float32) / width
    bias = np.zeros(2, dtype=np.float32)
    # both labels pull alike in sum, however rare one of them is
    stress = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    documents = []
    for counted, _ in rows:
        bucket, n = np.frombuffer(counted, dtype="<u4").reshape(2, -1)
        documents.append((bucket.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            bucket, part = documents[i]
            now = rate * (1 - done / steps)
            done += 1
            mean = part @ vectors[bucket] if len(bucket) else np.zeros(width, dtype=np.float32)
            logit = mean @ weights + bias
            chance = np.exp(logit - logit.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            slope = chance * stress[i]
            back = weights @ slope
            weights -= 0.1 * now * np.outer(mean, slope)
            bias -= 0.1 * now * slope
            if len(bucket):
                # a feature's step goes with its share; a document's shares sum to one
                vectors[bucket] -= (now * width) * part[:, None] * back
    return Model((vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, buckets: int = 1 << 16, max_documents: int = 4000) -> Model:
    """Train on the labelled documents, at most max_documents of them by hash of their id.
    Only their texts are read in full; the sample has the same bound at every input size."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    chosen = known.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(max_documents)
    joined = docs.select(F.col(key), F.col(text).alias("_text")).join(F.broadcast(chosen), key)
    rows = joined.select(F.col(key), "_label", hashed_counts(F.col("_text"), buckets).alias("_counts")).toArrow()
    order = sorted(zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True))
    return train([(counts, label) for _, label, counts in order], buckets)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of every whole text."""
    pull, bias, buckets = model.pull, model.bias, len(model.pull)

    @F.arrow_udf("double")
    def rate(texts: pa.Array) -> pa.Array:
        parts = []
        for block in (b for _, some in portions(texts) for _, b in blocks(some, _BLOCK)):
            total, count = np.zeros(block.n), np.zeros(block.n)
            for bucket, owner in _features(block, buckets):
                total += np.bincount(owner, weights=pull[bucket], minlength=block.n)
                count += np.bincount(owner, minlength=block.n)
            parts.append(Model(pull, bias).probability(total / np.maximum(count, 1) + bias))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return rate(text)
