"""Host-level quality rules.

Every document is first judged by itself (base rules). The failures are then counted by
host, the host's failure rate is shrunk towards the corpus by a beta prior whose mean and
strength are estimated from all hosts, and hosts whose shrunk rate is too high lose all
their documents: a small host with one bad page is not condemned, a large bad one is.

Defined cases: a null or blank text has no words and fails; a null host is judged by the
base rules alone; repeated rows count as often as they occur; an empty table gives an
empty result. Other columns of the input, whatever their names, are not read; reserved
names are those of RULES and "host_rejected".
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmill.llm.textarrays import blocks, portions, shingles

RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_RESULT = T.StructType([T.StructField(name, T.LongType()) for name in RULES])
_BLOCK = 1 << 17
_SYMBOLS = np.zeros(128, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_WINDOW = 8


def _measure(column: pa.Array) -> list[np.ndarray]:
    parts = []
    for block in (b for _, texts in portions(column) for _, b in blocks(texts, _BLOCK)):
        starts, ends, text = block.words()
        n_words = block.per_text(text)
        word_chars = block.per_text(text, ends - starts)
        symbols = np.flatnonzero(_SYMBOLS[np.minimum(block.codes, 127)] & (block.codes < 128))
        n_symbols = block.per_text(block.owner(symbols))

        # lines with a word: their copies beyond the first
        line_from, line_to, line_text = block.lines()
        filled = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
        line_from, line_to, line_text = line_from[filled], line_to[filled], line_text[filled]
        line_hash = block.hashes(line_from, line_to)
        n_dup_lines = block.per_text(line_text[_repeats(line_hash, line_text, first=False)])

        # words in windows that occur twice or more in their text
        window, window_text = shingles(block.hashes(starts, ends), text, _WINDOW)
        inside = np.flatnonzero(window_text >= 0)
        again = inside[_repeats(window[inside], window_text[inside], first=True)]
        edges = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(edges, again, 1)
        np.subtract.at(edges, again + _WINDOW, 1)
        n_repeat_words = block.per_text(text[np.cumsum(edges[:-1]) > 0])
        parts.append([n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words])
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(RULES))]


def _repeats(keys: np.ndarray, owners: np.ndarray, first: bool) -> np.ndarray:
    """Positions of keys that their owner has more than once; without first, not the first of them."""
    order = np.lexsort((np.arange(len(keys)), keys, owners))
    same = (keys[order][1:] == keys[order][:-1]) & (owners[order][1:] == owners[order][:-1])
    repeated = np.zeros(len(keys), dtype=bool)
    repeated[1:] = same
    if first:
        repeated[:-1] |= same
    return order[repeated]


def _measured(text: pa.Array) -> pa.Array:
    found = _measure(text)
    return pa.StructArray.from_arrays([pa.array(x) for x in found], names=RULES)


#: Counts of RULES for every whole text. Called nondeterministic so that a filter on the
#: counts is not pushed below them, which would take them twice.
measures = F.arrow_udf(_measured, _RESULT).asNondeterministic()


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and the counts of RULES."""
    measured = docs.withColumn("_measures", measures(F.col(text)))
    return measured.select(*[measured[c] for c in docs.columns], *[F.col(f"_measures.{r}").alias(r) for r in RULES])


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    """Too short, or too large a share of words in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


@dataclass(frozen=True)
class BetaPrior:
    """Pseudo-counts of failing and passing documents given to every host."""

    failing: float
    passing: float


def empirical_prior(hosts: DataFrame, weakest: float = 2.0, strongest: float = 1000.0) -> BetaPrior:
    """The beta prior of the hosts' failure rates by the method of moments. The spread that
    counting alone explains is taken off first. One row reaches the driver."""
    rate = F.col("n_failed") / F.col("n_docs")
    # each host has one vote, so a host with a third of all rows does not set the prior
    m = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n_docs")).alias("noise")).first()
    if m is None or m["mean"] is None:
        return BetaPrior(weakest / 2, weakest / 2)
    level = min(max(m["mean"], 1e-6), 1 - 1e-6)
    room = level * (1 - level)
    spread = m["spread"] - room * m["noise"]
    strength = strongest if spread <= 0 else min(max(room / spread - 1, weakest), strongest)
    return BetaPrior(level * strength, (1 - level) * strength)


def host_verdicts(judged: DataFrame, host: str, failed: str = "base_failed", limit: float = 0.5) -> DataFrame:
    """One row per host: counts, shrunk failure rate, and whether the host is rejected.
    Counting is partial before the shuffle, so a large host costs no more than a small one."""
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    )
    prior = empirical_prior(hosts)
    shrunk = (F.col("n_failed") + prior.failing) / (F.col("n_docs") + prior.failing + prior.passing)
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("rejected", F.col("shrunk_rate") > limit)


def with_host_verdict(judged: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    """judged with the boolean host_rejected. Only rejected hosts are joined; adaptive
    execution broadcasts them by measured size or splits a hot host's rows."""
    bad = verdicts.where("rejected").select(F.col("host").alias("_bad_host"))
    joined = judged.join(bad, judged[host] == bad["_bad_host"], "left")
    return joined.withColumn("host_rejected", F.col("_bad_host").isNotNull()).drop("_bad_host")
