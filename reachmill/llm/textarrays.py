"""Texts as numpy arrays of code points, their words, lines and hashes, many texts at a time.

Everything works on a Block: the code points of some texts one after another. A word is a
run without space, tab, line feed, vertical tab, form feed or carriage return. Hashes of
any stretch come from one running polynomial sum, so their cost does not depend on the
length of the stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i below n."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            table = np.ones(size, dtype=_U)
            filled = 1
            while filled < size:
                table[filled : 2 * filled] = table[:filled] * _U(pow(factor, filled, 1 << 64))
                filled *= 2
            tables.append(table)
        known = _powers[base] = (tables[0], tables[1])
    return known


class Block:
    """Some texts. lower folds A-Z to a-z, and nothing else."""

    def __init__(self, texts: list[str], lower: bool = False):
        self.n = len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        raw = "".join(texts).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, dtype="<u4")
        if lower:
            codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
        self.codes = codes
        self._sums: dict[int, np.ndarray] = {}

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text that each position lies in."""
        return np.searchsorted(self.ends, positions, side="right")

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every word, in order."""
        c = self.codes
        inside = ~((c == 32) | ((c >= 9) & (c <= 13)))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        own = self.starts[self.starts < len(c)]
        first[own] = inside[own]
        closing = self.ends[self.ends > 0] - 1
        last[closing] = inside[closing]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, self.owner(starts)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every line; a text of n line feeds has n + 1 lines."""
        breaks = np.flatnonzero(self.codes == 10)
        starts = np.concatenate([self.starts, breaks + 1])
        ends = np.concatenate([self.ends, breaks])
        text = np.concatenate([np.arange(self.n), self.owner(breaks)])
        by_start = np.lexsort((starts, text))
        by_end = np.lexsort((ends, text))
        return starts[by_start], ends[by_end], text[by_start]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each stretch; equal stretches have equal hashes wherever they lie."""
        base = (_BASE + 2 * seed * 0x5851F42D4C957F2D) & _MASK | 1
        n = len(self.codes) + 1
        up, down = _power_table(n, base)
        sums = self._sums.get(seed)
        if sums is None:
            sums = np.zeros(n, dtype=_U)
            spread = mix(self.codes.astype(_U) + _U(seed * 0x1000003D + 1))
            np.cumsum(spread * up[: n - 1], out=sums[1:])
            self._sums[seed] = sums
        found = (sums[ends] - sums[starts]) * down[starts]
        return mix(found + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def per_text(self, owners: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """How many of the owners are each text, or the sum of their weights, as integers."""
        counted = np.bincount(owners, weights=weights, minlength=self.n)
        return counted.astype(np.int64)


def blocks(texts: list[str | None], limit: int, lower: bool = False) -> Iterator[tuple[int, Block]]:
    """The texts in blocks of about limit code points (one longer text has its own), each
    with the number of its first text. A null counts as empty."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        length = len(text) if text else 0
        if size and size + length > limit:
            yield begin, Block([t or "" for t in texts[begin:i]], lower)
            begin, size = i, 0
        size += length
    if begin < len(texts):
        yield begin, Block([t or "" for t in texts[begin:]], lower)


def portions(column, rows: int = 256) -> Iterator[tuple[int, list]]:
    """An Arrow column as short lists of Python values, each with the number of its first row:
    a batch of thousands of texts never stands in memory twice."""
    for begin in range(0, len(column), rows):
        yield begin, column.slice(begin, rows).to_pylist()


def shingles(word_hashes: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of n words of one text, in order."""
    if len(word_hashes) < n:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    count = len(word_hashes) - n + 1
    found = np.zeros(count, dtype=_U)
    for k in range(n):
        found = found * _U(0x9E3779B97F4A7C15) + word_hashes[k : k + count]
    whole = owners[:count] == owners[n - 1 :]
    return mix(found), np.where(whole, owners[:count], -1)


def distinct(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different keys, sorted by text and key."""
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return keys[new], owners[new]
