"""Line deduplication by a segment-partition edit join.

Two lines are copies when, in lower case, at most max_edits insertions, deletions or
substitutions of characters turn one into the other. A line is split into max_edits + 1
segments of even length. A line within that distance leaves at least one of them intact,
at a place that the difference in length bounds, so every line is indexed under its
segments and length, and looks itself up under its substrings at those places for all
lengths down to its own less max_edits. Lines that meet under a key are candidates, and
a banded bit-parallel edit distance decides; all pairs of a batch move through their
columns together. Lines of one bucket that share a segment and differ elsewhere, as those
made from one template do, are told apart by the counts of their letters before that.

Copies form classes (components.linked_components: members meet pivots first, the pairs of
a group are never emitted). Of every class the first line, by document id and line number,
stays in its document.

Lines shorter than edit_chars are copies only when equal in lower case: two edits turn most
of them into some other line, and chains of such pairs run through different texts. Of the
given documents (sf0.1), where lines of less than 26 characters are compared, edits from 3
characters on put 848 different lines into one class, from 7 on 287, from 8 on 16, from 10
on 5. Blank lines part paragraphs and always stay, and so do lines shorter than min_chars,
which the registered queries set to 1. Lines are told apart by 64-bit hashes; a second hash
finds the lines whose first one agrees by chance, and these always stay.

Defined cases: a null text has no line, an empty one a single empty line; rows without id
come last in order; rows with the same key are not told apart: the same line of the same key
counts once and stays in each, so rows whose ids may repeat, or are no integers, need an
integer key of their own and their id, of any type that can be sorted, as the order of
preference; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.llm.components import linked_components
from reachmill.llm.neardup import _forest
from reachmill.llm.scratch import Scratch
from reachmill.llm.textarrays import blocks, mix, portions

_BLOCK = 1 << 18
_BINS = 64
_MARKS = 1 << 24
_U = np.uint64


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def folded_lines(docs: DataFrame, key: str, text: str, min_chars: int, order: str | None = None) -> DataFrame:
    """doc_id (the key), rank (the order of preference), line_no, line_id, check_id and line
    (lower case) of every line that counts."""
    lines = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(order or key).alias("rank"), F.posexplode(split_lines(F.lower(F.col(text)))).alias("line_no", "line"))
    lines = lines.where((F.char_length("line") >= min_chars) & F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.select("doc_id", "rank", "line_no", F.xxhash64("line").alias("line_id"), F.xxhash64(F.lit(1), F.col("line")).alias("check_id"), "line")


def _segments(length: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment i of lines of some lengths; the last ones are longer."""
    short = length // parts
    longer = length - short * parts
    first_long = parts - longer
    return i * short + np.maximum(0, i - first_long), short + (i >= first_long)


def _keys(texts: list[str], max_edits: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """For blocks of lines: first line, number of lines, and arrays of keys with -1 line
    numbers left out as pairs (line number, key)."""
    parts = max_edits + 1
    for begin, block in blocks(texts, _BLOCK):
        length = block.ends - block.starts
        found = []
        for less in range(max_edits + 1):
            other = length - less
            for i in range(parts):
                at, size = _segments(other, parts, i)
                # places that the edits before and after the segment allow
                low = np.maximum(at - i, at + less - (max_edits - i))
                high = np.minimum(at + i, at + less + (max_edits - i))
                low, high = np.maximum(low, 0), np.minimum(high, length - size)
                for shift in range(2 * max_edits + 1):
                    fits = np.flatnonzero((low + shift <= high) & (size > 0))
                    if not len(fits):
                        continue
                    starts = block.starts[fits] + low[fits] + shift
                    key = block.hashes(starts, starts + size[fits])
                    name = other[fits].astype(_U) * _U(0x9E3779B97F4A7C15) + _U(i + 1)
                    found.append((fits, mix(key ^ mix(name))))
        yield begin, block.n, found


def entries(lines: DataFrame, max_edits: int, remembered: int = 200_000) -> DataFrame:
    """bucket and id: every line under its segments and where it looks for others. A task
    skips lines that it has just seen, so a line that a third of all documents share
    enters once a task, and not once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, new = batch.column(0).to_pylist(), []
            for n, i in enumerate(ids):
                if i not in seen:
                    seen.add(i)
                    new.append(n)
            if len(seen) > remembered:
                seen.clear()
            rows = batch.take(pa.array(new, pa.int64()))
            names = rows.column(0).to_numpy()
            for begin, _, found in _keys(rows.column(1).to_pylist(), max_edits):
                for fits, key in found:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(names[begin + fits])], names=["bucket", "id"])

    return lines.select("line_id", "line").mapInArrow(run, "bucket bigint, id bigint")


def within(left: list[str], right: list[str], max_edits: int, limit: int = 1 << 20) -> np.ndarray:
    """Which pairs are at most max_edits apart. As many pairs as have about limit characters
    (one longer pair goes by itself) move through their columns together, so that memory
    is bounded however many the pairs and however long the lines."""
    answer, begin, size = [np.zeros(0, dtype=bool)], 0, 0
    for n, (x, y) in enumerate(zip(left, right, strict=True)):
        length = len(x) + len(y)
        if size and size + length > limit:
            answer.append(_within(left[begin:n], right[begin:n], max_edits))
            begin, size = n, 0
        size += length
    answer.append(_within(left[begin:], right[begin:], max_edits))
    return np.concatenate(answer)


def _within(left: list[str], right: list[str], max_edits: int) -> np.ndarray:
    """The same, all pairs together.

    The band of 2 * max_edits + 1 diagonals is one machine word per pair. Bit b of a word
    stands for row (column - max_edits + b); with every column the band moves down a row."""
    k, width = max_edits, 2 * max_edits + 1
    answer = np.zeros(len(left), dtype=bool)
    open_, a, b = [], [], []
    for n, (x, y) in enumerate(zip(left, right, strict=True)):
        if abs(len(x) - len(y)) > k:
            continue
        # what both begin and end with changes nothing
        x, y = _trimmed(x, y)
        if max(len(x), len(y)) <= k:
            answer[n] = True
        elif min(len(x), len(y)) > k:
            open_.append(n)
            a.append(x)
            b.append(y)
        else:
            answer[n] = _plain(x, y) <= k
    if not open_:
        return answer
    where = np.array(open_)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    # rows beyond either end match nothing
    from_a, from_b = np.cumsum(la + 2 * width) - (la + 2 * width) + width, np.cumsum(lb) - lb
    pad = "\x00" * width
    code_a = np.frombuffer("".join(pad + x + pad for x in a).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    inside_a = np.concatenate([np.r_[np.zeros(width, bool), np.ones(n, bool), np.zeros(width, bool)] for n in la])
    code_a[~inside_a] = -1
    code_b = np.frombuffer("".join(b).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    full, top = (1 << width) - 1, 1 << (width - 1)
    up = np.full(len(a), (full >> k) << k, dtype=np.int64)  # rows 1 to k + 1 begin one above another
    down = np.zeros(len(a), dtype=np.int64)
    score = np.full(len(a), k, dtype=np.int64)
    live = np.arange(len(a))
    column = 0
    while len(live):
        row = from_a[live] + column - k
        char = code_b[from_b[live] + column]
        match = np.zeros(len(live), dtype=np.int64)
        for bit in range(width):
            match |= (code_a[row + bit] == char).astype(np.int64) << bit
        vp, vn = up[live], down[live]
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        left_over = la[live] - k - column  # columns until the band's last row is the last one
        diagonal = left_over > 0
        bit = np.maximum(width - 2 + left_over, 0)  # the last row's bit once the band has passed it
        moved = ((hp >> bit) & 1) - ((hn >> bit) & 1)
        score[live] += np.where(diagonal, (d0 & top) == 0, moved)
        up[live] = (hn | ~((d0 >> 1) | hp)) & full
        down[live] = (d0 >> 1) & hp
        column += 1
        ended = column == lb[live]
        answer[where[live[ended]]] = score[live[ended]] <= k
        # no more than one step back for each column after the band's end
        hopeless = score[live] > k + lb[live] - (la[live] - k)
        live = live[~(ended | hopeless)]
    return answer


def _trimmed(x: str, y: str) -> tuple[str, str]:
    for turn in (1, -1):
        low, high = 0, min(len(x), len(y))
        while low < high:
            mid = (low + high + 1) // 2
            same = x[:mid] == y[:mid] if turn == 1 else x[-mid:] == y[-mid:]
            low, high = (mid, high) if same else (low, mid - 1)
        if low:
            x, y = (x[low:], y[low:]) if turn == 1 else (x[:-low], y[:-low])
    return x, y


def _plain(x: str, y: str) -> int:
    """Edit distance of strings of which one has a few characters."""
    before = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        now = [i]
        for j, d in enumerate(y, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (c != d)))
        before = now
    return before[-1]


def _linked(max_edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, left in portions(batch.column(2)):
                part = batch.slice(begin, len(left))
                right = part.column(3).to_pylist()
                at = np.arange(len(left))
                close = _alike(_letters(left + right), at, at + len(left), max_edits)
                at = at[close]
                close[at] = within([left[n] for n in at], [right[n] for n in at], max_edits)
                yield part.select([0, 1]).filter(pa.array(close))

    def test(pairs: DataFrame, contents: DataFrame) -> DataFrame:
        a = contents.select(F.col("id").alias("a"), F.col("line").alias("_a"))
        b = contents.select(F.col("id").alias("b"), F.col("line").alias("_b"))
        joined = pairs.join(a, "a").join(b, "b").where(F.abs(F.char_length("_a") - F.char_length("_b")) <= max_edits)
        return joined.select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint")

    return test


def _letters(texts: list[str]) -> np.ndarray:
    """How many characters of each line fall into each of 64 bins. An edit changes two of the
    counts by one at most."""
    counts = np.zeros((len(texts), _BINS), dtype=np.int16)
    for begin, block in blocks(texts, _BLOCK):
        owner = np.repeat(np.arange(block.n), block.ends - block.starts)
        found = np.bincount(owner * _BINS + block.codes % _BINS, minlength=block.n * _BINS)
        # a count cut off at the type's end only makes lines more alike
        counts[begin : begin + block.n] = np.minimum(found, np.iinfo(np.int16).max).reshape(block.n, _BINS)
    return counts


def _alike(counts: np.ndarray, left: np.ndarray, right: np.ndarray, max_edits: int, limit: int = 1 << 13) -> np.ndarray:
    """Which pairs of rows differ by no more counts than max_edits edits can change."""
    alike = np.zeros(len(left), dtype=bool)
    for begin in range(0, len(left), limit):
        part = slice(begin, begin + limit)
        differing = counts[left[part]] - counts[right[part]]
        alike[part] = np.abs(differing, out=differing).sum(axis=1, dtype=np.int32) <= 2 * max_edits
    return alike


def linked_rows(rows: pa.Table, max_edits: int, limit: int = 1024) -> Iterator[pa.Table]:
    """Links (a, b) inside the cells of rows (cell, side, id, component, line), which lie cell by
    cell. Cells of about limit rows go together: nearly all of their pairs differ in their
    letters, which costs a few numbers each, and the others move through one edit distance."""
    cell = rows["cell"].to_numpy()
    bounds = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)] if len(cell) else np.zeros(1, dtype=np.int64)
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        part = rows.slice(bounds[first], bounds[last] - bounds[first])
        ids, component, side = (part[c].to_numpy() for c in ("id", "component", "side"))
        line = part["line"].to_pylist()
        length = np.fromiter(map(len, line), dtype=np.int64, count=len(line))
        pairs = []
        for begin, end in zip(bounds[first:last] - bounds[first], bounds[first + 1 : last + 1] - bounds[first], strict=True):
            n, c, free = length[begin:end], component[begin:end], side[begin:end] == 0
            near = (np.abs(n[:, None] - n[None, :]) <= max_edits) & (c[:, None] != c[None, :]) & (free[:, None] | free[None, :])
            pairs.append(np.argwhere(np.triu(near, 1)) + begin)
        i, j = np.concatenate(pairs).T
        if len(i):
            alike = _alike(_letters(line), i, j, max_edits)
            i, j = i[alike], j[alike]
            close = within([line[n] for n in i], [line[n] for n in j], max_edits)
            yield _forest(ids, component, i[close], j[close])
        first = last


def _linked_inside(max_edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            # the last cell may go on in the next batch
            cell = rows["cell"].to_numpy()
            whole = int(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[-1]) if len(cell) else 0
            for links in linked_rows(rows.slice(0, whole), max_edits):
                yield from links.to_batches()
            held = rows.slice(whole)
        if held is not None:
            for links in linked_rows(held, max_edits):
                yield from links.to_batches()

    def compare(cells: DataFrame) -> DataFrame:
        # cells whose hashes agree by chance are compared as one: a link is a link in any cell
        named = cells.select(F.xxhash64("cell").alias("cell"), "side", "id", "component", "line")
        return named.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a bigint, b bigint")

    return compare


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with one of the ids, and few others: the ids mark bits of a map of bounded size,
    which every task gets. Most lines share no bucket, and their texts need not be shuffled."""
    at = F.pmod(F.xxhash64("id"), F.lit(_MARKS))
    word, bit = F.shiftright(at, 6).alias("_word"), at.bitwiseAND(F.lit(63)).cast("int").alias("_bit")
    marks = ids.select(word, bit).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_marks"))
    found = rows.select("*", word, bit).join(F.broadcast(marks), "_word").where(F.getbit("_marks", "_bit") == 1)
    return found.select(*rows.columns)


def classes(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", max_edits: int = 2, min_chars: int = 20, edit_chars: int = 10, order: str | None = None) -> DataFrame:
    """One row for every line that counts: doc_id, line_no, class_doc_id, class_line_no (where
    its class comes first) and kept. The ids are those of key; order names the column by
    which a class's first line is told, before key, if it is not key itself."""
    if edit_chars <= max_edits:
        raise ValueError("a line needs more characters than edits")
    lines = folded_lines(docs, key, text, min_chars, order)
    edited = lines.where(F.char_length("line") >= edit_chars)
    # one shuffle by key serves both the counting of a bucket and the look at its members
    members = entries(edited, max_edits).repartition("bucket")

    def contents_of(ids: DataFrame) -> DataFrame:
        # by sort and merge at every size, as ids grow with the input; written before copies
        # go, since the join alone can be split where a line is very common
        # (an inner join, each id being there once: a semi join would be put before the marks)
        wanted = _marked(edited.select(F.col("line_id").alias("id"), "line"), ids).join(ids.hint("merge"), "id")
        return scratch.keep(wanted, "wanted").dropDuplicates(["id"])

    linked = linked_components(members, contents_of, _linked(max_edits), _linked_inside(max_edits), scratch)
    scratch.drop("wanted")

    place = F.struct(F.col("rank").isNull().alias("last"), "rank", "doc_id", "line_no")
    placed = scratch.keep(lines.select("doc_id", "rank", "line_no", "line_id", "check_id"), "places")
    texts = placed.groupBy("line_id").agg(F.min(place).alias("first"), F.min("check_id").alias("low"), F.max("check_id").alias("high"))
    clear = texts.where("low = high").select(F.col("line_id").alias("id"), "first")
    classed = clear.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    firsts = classed.groupBy("component").agg(F.min("first").alias("class_first"))
    by_line = classed.join(firsts, "component").select(F.col("id").alias("line_id"), "class_first")
    found = placed.join(by_line, "line_id", "left").withColumn("class_first", F.coalesce("class_first", place))
    kept = (F.col("doc_id").eqNullSafe(F.col("class_first.doc_id"))) & (F.col("line_no") == F.col("class_first.line_no"))
    return found.select("doc_id", "line_no", F.col("class_first.doc_id").alias("class_doc_id"), F.col("class_first.line_no").alias("class_line_no"), kept.alias("kept"))


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the lines that the rows (doc_id, line_no) name."""
    gone = dropped.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line_no").alias("_gone"))
    joined = docs.join(gone, F.col(key).cast("long") == F.col("_id"), "left")
    stay = F.filter(split_lines(F.col(text)), lambda _, n: ~F.array_contains(F.col("_gone"), n))
    kept = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    return joined.withColumn(text, kept).drop("_id", "_gone")
