"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is cut into units (a word with the spaces before it); no piece of the vocabulary
reaches over the end of a unit, so units are merged apart from each other. Every unit has
an agenda of candidate merges. The best candidate is taken again and again; a candidate
is skipped when a hash keyed by seed, document, the unit and its place in the document, the
place inside the unit and the resulting piece falls below the dropout rate. So a document
is cut alike on every run and every cluster, while the same word is cut otherwise
elsewhere in it, in other documents, or with another seed. With rate 0 the result is the
model's own segmentation.

All units of many texts are merged together in numpy: one round takes the best candidate
of each unit that still has one. A unit of more than a thousand characters (text without
spaces, encoded data) has an agenda of its own, a heap over linked neighbours, whose cost
grows with the unit's length and not with its square. Without dropout equal units are
merged once.

Spaces become the model's space mark, with one put in front of the text. Characters
outside the vocabulary, and a space mark that stands in the text itself, become byte
pieces. Decoding undoes all of this, so every text comes back exactly.

Defined cases: a null text has null ids and decodes to null; an empty text has no ids;
repeated rows are cut alike; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmill.llm.textarrays import Block, blocks, mix, portions

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_SPACE = 0x2581
_BLOCK = 1 << 17
_NEVER = np.int32(1 << 30)
_U = np.uint64
_ALL = (1 << 64) - 1
_LONG = 1024


@dataclass
class Vocabulary:
    """A model's pieces as arrays."""

    pieces: list[bytes]
    codes: np.ndarray = field(repr=False)  # sorted code points that are pieces
    code_ids: np.ndarray = field(repr=False)
    byte_ids: np.ndarray = field(repr=False)  # piece of each byte
    slots: np.ndarray = field(repr=False)  # open addressing: pair of pieces + 1, 0 for none
    merged: np.ndarray = field(repr=False)
    rank: np.ndarray = field(repr=False)  # by piece: smaller is merged earlier

    @staticmethod
    def of(model: bytes) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        ordinary = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any("▁" in p.lstrip("▁") for p in ordinary):
            raise ValueError("pieces of this model reach over word boundaries")
        by_score = sorted(ordinary.values(), key=lambda i: (-sp.get_score(i), i))
        rank = np.full(n, _NEVER, dtype=np.int32)
        rank[by_score] = np.arange(len(by_score))
        single = sorted((ord(p), i) for p, i in ordinary.items() if len(p) == 1)
        pairs = {}
        for piece, i in ordinary.items():
            for cut in range(1, len(piece)):
                left, right = ordinary.get(piece[:cut]), ordinary.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * n + right] = i
        size = 1 << (4 * len(pairs) - 1).bit_length()
        slots, merged = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int32)
        for key, i in pairs.items():
            at = int(mix(np.array([key], dtype=_U))[0]) & (size - 1)
            while slots[at]:
                at = (at + 1) & (size - 1)
            slots[at], merged[at] = key + 1, i
        raw = [b""] * n
        byte_ids = np.full(256, -1, dtype=np.int32)
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                raw[i], byte_ids[value] = bytes([value]), i
        for piece, i in ordinary.items():
            raw[i] = piece.replace("▁", " ").encode()
        if (byte_ids < 0).any():
            raise ValueError("this model has no byte pieces, so it cannot spell every text")
        return Vocabulary(raw, np.array([c for c, _ in single], dtype=np.uint32), np.array([i for _, i in single], dtype=np.int32), byte_ids, slots, merged, rank)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """What joined looks up, for one pair at a time."""
        used = np.flatnonzero(self.slots)
        return dict(zip((self.slots[used] - 1).tolist(), self.merged[used].tolist(), strict=True))

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The piece of each code point, or minus the code point where there is none."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.code_ids[at], -codes.astype(np.int32))

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * len(self.pieces) + right, -2)
        found = np.full(len(keys), -1, dtype=np.int32)
        at = (mix(keys.astype(_U)) & _U(len(self.slots) - 1)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            here = self.slots[at[open_]]
            hit = here == keys[open_] + 1
            found[open_[hit]] = self.merged[at[open_[hit]]]
            open_ = open_[~hit & (here != 0)]
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
        return found


_known: dict[str, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    name = hashlib.sha256(model).hexdigest()
    if name not in _known:
        _known[name] = Vocabulary.of(model)
    return _known[name]


def merged_units(vocabulary: Vocabulary, symbol: np.ndarray, unit: np.ndarray, key: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Run the agendas of all units. symbol and unit (ascending) describe their characters;
    key is a 64-bit number for each unit. Returns the same pair after all merges."""
    place = np.arange(len(symbol)) - np.searchsorted(unit, unit)
    edge = _U(min(int(dropout * 2.0**64), _ALL))
    done_symbol, done_unit = [], []
    long = np.flatnonzero(np.bincount(unit) > _LONG) if len(unit) else unit
    for u in long.tolist():
        begin, end = np.searchsorted(unit, [u, u + 1])
        done_symbol.append(_merged_long(vocabulary, symbol[begin:end], int(key[u]), dropout))
        done_unit.append(np.full(len(done_symbol[-1]), u, dtype=unit.dtype))
    if len(long):
        short = ~np.isin(unit, long)
        symbol, unit, place = symbol[short], unit[short], place[short]

    def candidates(at: np.ndarray, sym: np.ndarray, own: np.ndarray, pos: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of merging each symbol of at with the one after it."""
        piece = vocabulary.joined(sym[at], sym[following])
        usable = piece >= 0
        if dropout > 0:
            draw = mix(key[own[at]] ^ mix(pos[at].astype(_U) * _U(1 << 32) + piece.astype(_U)))
            usable &= draw >= edge
        return np.where(usable, vocabulary.rank[np.maximum(piece, 0)], _NEVER), piece

    sym, own, pos = symbol, unit, place
    rank = np.full(len(sym), _NEVER, dtype=np.int32)
    piece = np.full(len(sym), -1, dtype=np.int32)
    inner = np.flatnonzero(own[1:] == own[:-1]) if len(own) else np.zeros(0, dtype=np.int64)
    rank[inner], piece[inner] = candidates(inner, sym, own, pos, inner + 1)
    while len(sym):
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        best = np.minimum.reduceat(rank, heads)
        sizes = np.diff(np.append(heads, len(own)))
        live = np.repeat(best < _NEVER, sizes)
        if not live.all():
            done_symbol.append(sym[~live])
            done_unit.append(own[~live])
            heads_live = best < _NEVER
            best, sizes = best[heads_live], sizes[heads_live]
            sym, own, pos, rank, piece = sym[live], own[live], pos[live], rank[live], piece[live]
            if not len(sym):
                break
        # of equally good candidates the leftmost
        equal = np.flatnonzero(rank == np.repeat(best, sizes))
        chosen = equal[np.concatenate([[True], own[equal][1:] != own[equal][:-1]])]
        sym[chosen] = piece[chosen]
        keep = np.ones(len(sym), dtype=bool)
        keep[chosen + 1] = False
        moved = np.cumsum(keep) - 1
        sym, own, pos, rank, piece = sym[keep], own[keep], pos[keep], rank[keep], piece[keep]
        now = moved[chosen]
        rank[now] = _NEVER
        for at in (now[now + 1 < len(own)], now[now > 0] - 1):
            at = at[own[at] == own[at + 1]]
            rank[at], piece[at] = candidates(at, sym, own, pos, at + 1)
    if not done_symbol:
        return symbol, unit
    sym, own = np.concatenate(done_symbol), np.concatenate(done_unit)
    order = np.argsort(own, kind="stable")
    return sym[order], own[order]


def _merged_long(vocabulary: Vocabulary, symbol: np.ndarray, key: int, dropout: float) -> np.ndarray:
    """The same for one long unit, with a heap of candidates. An entry whose symbols have
    changed since is passed over when its turn comes."""
    n, rank = len(vocabulary.pieces), vocabulary.rank
    edge = min(int(dropout * 2.0**64), _ALL) if dropout > 0 else 0
    sym = symbol.tolist()
    after = [*range(1, len(sym)), -1]
    before = [-1, *range(len(sym) - 1)]
    heap: list[tuple[int, int, int, int]] = []  # rank, place, its symbol, the one after it

    def candidate(at: int) -> tuple[int, int, int, int] | None:
        left, right = sym[at], sym[after[at]]
        piece = vocabulary.pairs.get(left * n + right, -1) if left >= 0 and right >= 0 else -1
        if piece < 0 or (edge and _mixed(key ^ _mixed(((at << 32) + piece) & _ALL)) < edge):
            return None
        return int(rank[piece]), at, left, right

    for at in range(len(sym) - 1):
        if (found := candidate(at)) is not None:
            heap.append(found)
    heapq.heapify(heap)
    gone = [False] * len(sym)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        following = after[at]
        if gone[at] or following < 0 or sym[at] != left or sym[following] != right:
            continue
        sym[at] = vocabulary.pairs[left * n + right]
        gone[following], after[at] = True, after[following]
        if after[at] >= 0:
            before[after[at]] = at
        for changed in (at, before[at]):
            if changed >= 0 and after[changed] >= 0 and (found := candidate(changed)) is not None:
                heapq.heappush(heap, found)
    return np.array([s for s, g in zip(sym, gone, strict=True) if not g], dtype=symbol.dtype)


def _mixed(x: int) -> int:
    """textarrays.mix of one number."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _ALL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def _units(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of the block's texts begin, and their text. A unit begins with the
    first space of a run, at a line feed and after it, and at the start of a text."""
    c = block.codes
    space, feed = c == 32, c == 10
    begins = np.zeros(len(c), dtype=bool)
    begins[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    begins[block.starts[block.ends > block.starts]] = True
    starts = np.flatnonzero(begins)
    return starts, block.owner(starts)


def encoded(vocabulary: Vocabulary, texts: list[str | None], keys: list[str], dropout: float, seed: int) -> list[np.ndarray | None]:
    """The ids of every text; keys are what the dropout of a text depends on."""
    found: list[np.ndarray | None] = []
    # the mark in front of the text is a space like any other
    spaced = [None if t is None else " " + t if t else "" for t in texts]
    for begin, block in blocks(spaced, _BLOCK):
        starts, text = _units(block)
        ends = np.append(starts[1:], len(block.codes)) if len(starts) else starts
        names = np.array([int.from_bytes(hashlib.blake2b(f"{seed}:{k}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for k in keys[begin : begin + block.n]], dtype=_U)
        unit_key = block.hashes(starts, ends)
        if dropout > 0:
            place = np.arange(len(text)) - np.searchsorted(text, text)
            unit_key = mix(unit_key + names[text] * _U(0x9E3779B97F4A7C15) + mix(place.astype(_U)))
        # units of one key are merged once
        _, first, kind = np.unique(unit_key, return_index=True, return_inverse=True)
        sizes = (ends - starts)[first]
        at = np.repeat(starts[first] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        codes = block.codes[at]
        symbol = vocabulary.symbols(np.where(codes == 32, np.uint32(_SPACE), codes))
        symbol = np.where(codes == _SPACE, -np.int32(_SPACE), symbol).astype(np.int32)
        ids, own = merged_units(vocabulary, symbol, np.repeat(np.arange(len(first)), sizes), unit_key[first], dropout)
        ids, own = _spelled(vocabulary, ids, own)
        n_ids = np.bincount(own, minlength=len(first))
        from_ = np.cumsum(n_ids) - n_ids
        here = n_ids[kind]
        flat = ids[np.repeat(from_[kind] - np.cumsum(here) + here, here) + np.arange(here.sum())]
        per_text = np.bincount(text, weights=here, minlength=block.n).astype(np.int64)
        cuts = np.cumsum(per_text)
        for i in range(block.n):
            found.append(None if texts[begin + i] is None else flat[cuts[i] - per_text[i] : cuts[i]])
    return found


def _spelled(vocabulary: Vocabulary, ids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece, as byte pieces."""
    odd = ids < 0
    if not odd.any():
        return ids, own
    code, which = np.unique(-ids[odd], return_inverse=True)
    spelling = [vocabulary.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in code.tolist()]
    lengths = np.array([len(s) for s in spelling])
    times = np.ones(len(ids), dtype=np.int64)
    times[odd] = lengths[which]
    out, own = np.repeat(ids, times), np.repeat(own, times)
    starts = (np.cumsum(times) - times)[odd]
    for k in range(4):
        fits = lengths[which] > k
        out[starts[fits] + k] = np.array([s[k] if len(s) > k else 0 for s in spelling], dtype=np.int32)[which[fits]]
    return out, own


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of some ids, without the space in front."""
    raw = b"".join([vocabulary.pieces[i] for i in ids.tolist()])
    return raw.decode("utf-8", "surrogatepass").removeprefix(" ")


def model_bytes(path: str = DEFAULT_MODEL) -> bytes:
    """The vocabulary file, half a megabyte, read once by the driver and sent with the tasks,
    so that no executor needs the file."""
    with open(path, "rb") as source:
        return source.read()


def _id_lists(found: list[np.ndarray | None]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([0 if f is None else len(f) for f in found])]).astype(np.int32)
    parts = [f for f in found if f is not None and len(f)]
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([f is None for f in found], pa.bool_()))


def encode(text: Column, key: Column, model: bytes, dropout: float = 0.1, seed: int = 0) -> Column:
    """Array of piece ids of every whole text; key names the document for the dropout."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        names, found = [str(k) for k in keys.to_pylist()], []
        for begin, some in portions(texts):
            found += encoded(_vocabulary(model), some, names[begin : begin + len(some)], dropout, seed)
        return _id_lists(found)

    return run(text, key)


def decode(ids: Column, model: bytes) -> Column:
    """The text of every array of ids."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(model)
        values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        null = column.is_null().to_numpy(zero_copy_only=False)
        return pa.array([None if null[i] else decoded(vocabulary, values[offsets[i] : offsets[i + 1]]) for i in range(len(column))], pa.string())

    return run(ids)


def encoded_documents(docs: DataFrame, model: bytes, keep: list[str], text: str = "text", key: str = "doc_id", dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """The columns keep of docs, piece_ids, and lossless: whether decoding gives the text back.
    Both come from one pass in small batches; decode(encode(text)) next to encode(text)
    would encode twice, as Spark evaluates nested functions anew for each use."""
    fields = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())]
    keep = [c for c in keep if c not in ("piece_ids", "lossless")]
    rows = docs.select(F.col(text), F.col(key), *[F.col(c) for c in keep])
    schema = T.StructType([*(docs.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            for begin, given in portions(batch.column(0)):
                part = batch.slice(begin, len(given))
                found = encoded(vocabulary, given, [str(k) for k in part.column(1).to_pylist()], dropout, seed)
                same = [ids is None if t is None else decoded(vocabulary, ids) == t for ids, t in zip(found, given, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], _id_lists(found), pa.array(same, pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)
