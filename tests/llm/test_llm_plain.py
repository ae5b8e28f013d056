"""Helpers of the training text operators, without Spark."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from reachmill.llm import classifier, extraction, lines, mixing, neardup, pieces, warc
from reachmill.llm.labelled_pages import labelled_pages
from reachmill.llm.textarrays import Block, blocks, mix

TEXTS = ["", "a", " two words\n\nA  a\ta ", "Été 漢字 \U0001f600 x\x0bA\r\n", "\n", "word " * 50]


def plain_words(text):
    return [w.decode() for w in text.encode().split()]


def test_words_lines_and_hashes_are_those_of_the_texts():
    block = Block(TEXTS)
    starts, ends, text = block.words()
    joined = "".join(TEXTS)
    found = [[joined[s:e] for s, e, t in zip(starts, ends, text) if t == i] for i in range(len(TEXTS))]
    assert found == [plain_words(t) for t in TEXTS]
    starts, ends, text = block.lines()
    found = [[joined[s:e] for s, e, t in zip(starts, ends, text) if t == i] for i in range(len(TEXTS))]
    assert found == [t.split("\n") for t in TEXTS]
    both = Block(["abc abd", "x abc"])
    starts, ends, _ = both.words()
    h = both.hashes(starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3


def test_blocks_hold_every_text_once_and_long_ones_alone():
    texts = ["a" * 5, None, "b" * 100, "", "c"]
    assert [(n, b.n) for n, b in blocks(texts, 10)] == [(0, 2), (2, 1), (3, 2)]
    assert list(blocks([], 10)) == []


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_and_segment_keys_agree_with_plain_distance(edits):
    r = random.Random(edits)
    left, right = [], []
    for _ in range(800):
        x = "".join(r.choices("abc", k=r.randint(1, 25)))
        y = list(x)
        for _ in range(r.randint(0, 5)):
            at = r.randint(0, len(y))
            y[at : at + r.choice([0, 1])] = r.choice(["", "a", "b"])
        left.append(x)
        right.append("".join(y))
    near = np.array([lines._plain(x, y) <= edits for x, y in zip(left, right)])
    assert (lines.within(left, right, edits) == near).all()
    keys = {}
    for begin, _, found in lines._keys(left + right, edits):
        for fits, key in found:
            for n, k in zip(fits.tolist(), key.tolist()):
                keys.setdefault(begin + n, set()).add(k)
    for i in np.flatnonzero(near):
        if min(len(left[i]), len(right[i])) > edits:
            assert keys[int(i)] & keys[int(i) + len(left)]


def test_lines_of_one_template_are_told_apart_by_their_letters(monkeypatch):
    r = random.Random(4)
    name = lambda: "".join(r.choices("abcdefghijklmnop", k=12))
    cells, texts = [], []
    for cell, size in enumerate([1, 2, 250, 3, 250, 40]):
        for n in range(size):
            line = f"posted in the forum of the town by {name()} some day"
            # some lines of a cell are near copies of the one before
            texts.append(texts[-1].replace("some", "same") + "s" * (n % 2) if n % 25 == 1 else line)
            cells.append(cell)
    ids = list(range(len(texts)))
    rows = pa.table({"cell": cells, "side": [i % 2 for i in ids], "id": ids, "component": [i // 2 * 2 for i in ids], "line": texts})
    tested, within = [], lines.within
    monkeypatch.setattr(lines, "within", lambda left, right, edits: tested.extend(left) or within(left, right, edits))
    found = [{(a, b) for t in lines.linked_rows(rows, 2, limit) for a, b in zip(t["a"].to_pylist(), t["b"].to_pylist())} for limit in (1, 100, 1024)]
    free = lambda i, j: cells[i] == cells[j] and i // 2 != j // 2 and not (i % 2 and j % 2)
    pairs = [(i, j) for j in ids for i in range(j) if free(i, j)]
    near = within([texts[i] for i, _ in pairs], [texts[j] for _, j in pairs], 2)
    links = {pair for pair, close in zip(pairs, near) if close}
    assert links and found[0] == found[1] == found[2] == links
    assert len(tested) < 3 * len(pairs) / 50
    assert list(lines.linked_rows(rows.slice(0, 0), 2)) == []


def test_the_counts_of_letters_let_every_near_pair_pass():
    r = random.Random(5)
    left, right = [], []
    for _ in range(500):
        x = "".join(r.choices("ab é漢\U0001f600", k=r.randint(10, 40)))
        y = list(x)
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(y))
            y[at : at + r.choice([0, 1])] = r.choice(["", "a", "漢"])
        left.append(x)
        right.append("".join(y))
    left.append("a" * 70_000)
    right.append("a" * 69_998)
    counts, at = lines._letters(left + right), np.arange(len(left))
    for edits in (1, 2, 3):
        near = lines.within(left, right, edits)
        assert lines._alike(counts, at, at + len(left), edits, limit=64)[near].all()


def test_quotas_and_flow():
    assert mixing.quotas({"a": 10, "b": 100, None: 100}, 210) == {"a": 30.0, "b": 72.0, None: 108.0}
    assert mixing.quotas({}, 0) == {}
    # words that both sources may take go where they are missed
    supplies = [(frozenset("a"), 10.0), (frozenset("ab"), 50.0), (frozenset("b"), 40.0)]
    used = mixing.cheapest_flow(supplies, {"a": 50.0, "b": 50.0})
    assert sum(used) == pytest.approx(100) and used == pytest.approx([10, 50, 40])
    # a pattern is not repeated before all others are used up
    used = mixing.cheapest_flow([(frozenset("a"), 10.0), (frozenset("ab"), 10.0)], {"a": 15.0, "b": 5.0})
    assert used == pytest.approx([10, 10])
    used = mixing.cheapest_flow([(frozenset("a"), 10.0)], {"a": 30.0})
    assert used == pytest.approx([30])


def test_flow_costs_no_more_than_any_other_in_units():
    supplies = [(frozenset("a"), 1.0), (frozenset("ab"), 1.0), (frozenset("b"), 2.0)]
    for a, b in itertools.product(range(4), range(5)):
        used = mixing.cheapest_flow(supplies, {"a": float(a), "b": float(b)})
        cost = lambda u: sum(s * (n * (n - 1) / 2) + (x - n * s) * n for x, (_, s) in zip(u, supplies) for n in [int(x // s)])
        best = min(
            cost(u)
            for u in itertools.product(range(4), range(4), range(7))
            if sum(u) == a + b and u[0] <= a and u[2] <= b and u[0] + u[1] >= a and u[1] + u[2] >= b
        )
        assert sum(used) == pytest.approx(a + b) and cost(used) == pytest.approx(best), (a, b, used)


def test_archive_round_trip_and_what_breaks_it():
    records = [warc.record(i, None if i == 3 else f"http://x/{i}%\n", b"<p>%d</p>" % (i % 2), None if i < 2 else i % 2) for i in range(5)]
    raw = b"".join(warc.archive(iter(records)))
    for size in (1, 7, 1 << 16):
        chunks = (raw[i : i + size] for i in range(0, len(raw), size))
        assert list(warc.frames(chunks)) == records
    page, url, size, digest, kind, refers, payload = warc.parsed(records[4])
    assert (page, url, size, kind, refers, payload) == (4, "http://x/4%\n", 8, "revisit", 0, None)
    assert digest == warc.payload_digest(b"<p>0</p>") and warc.parsed(records[3])[1] is None
    assert b"".join(warc.archive(iter([]))) == b""
    for broken in (records[0][:-1], records[0].replace(b"WARC/1.1", b"WARD/1.1"), records[0].replace(b"<p>0", b"<p>1"), b"x"):
        with pytest.raises(warc.BrokenArchive):
            warc.parsed(broken)
    for torn in (raw[:-3], raw[4:], raw[:9], raw + b"junk"):
        with pytest.raises((warc.BrokenArchive, warc.zstandard.ZstdError)):
            list(warc.frames(iter([torn])))


@pytest.fixture(scope="module")
def vocabulary():
    return pieces._vocabulary(pieces.model_bytes())


def test_without_dropout_the_pieces_are_the_models(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    texts = [t for t in TEXTS if t]
    found = pieces.encoded(vocabulary, texts, list("abcdefg")[: len(texts)], 0.0, 0)
    assert [f.tolist() for f in found] == sp.encode(texts)


def test_dropout_varies_by_document_and_seed_and_always_decodes(vocabulary):
    texts = [*TEXTS, None, "▁ mark ▁▁", "the same long sentence of ordinary words " * 5, "the same long sentence of ordinary words " * 5]
    keys = [str(i) for i in range(len(texts))]
    once = pieces.encoded(vocabulary, texts, keys, 0.3, 1)
    again = pieces.encoded(vocabulary, texts, keys, 0.3, 1)
    other = pieces.encoded(vocabulary, texts, keys, 0.3, 2)
    assert [None if x is None else pieces.decoded(vocabulary, x) for x in once] == texts
    assert all(a is b is None or (a == b).all() for a, b in zip(once, again))
    assert once[-1].tolist() != once[-2].tolist() and once[-1].tolist() != other[-1].tolist()
    assert len(pieces.encoded(vocabulary, ["plain words"], ["k"], 1.0, 0)[0]) == len(" plain words")


def test_marginals_are_those_of_enumeration():
    trees = extraction.forest(["<div><p>a</p><nav><p>b</p></nav></div>", "<p>x</p>"])
    r = np.random.default_rng(0)
    model = extraction.Model(r.normal(size=4093), r.normal(size=(2, 2)))
    own = extraction._scores(trees, model.unary)
    chance, joint = extraction.marginals(trees, model)
    n = len(own)
    weights = {}
    for values in itertools.product((0, 1), repeat=n):
        total = sum(own[i] * v for i, v in enumerate(values))
        total += sum(model.pair[values[p], values[i]] for i, p in enumerate(trees.parent) if p >= 0)
        weights[values] = np.exp(total)
    z = sum(weights.values())
    for i in range(n):
        assert chance[i] == pytest.approx(sum(w for v, w in weights.items() if v[i]) / z)
        if trees.parent[i] >= 0:
            both = sum(w for v, w in weights.items() if v[i] and v[trees.parent[i]]) / z
            assert joint[i, 1, 1] == pytest.approx(both)


def test_extraction_on_pages_it_has_not_seen_and_odd_ones():
    model = extraction.default_model()
    trees = extraction.forest(labelled_pages(200, seed=5))
    chance, _ = extraction.marginals(trees, model)
    told = [(chance[e] > 0.5) == trees.label[e] for page in trees.texts for e, _ in page]
    assert np.mean(told) > 0.98
    page = "<html><body><nav><a href=/>Home</a></nav><article><h1>T &amp; t</h1><p>One\n <b>two</b><script>'</p>'</script> three.<p>Four.</article><footer>&copy; x</footer>"
    assert extraction.main_texts([None, "", page, "<p"], model) == ["", "", "T & t\n\nOne two three.\n\nFour.", ""]


def test_an_open_head_ends_and_only_what_is_not_shown_is_silent():
    model = extraction.default_model()
    page = "<html><head><title>T</title>{}<body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>One sentence of some words{} and its end.</p>{}<p>Another sentence, with more words.</p></article></body></html>"
    whole = "A title\n\nOne sentence of some words and its end.\n\nAnother sentence, with more words."
    for head in ("</head>", "", "<meta charset=utf-8><style>p {{}}</style><script>'<p>'</script>", "<noscript><style>x</style></noscript>", "<noscript><img src=x></noscript></head>", "<template><p>no</p></template>"):
        assert extraction.main_texts([page.format(head, "", "")], model) == [whole], head
    no_body = page.replace("<body>", "").format("", "", "")
    assert extraction.main_texts([no_body], model) == [whole]
    bare = extraction._parse("<head><title>T</title> Words first <p>More</p>")
    assert ["".join(b[1]).strip() for b in bare.blocks] == ["Words first", "More"]
    # formulas run on, and media without content part no text
    assert extraction.main_texts([page.format("", " <math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "")], model) == [whole.replace("words and", "words x=2 and")]
    assert extraction.main_texts([page.format("", "<audio src=a></audio><video><source src=b></video>", "")], model) == [whole]
    for tag in ("noscript", "object", "canvas", "audio", "video"):
        trees = extraction.forest([page.format("", "", f"<{tag}><p>This tells in words what is shown here.</p></{tag}>")])
        assert "This tells in words what is shown here." in [text for _, text in trees.texts[0]], tag
        assert "This tells in words what is shown here." in extraction.main_texts([page.format("", "", f"<{tag}><p>This tells in words what is shown here.</p></{tag}>")], model)[0], tag


def test_signatures_shift_one_permutation():
    block = Block(["a b c d e", "", "x"], lower=True)
    sets, owner = neardup._sets(block, 3)
    assert np.bincount(owner, minlength=3).tolist() == [3, 0, 1]
    has, found = neardup.signatures(sets, owner, 3, 8, 1)
    spread, circulant = neardup._permutations(1, 8)
    second = circulant[:, 0]
    for row, text in enumerate(has):
        place = spread[(sets[owner == text] & np.uint64(neardup._D - 1)).astype(int)]
        assert found[row].tolist() == [min(second[(p + k) % neardup._D] for p in place) for k in range(8)]


def test_training_without_both_labels_gives_the_share():
    assert classifier.train([], 16).probability(np.zeros(1))[0] == pytest.approx(0.5)
    assert classifier.Model(np.zeros(4), 2.0).probability(np.array([2.0]))[0] > 0.8


def test_pairs_are_told_alike_in_portions_of_any_size():
    from reachmill.llm.lines import within

    base = ["", "a", "the quick brown fox", "the quick brwn fix", "x" * 300, "x" * 301 + "yz", "x" * 150 + "ab" + "x" * 150]
    left = [a for a in base for _ in base]
    right = [b for _ in base for b in base]
    whole = within(left, right, 2).tolist()
    assert any(whole) and not all(whole)
    for limit in (1, 40, 500, 10_000):
        assert within(left, right, 2, limit).tolist() == whole
    assert within([], [], 2).tolist() == []


@pytest.mark.parametrize("shape", ["<div>", "<div><span>", "<ul><li>", "<b>", "<body><div>", "</p><div></i>"])
def test_pages_as_deep_as_they_are_long_take_linear_time(shape):
    import time

    model = extraction.Model(np.zeros(4093), np.zeros((2, 2)))

    def seconds(n):
        began = time.process_time()
        extraction.marginals(extraction.forest(["<html><head><title>t</title></head>" + shape * n + "text " * 20]), model)
        return time.process_time() - began

    seconds(500)
    assert seconds(16_000) < 8 * max(seconds(4_000), 0.05)


def plain_agenda(vocabulary, symbols, key, dropout):
    """Take the best candidate that is not skipped, again and again."""
    edge = int(dropout * 2.0**64)
    left = [(s, place) for place, s in enumerate(symbols)]
    while True:
        best = None
        for k in range(len(left) - 1):
            piece = int(vocabulary.joined(np.array([left[k][0]]), np.array([left[k + 1][0]]))[0])
            if piece < 0:
                continue
            inner = mix(np.array([(left[k][1] << 32) + piece], dtype=np.uint64))
            if int(mix(np.uint64(key) ^ inner)[0]) < edge:
                continue
            if best is None or vocabulary.rank[piece] < best[0]:
                best = (vocabulary.rank[piece], k, piece)
        if best is None:
            return [s for s, _ in left]
        _, k, piece = best
        left[k : k + 2] = [(piece, left[k][1])]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("long", [pieces._LONG, 3])
def test_pieces_are_those_of_a_plain_agenda(vocabulary, monkeypatch, dropout, long):
    monkeypatch.setattr(pieces, "_LONG", long)
    r = random.Random(3)
    words = ["international", "aaaaaaaaaaaaaaa", "über", "x", "the", "\u2603\u2603", "".join(r.choices("etaoinshr", k=60))] * 3
    codes = [np.frombuffer(("\u2581" + w).encode("utf-32-le"), dtype="<u4") for w in words]
    symbols = [vocabulary.symbols(c).astype(np.int32) for c in codes]
    keys = np.array([r.getrandbits(64) for _ in words], dtype=np.uint64)
    unit = np.repeat(np.arange(len(words)), [len(s) for s in symbols])
    found, own = pieces.merged_units(vocabulary, np.concatenate(symbols), unit, keys, dropout)
    for k, s in enumerate(symbols):
        assert found[own == k].tolist() == plain_agenda(vocabulary, s.tolist(), int(keys[k]), dropout)


def test_the_same_word_is_cut_otherwise_elsewhere_in_a_text(vocabulary):
    (ids,) = pieces.encoded(vocabulary, ["international " * 40], ["7"], 0.3, 0)
    assert pieces.decoded(vocabulary, ids) == "international " * 40
    text = b"".join(vocabulary.pieces[i] + b"|" for i in ids.tolist())
    assert len({w for w in text.replace(b"| ", b"\n").split(b"\n")}) > 4
    # blocks do not matter
    together = pieces.encoded(vocabulary, ["a b c " * 50_000, "international " * 40], ["1", "7"], 0.3, 0)
    assert together[1].tolist() == ids.tolist()


def test_long_units_take_time_by_their_length(vocabulary):
    import time

    r = random.Random(1)
    text = "".join(r.choices("etaoinshrdlu", k=200_000))
    began = time.process_time()
    (ids,) = pieces.encoded(vocabulary, [text], ["1"], 0.1, 0)
    assert time.process_time() - began < 20
    assert pieces.decoded(vocabulary, ids) == text


def test_features_are_those_of_a_plain_loop():
    buckets = 1 << 12

    def named(text, seed=0):
        block = Block([text])
        return int(block.hashes(np.array([0]), np.array([len(text)]), seed=seed)[0])

    def plain(text):
        words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
        found = [named(w) % buckets for w in words]
        for a, b in itertools.pairwise(words):
            found.append(buckets - 1 if a == b else buckets - 2)
            joined = (named(a) * 0x9E3779B97F4A7C15 + named(b)) % 2**64
            found.append(int(mix(np.array([joined], dtype=np.uint64))[0]) % buckets)
        for n in (3, 5):
            found += [named(text[k : k + n], seed=n) % buckets for k in range(len(text) - n + 1)]
        return sorted(found)

    for text in ["", "one", "the the cat sat", "é ü\tx\ny", "to be or not to be"]:
        found = [b for bucket, _ in classifier._features(Block([text]), buckets) for b in bucket.tolist()]
        assert sorted(found) == plain(text)
        counted = [np.frombuffer(c, dtype="<u4").reshape(2, -1) for c in classifier._counts([text], buckets)][0]
        assert np.repeat(counted[0], counted[1]).tolist() == plain(text)
