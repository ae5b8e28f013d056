"""The training text operators against plain Python, with the odd rows of every kind."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reachmill.llm import chat, classifier, exact, extraction, lines, mixing, neardup, pieces, quality, warc
from reachmill.llm.scratch import Scratch
from reachmill.llm.textarrays import Block
from reachmill.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, component string, line string"
LONG = "many words and no end of them " * 4000


def fixture_texts():
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 7)))
    base = [[word() for _ in range(60)] for _ in range(12)]
    found = []
    for b in base:
        for _ in range(6):
            w = list(b)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(60)] = word()
            found.append(" ".join(w[:30]) + "\n" + " ".join(w[30:]))
    found += ["", "  ", "one", "Two words", "two WORDS", "a b c d", LONG, LONG, "short\nshort", None, found[0].upper(), found[0]]
    # lines that differ by a letter or two
    line = "this line stands in many documents, word for word"
    found += [f"{line}\n{i} own words here, {word()} {word()}" for i in range(5)]
    found += [line.replace("many", "mani"), line.replace("word for", "wrd foor"), line.replace("stands in many", "stood in two")]
    return found


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, None, "x", "y", "z") for i, t in enumerate(fixture_texts())]
    rows += [rows[0], rows[3], (None, "a row without id, " * 3, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def roots(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_quality_counts_and_hosts(spark, docs, none):
    def plain(text):
        w = words(text)
        grams = {}
        for i in range(len(w) - 7):
            grams.setdefault(tuple(w[i : i + 8]), []).append(i)
        covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(8)}
        seen = [x for x in (text or "").split("\n") if words(x)]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(seen) - len(set(seen)), len(covered))

    found = quality.with_measures(docs).withColumn("base_failed", quality.base_failed())
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[c] for c in quality.RULES) == plain(r["text"])
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    verdicts = quality.host_verdicts(found, "source")
    assert verdicts.where("host is null").count() == 0
    judged = quality.with_host_verdict(found, verdicts, "source")
    assert judged.count() == docs.count() and judged.where("source is null and host_rejected").count() == 0
    assert quality.host_verdicts(quality.with_measures(none).withColumn("base_failed", F.lit(True)), "source").count() == 0


def test_a_large_bad_host_is_rejected_and_a_small_one_is_not(spark):
    rows = [("bad", True)] * 90 + [("bad", False)] * 10 + [("tiny", True)]
    rows += [(f"good{h}", i == 0) for h in range(20) for i in range(20)]
    verdicts = quality.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean"), "host")
    assert {r["host"] for r in verdicts.where("rejected").collect()} == {"bad"}


def test_line_classes_are_those_of_brute_force(spark, docs, none):
    found = lines.classes(docs, Scratch(spark, "t-lines")).collect()
    kept_lines = [(r["doc_id"], n, x) for r in docs.collect() for n, x in enumerate((r["text"] or "").lower().split("\n")) if r["text"] is not None and len(x) >= 20]
    unique = sorted({x for _, _, x in kept_lines})
    left, right, pairs = [], [], []
    for i, x in enumerate(unique):
        for j in range(i):
            if abs(len(x) - len(unique[j])) <= 2:
                pairs.append((j, i))
                left.append(unique[j])
                right.append(x)
    links = [p for p, near in zip(pairs, lines.within(left, right, 2)) if near]
    root = dict(zip(unique, roots(len(unique), links)))
    first = {}
    for doc, n, x in sorted(kept_lines, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        first.setdefault(root[x], (doc, n))
    expected = sorted((str((doc, n)), str(first[root[x]])) for doc, n, x in kept_lines)
    assert links and expected == sorted((str((r["doc_id"], r["line_no"])), str((r["class_doc_id"], r["class_line_no"]))) for r in found)
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["class_doc_id"], r["class_line_no"])) for r in found)
    assert lines.classes(none, Scratch(spark, "t-lines")).count() == 0
    dropped = spark.createDataFrame([(0, 1), (0, 1), (2, 0)], "doc_id long, line_no int")
    texts = {r["doc_id"]: r["text"] for r in lines.without(docs, dropped).collect()}
    assert texts[0] == fixture_texts()[0].split("\n")[0] and texts[2] == fixture_texts()[2].split("\n")[1]


def test_lines_of_every_length_take_part(spark, none):
    ship(spark)
    texts = ["Menu\na\n\n   \nabcdefghijkl", "menu\nmenus\nabcdefghijkx\nab", "\nMENU\nb\nAB\nabcdefghi", "abcdefghx\nmenu\n\t\na"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in lines.classes(frame, Scratch(spark, "t-short"), min_chars=1).collect()}
    kept_lines = [((doc, n), x) for doc, t in enumerate(texts) for n, x in enumerate(t.lower().split("\n")) if x.strip()]
    near = lambda x, y: x == y or (min(len(x), len(y)) >= 10 and lines._plain(x, y) <= 2)
    assert found == {at: next(first for first, y in kept_lines if near(x, y)) for at, x in kept_lines}
    assert found[1, 0] == found[2, 1] == found[3, 1] == (0, 0) and found[1, 2] == (0, 4) and found[3, 0] == (3, 0)
    # both users of the operator let them in
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, frame.select("*", F.lit(0).cast("long").alias("n_chars")), "").collect()}
    assert left == {0: texts[0], 1: "menus\nab", 2: "\nb\nabcdefghi", 3: "abcdefghx\n\t"}


def test_lines_of_one_template_are_classed_as_by_brute_force(spark):
    """Cells of a wide bucket lie next to each other and go on over batches."""
    ship(spark)
    r = random.Random(6)
    texts = []
    for n in range(400):
        line = f"posted in the forum of the town by {''.join(r.choices('abcdefgh', k=9))} some day"
        texts.append(line if n % 5 else r.choice(texts or [line]).replace("some", "same")[: -1 - n % 2])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "37")
    try:
        found = {r["doc_id"]: r["class_doc_id"] for r in lines.classes(frame, Scratch(spark, "t-template"), min_chars=1).collect()}
    finally:
        spark.conf.set(size, before)
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    near = lines.within([texts[i] for i, _ in pairs], [texts[j] for _, j in pairs], 2)
    expected = roots(len(texts), [pair for pair, close in zip(pairs, near) if close])
    assert len(set(expected)) > 200 and found == dict(enumerate(expected))


def test_marks_keep_the_lines_of_all_wanted_ids_and_few_others(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("id"), F.col("id").cast("string").alias("line"))
    # a hot id stays as often as it is there, in both directions of the sign
    rows = rows.union(rows.where("line < '11'")).union(spark.createDataFrame([(0, "zero"), (-1, None)], "id long, line string"))
    ids = rows.where("pmod(id, 50) = 3 or id in (0, -1)").select("id").distinct()
    left = lines._marked(rows, ids)
    assert left.columns == rows.columns
    wanted = rows.join(ids, "id", "left_semi")
    assert wanted.count() > 400 and wanted.exceptAll(left).count() == 0
    assert left.count() < wanted.count() + 50 and left.exceptAll(rows).count() == 0
    assert lines._marked(rows, ids.limit(0)).count() == 0
    # the texts of other lines are gone before the shuffle
    plan = lines._marked(rows, ids).join(ids.hint("merge"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("_marks") > plan.index("Join Inner") and "LeftSemi" not in plan


def test_near_duplicate_classes_are_those_of_brute_force(spark, docs, none):
    found = {(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.classes(docs, Scratch(spark, "t-near"), n=3, percent=85, bands=20, rows=6).collect()}
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None}, key=lambda r: r[0])
    sets = []
    for _, text in rows:
        w = words(low(text))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    links = [(j, i) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 85 * len(a | b)]
    root = roots(len(rows), links)
    expected = {(d, len(s), rows[t][0], rows[t][0] == d) for (d, _), s, t in zip(rows, sets, root)}
    assert len(links) > 20 and {f for f in found if f[0] is not None} == expected
    assert [f[2:] for f in found if f[0] is None] == [(None, True)]
    assert neardup.classes(none, Scratch(spark, "t-near")).count() == 0


def test_a_group_without_a_common_centre_hangs_together(spark):
    # a chain: neighbours are near, the ends are not, so pivots alone do not join it
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:200 - 3 * i] + [f"x{k}" for k in range(3 * i)])) for i in range(40)]
    rows += [(100 + i, f"other text {i} " + " ".join(f"{i}q{k}" for k in range(30))) for i in range(10)]
    ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["id"]: r["component_id"] for r in neardup.classes(frame, Scratch(spark, "t-chain")).collect()}
    assert {found[i] for i in range(40)} == {0} and all(found[100 + i] == 100 + i for i in range(10))


def test_classifier_tells_held_out_junk_and_scores_every_row(spark, docs, none):
    r = random.Random(0)
    good = [(i, " ".join(r.choices(["river", "stone", "cloud", "field", "house"], k=40)), 1) for i in range(150)]
    junk = [(1000 + i, " ".join(w + "$$" for w in r.choices(["win", "cash", "click"], k=40)), 0) for i in range(50)]
    frame = spark.createDataFrame(good + junk, "doc_id long, text string, quality int")
    model = classifier.fit(frame, frame.where("doc_id % 3 <> 0").select("doc_id", "quality"), "doc_id", "text", "quality", buckets=1 << 12)
    scored = frame.where("doc_id % 3 = 0").withColumn("score", classifier.score(F.col("text"), model)).collect()
    assert all((x["score"] >= 0.3) == (x["quality"] == 1) for x in scored)
    every = docs.withColumn("score", classifier.score(F.col("text"), model)).collect()
    assert len(every) == docs.count() and all(0 <= x["score"] <= 1 for x in every)
    # a plain average of the pulls of every feature, through the softmax of two labels
    for x in every[:40]:
        found = [b for bucket, _ in classifier._features(Block([x["text"] or ""]), len(model.pull)) for b in bucket.tolist()]
        logit = (sum(float(model.pull[b]) for b in found) / len(found) if found else 0.0) + model.bias
        assert x["score"] == pytest.approx(1 / (1 + math.exp(-max(-60, min(60, logit)))), rel=1e-6)
    alone = classifier.fit(frame, frame.limit(0).select("doc_id", "quality"), "doc_id", "text", "quality", buckets=64)
    assert {round(x["score"], 6) for x in docs.withColumn("score", classifier.score(F.col("text"), alone)).collect()} == {0.5}
    assert none.withColumn("score", classifier.score(F.col("text"), alone)).count() == 0


def test_mix_comes_near_its_targets(spark, none):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 60), ("s0" if i % 3 == 0 else f"s{i % 5}") if i % 11 else None) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.n_words(F.col("text")))
    drawn, targets, sizes = mixing.taken(frame, F.array("source"), F.col("size"))
    got = {x["source"]: x["n"] for x in drawn.groupBy("source").agg(F.sum(F.col("size") * F.col("mix_times")).alias("n")).collect()}
    assert drawn.count() == 900 and drawn.agg(F.max("mix_times")).first()[0] <= 3
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s, target in targets.items():
        assert abs(got[s] - target) <= 0.01 * target + 2
    again, _, _ = mixing.taken(frame.repartition(7), F.array("source"), F.col("size"), slices=8)
    assert sorted(map(str, again.select("doc_id", "mix_times").collect())) == sorted(map(str, drawn.select("doc_id", "mix_times").collect()))
    assert mixing.taken(none, F.array("source"), mixing.n_words(F.col("text")))[0].count() == 0
    with pytest.raises(ValueError):
        mixing.taken(frame, F.array("source"), F.col("size"), max_patterns=2)


def test_overlapping_sources_are_mixed_in_spark(spark):
    r = random.Random(4)
    sets = [["a"], ["b"], ["a", "b"], ["b", "a", "b"], [None, "c"], ["c"], ["a", "b", "c"], [None]]
    rows = [(i, r.randint(0, 60), sets[0] if i % 3 == 0 else r.choice(sets), 1, 2, 3) for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, mix_times int, place int, slice int")
    drawn, targets, words = mixing.taken(frame, F.col("sources"), F.col("size"))
    found = drawn.collect()
    assert len(found) == 1200 and drawn.columns == ["doc_id", "size", "sources", "slice", "mix_times"]
    assert words == {s: sum(n for _, n, of, *_ in rows if s in of) for s in ("a", "b", "c", None)}
    assert sum(targets.values()) == pytest.approx(sum(n for _, n, *_ in rows))
    # each pattern gives what the flow says, up to half a document
    supplies = {}
    for _, n, of, *_ in rows:
        supplies[frozenset(of)] = supplies.get(frozenset(of), 0.0) + n
    flow = mixing.cheapest_flow(list(supplies.items()), targets)
    given = dict.fromkeys(supplies, 0)
    for x in found:
        given[frozenset(x["sources"])] += x["size"] * x["mix_times"]
    for (members, _), wanted in zip(supplies.items(), flow, strict=True):
        assert abs(given[members] - wanted) <= 30
    assert max(x["mix_times"] for x in found) <= 3


def test_rows_without_id_are_mixed_one_by_one(spark):
    rows = [(None, f"{k} " * (1 + k % 50), f"s{k % 2}") for k in range(600)] + [(7, "same text", "s0")] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.n_words(F.col("text")))
    drawn, targets, _ = mixing.taken(frame, F.array("source"), F.col("size"), tie=F.xxhash64("text"))
    got = {x["source"]: x["n"] for x in drawn.groupBy("source").agg(F.sum(F.col("size") * F.col("mix_times")).alias("n")).collect()}
    assert all(abs(got[s] - target) <= 100 for s, target in targets.items())
    assert drawn.where("doc_id = 7").select("mix_times").distinct().count() == 1


def test_archives_come_back_with_revisits(spark):
    ship(spark)
    rows = [(5, "u5", "<p>a</p>", "x"), (3, None, "<p>a</p>", "x"), (9, "u\n9", "<p>a</p>", None), (4, "u4", None, "x"), (6, "u6", "", "x"), (None, "n", "<p>a</p>", "x"), (7, "é", LONG, "x"), (3, None, "<p>a</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    scratch = Scratch(spark, "t-warc")
    found = warc.read_archives(scratch.keep(warc.write_archives(pages, f"{scratch.path}/a"), "m")).collect()
    assert len(found) == len(rows)
    assert {(r["page_id"], r["url"], r["payload_bytes"]) for r in found} == {(i, u, len(h or "")) for i, u, h, _ in rows}
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in found}
    assert kinds == {(5, "revisit", 3), (3, "response", None), (9, "revisit", 3), (4, "response", None), (6, "revisit", 4), (None, "response", None), (7, "response", None)}
    assert {bytes(r["payload"]).decode() for r in found if r["page_id"] == 7} == {LONG}
    empty = scratch.keep(warc.write_archives(pages.limit(0), f"{scratch.path}/b"), "n")
    assert warc.read_archives(empty).count() == 0


def test_pieces_decode_to_every_text(spark, docs, none):
    model = pieces.model_bytes()
    found = pieces.encoded_documents(docs, model, keep=["doc_id", "lang"]).collect()
    assert len(found) == docs.count() and all(r["lossless"] for r in found)
    cut = docs.withColumn("ids", pieces.encode(F.col("text"), F.col("doc_id"), model)).withColumn("back", pieces.decode(F.col("ids"), model))
    assert cut.where(~F.col("back").eqNullSafe(F.col("text"))).count() == 0
    assert pieces.encoded_documents(none, model, keep=["doc_id"]).count() == 0


def test_index_takes_each_text_once_over_batches(spark, docs, none):
    scratch = Scratch(spark, "t-index")
    table, path = exact.index_name(scratch.path), f"{scratch.path}/index"
    exact.create_index(spark, table, path, 4)
    batch = exact.digests(docs.where("doc_id is not null"))
    exact.append(scratch, batch, "first", table, path, 4)
    expected = {}
    for r in docs.where("doc_id is not null").collect():
        expected.setdefault(hashlib.sha256(low(r["text"]).encode()).digest(), []).append(r["doc_id"])
    rows = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in spark.table(table).collect()}
    assert rows == {d: (max(ids), len(ids)) for d, ids in expected.items()}
    for large in (1, 1000):
        found = exact.verdicts(batch, scratch.keep(exact.groups_of(spark.table(table)), f"groups-of-{large}"), large=large).collect()
        assert sorted((r["id"], r["keep_id"], r["kept"]) for r in found) == sorted((i, max(ids), i == max(ids)) for ids in expected.values() for i in ids)
    # a repeated batch and an empty one add nothing, a new text is added once
    exact.append(Scratch(spark, "t-index"), batch, "first", table, path, 4)
    exact.append(Scratch(spark, "t-index"), exact.digests(none), "second", table, path, 4)
    new = spark.createDataFrame([(7000, "Never seen"), (7001, "never SEEN"), (7002, "one")], "doc_id long, text string")
    for _ in range(2):
        exact.append(Scratch(spark, "t-index"), exact.digests(new), "third", table, path, 4)
    index = spark.table(table)
    assert index.where("is_new").count() == len(expected) + 1 and index.where("not is_new").count() == 1
    sizes = {r["group_size"] for r in exact.groups_of(index).collect() if r["keep_id"] == 7002}
    assert sizes == {len(expected[hashlib.sha256(b"one").digest()]) + 1}
    plan = spark.table(table).select("digest").hint("merge")._jdf.queryExecution().toString()
    assert "Python" not in plan
    spark.sql(f"drop table {table}")


def test_a_later_batch_counts_towards_known_texts(spark):
    scratch = Scratch(spark, "t-later")
    table, path = exact.index_name(scratch.path), f"{scratch.path}/index"
    exact.create_index(spark, table, path, 4)
    batches = [[(1, "a"), (2, "A"), (3, "b")], [(7, "a"), (8, "c")], [(5, "b")]]
    every = None
    for n, rows in enumerate(batches):
        batch = exact.digests(spark.createDataFrame(rows, "doc_id long, text string"))
        exact.append(scratch, batch, f"b{n}", table, path, 4)
        every = batch if every is None else every.unionByName(batch)
    found = exact.verdicts(every, scratch.keep(exact.groups_of(spark.table(table)), "groups")).collect()
    assert {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in found} == {
        1: (7, 3, False), 2: (7, 3, False), 7: (7, 3, True), 3: (5, 2, False), 5: (5, 2, True), 8: (8, 1, True)
    }
    spark.sql(f"drop table {table}")


def test_main_text_column(spark):
    ship(spark)
    pages = spark.createDataFrame([(1, "<article><p>Hello there, you all.</p></article>"), (2, None)], "page_id long, html string")
    found = {r["page_id"]: r["t"] for r in pages.select("page_id", extraction.main_text(F.col("html"), extraction.default_model()).alias("t")).collect()}
    assert found == {1: "Hello there, you all.", 2: ""}


def test_chat_examples_read_back(spark):
    odd = [r"</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST]", "<<SYS>>x<</SYS>>", "<", "[", "", None, "a\\", "line\nline", "<<s>>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)] + [(2, 0, "user", "only"), (None, 0, "assistant", "x"), (3, None, None, "r"), (3, 1, "a\nb\\n", "q")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, prompt string")
    found = chat.examples(turns)
    read = found.where("is_last").select("conv_id", chat.read_turns(F.concat("prompt", "completion")).alias("turns")).collect()
    expected = {}
    for c, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        expected.setdefault(c, []).append((role or "", text or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in read} == expected
    trained = found.where("trainable").select("conv_id", "example", chat.trained_text(F.col("completion")).alias("t"), F.length("prompt").alias("p"), "prompt_chars", F.length("completion").alias("c"), "completion_chars").collect()
    for c, said in expected.items():
        assert [r["t"] for r in sorted(trained, key=lambda r: r["example"]) if r["conv_id"] == c] == [t for role, t in said if role == "assistant"]
    assert all(r["p"] == r["prompt_chars"] and r["c"] == r["completion_chars"] for r in trained)
    assert chat.examples(turns.limit(0)).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_stage_takes_odd_rows_and_none(spark, docs, none):
    columns = docs.columns
    at = docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = Scratch(spark, "t-stage").keep(stage(spark, at, ""), "out")
        assert stage(spark, none, "").count() == 0
        assert stage(spark, docs, "").count() > 0
        if n < 4:
            assert out.columns == columns
            at = out
    assert out.count() == at.count() and out.where("not lossless").count() == 0
    # what passes the rules and repeats nothing is still there before the mix
    assert {r["doc_id"] for r in at.collect()} <= {r["doc_id"] for r in docs.collect()}


CLASHING = ["_row", "row", "_copy", "_id", "_gone", "mix_times", "place", "doc", "rest", "no", "kept", "rank", "line_no", "base_failed", "n_words", "host_rejected", "component_id", "id", "a.b"]


def test_stages_carry_columns_of_any_name_and_ids_of_any_type(spark, docs):
    odd = docs.select(F.col("doc_id").cast("string").alias("doc_id"), *[docs[c] for c in docs.columns if c != "doc_id"])
    odd = odd.withColumns({c: F.coalesce("doc_id", F.lit("none")) for c in CLASHING})
    plain = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, odd, "")
        assert found.columns == odd.columns, name
        left = found.collect()
        assert left and all(r[c] == (r["doc_id"] or "none") for r in left for c in CLASHING), name
        plain[name] = sorted(map(str, (r["text"] for r in left)))
    # the rules, and which lines and near copies go, do not hang on the type of the ids
    same = sorted(str(r["text"]) for r in corpus_pipeline.quality_rules(spark, docs, "").collect())
    assert plain["quality rules"] == same


def test_near_copies_leave_one_document(spark, docs):
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    classes = {(r["id"], r["component_id"]) for r in neardup.classes(docs, Scratch(spark, "t-one")).collect()}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({c for i, c in classes if i is not None})


def test_rows_that_share_an_id_are_told_apart(spark):
    ship(spark)
    r = random.Random(9)
    text = lambda: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    # id 5 has a copy of id 1 and two texts of its own; ids come in falling order; two rows have none
    rows = [(5, b), (5, a + " more"), (5, c), (1, a), (None, d), (None, d + " more")]
    frame = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], "doc_id long, text string, source string, n_chars long").coalesce(1)
    near = sorted(((x["doc_id"], x["text"]) for x in corpus_pipeline.near_dedup(spark, frame, "").collect()), key=str)
    assert near == sorted([(5, b), (5, c), (1, a), (None, d)], key=str)
    rows = [(5, f"{b}\n{c}"), (5, f"{a}\n{d}"), (1, f"x\n{a}")]
    frame = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], "doc_id long, text string, source string, n_chars long").coalesce(1)
    left = sorted((x["doc_id"], x["text"]) for x in corpus_pipeline.line_dedup(spark, frame, "").collect())
    assert left == sorted([(5, f"{b}\n{c}"), (5, d), (1, f"x\n{a}")])
