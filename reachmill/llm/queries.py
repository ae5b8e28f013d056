"""The operators of this subpackage as queries over the sample tables, with SQL where SQL
can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reachmill.llm import audit, chat, classifier, codebooks, exact, extraction, lines, mixing, neardup, pieces, quality, simhash, warc
from reachmill.llm.scratch import Scratch
from reachmill.llm.shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = quality.with_measures(docs).drop("text").withColumn("base_failed", quality.base_failed())
    judged = Scratch(spark, "op1").keep(measured, "judged")
    verdicts = quality.host_verdicts(judged, "source")
    joined = quality.with_host_verdict(judged, verdicts, "source")
    kept = ~F.col("base_failed") & ~F.col("host_rejected")
    return joined.select("doc_id", *quality.RULES, "base_failed", kept.alias("kept"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classes(_table(spark, sf_dir, "documents"), Scratch(spark, "op2"), min_chars=1)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "quality")
    model = classifier.fit(docs, labels, "doc_id", "text", "quality")
    scored = docs.select("doc_id", held_out.alias("held_out"), classifier.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    sized = Scratch(spark, "op4").keep(docs, "sized")
    drawn, targets, words = mixing.taken(sized, F.array("source"), F.col("size"))
    rows = [(s, words[s], round(targets[s], 6)) for s in targets]
    known = spark.createDataFrame(rows, "source string, source_size long, target double")
    joined = drawn.alias("d").join(F.broadcast(known).alias("k"), F.col("d.source").eqNullSafe(F.col("k.source")))
    return joined.select("d.doc_id", "d.size", "k.source_size", "k.target", (F.col("d.size") * F.col("d.mix_times")).alias("taken"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op5")
    written = warc.write_archives(_table(spark, sf_dir, "pages"), f"{scratch.path}/archives")
    archives = scratch.keep(written, "manifest")
    return warc.read_archives(archives, payloads=False)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.model_bytes()
    cut = pieces.encoded_documents(_table(spark, sf_dir, "documents"), model, keep=["doc_id"])
    return cut.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", "lossless")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op7")
    batch = scratch.keep(exact.digests(_table(spark, sf_dir, "documents")), "digests")
    table, path, buckets = exact.index_name(scratch.path), f"{scratch.path}/index", int(spark.conf.get("spark.sql.shuffle.partitions"))
    exact.create_index(spark, table, path, buckets)
    # two batches that cover all rows: copies lie within and across them
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for number in range(2):
        exact.append(scratch, batch.where(half == number), f"batch-{number}", table, path, buckets)
    groups = scratch.keep(exact.groups_of(spark.table(table)), "groups")
    # the persistent index of this run is not needed any more
    spark.sql(f"drop table {table}")
    scratch.drop("index", "groups-*")
    found = exact.verdicts(batch, groups)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.select("page_id", "url", extraction.main_text(F.col("html"), extraction.default_model()).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_table(spark, sf_dir, "documents"), Scratch(spark, "op9"), n=3, percent=85, bands=20, rows=6).withColumnRenamed("id", "doc_id")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    rows = chat.examples(turns.unionByName(added))
    trained = F.when(F.col("trainable"), F.struct("example", chat.trained_text(F.col("completion")).alias("text")))
    whole = F.when(F.col("is_last"), F.concat("prompt", "completion"))
    talks = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(trained)).alias("trained"),
        F.max(whole).alias("formatted"),
        F.sum(F.col("prompt_chars") + F.col("completion_chars")).alias("formatted_chars"),
    )
    read = talks.select("conv_id", "formatted_chars", chat.read_turns(F.col("formatted")).alias("turns"), F.array_join(F.col("trained.text"), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    failed = audit.failures(_table(spark, sf_dir, "documents"), Scratch(spark, "op11"), lang)
    labelled = audit.with_labels(failed, _table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return audit.audit(labelled, "ABCDE", {"good_lost": "quality", "toxic_lost": "toxic"})


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_table(spark, sf_dir, "documents"), Scratch(spark, "op12"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op13")
    coded, books = codebooks.compressed(_table(spark, sf_dir, "embeddings"), scratch, "vec_id", "embedding", F.col("label"))
    found = codebooks.with_label_error(scratch.keep(coded, "coded"))
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks.digest(books)).alias("codebooks_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_line_dedup,
        op3_quality_classifier,
        op4_mixing,
        op5_warc,
        op6_sentencepiece,
        op7_exact_dedup,
        op8_main_text,
        op9_near_duplicates,
        op10_chat_format,
        op11_filter_audit,
        op12_simhash,
        op13_vector_codes,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

WORDS = r"""regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"""



def _vector_code_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part compared with every entry in every round."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
dist_{turn} as (
  select x.rid, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) d
  from x join book_{turn} b on x.part = b.part and x.place = b.place group by all
),
near_{turn} as (select rid, part, arg_min(entry, d * {entries} + entry) entry, min(d) d from dist_{turn} group by rid, part)""")
        if turn < rounds:
            steps.append(f"""
mean_{turn} as (
  select x.part, n.entry, x.place, floor(sum(x.v) / count(*))::bigint v
  from x join near_{turn} n on x.rid = n.rid and x.part = n.part group by all
),
book_{turn + 1} as (
  select b.part, b.entry, b.place, coalesce(m.v, b.v) v from book_{turn} b
  left join mean_{turn} m on b.part = m.part and b.entry = m.entry and b.place = m.place
)""")
    return f"""
with kept as (
  select vec_id, label, embedding, row_number() over (order by vec_id) - 1 rid from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
),
flat as (select rid, unnest(range(len(embedding))) pos, len(embedding) // {parts} width, unnest(embedding) e from kept),
x as (select rid, pos // width part, pos % width place, floor(4096 * e::double)::bigint v from flat),
book_0 as (select part, rid entry, place, v from x where rid < {entries}),{",".join(steps)},
coded as (select rid, string_agg(printf('%02x', entry), '' order by part) code, sum(d)::bigint error from near_{rounds} group by rid),
digest as (select sha256(string_agg(v::varchar, ',' order by part, entry, place)) codebooks_sha256 from book_{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256
from coded join kept using (rid), digest"""


ORACLES = {
    "op13_vector_codes": _vector_code_sql(),
    "op11_filter_audit": rf"""
with d as (
  select doc_id, coalesce(lang, '') part, coalesce(text, '') body, {WORDS} w, min(doc_id) over (partition by coalesce(text, '')) first_id from documents
),
l as (select doc_id, max(quality) quality, max(toxic) toxic from labels group by doc_id),
m as (
  select part, len(w) < 200 a, 100 * len(list_distinct(w)) < 50 * len(w) b,
    100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) c, regexp_matches(body, '[#$%&*|]') d,
    coalesce(d.doc_id > first_id, false) e, coalesce(quality = 1, false) good, coalesce(toxic = 1, false) bad
  from d left join l on d.doc_id = l.doc_id
),
g as (select part, a, b, c, d, e, count(*) n, sum(good::int) good, sum(bad::int) bad from m group by all),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) f),
o as (
  select p.f || q.f || r.f || s.f || t.f filter_order from f p, f q, f r, f s, f t
  where len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5
),
ranked as (
  select g.*, filter_order, least(
    case when a then position('A' in filter_order) else 6 end, case when b then position('B' in filter_order) else 6 end,
    case when c then position('C' in filter_order) else 6 end, case when d then position('D' in filter_order) else 6 end,
    case when e then position('E' in filter_order) else 6 end) gone_at
  from g, o
),
steps as (
  select *, filter_order[step] letter,
    case filter_order[step] when 'A' then a when 'B' then b when 'C' then c when 'D' then d else e end fails,
    a::int + b::int + c::int + d::int + e::int n_fails
  from ranked, (select unnest(range(1, 6))::int step)
),
summed as (
  select part, filter_order, step, letter, coalesce(sum(n) filter (gone_at > step), 0)::bigint kept, coalesce(sum(n) filter (gone_at = step), 0)::bigint removed,
    coalesce(sum(n) filter (fails and gone_at < step), 0)::bigint redundant, coalesce(sum(n) filter (fails and n_fails = 1), 0)::bigint unique_fails,
    coalesce(sum(good) filter (gone_at = step), 0)::bigint good_lost, coalesce(sum(bad) filter (gone_at = step), 0)::bigint toxic_lost
  from steps group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint shapley
from summed""",
    "op1_quality_rules": rf"""
with d as (select row_number() over () rid, doc_id, source, coalesce(text, '') text, {WORDS} w from documents),
grams as (
  select rid, i, array_to_string(w[i:i + 7], ' ') g
  from (select rid, w, unnest(range(1, len(w) - 6)) i from d where len(w) >= 8)
),
again as (select rid, i from (select rid, i, count(*) over (partition by rid, g) n from grams) where n >= 2),
covered as (select rid, count(distinct i + k) n from again, range(8) t(k) group by rid),
lines as (select rid, l from (select rid, unnest(string_split(text, chr(10))) l from d) where regexp_matches(l, '[^\x20\x09-\x0D]')),
dups as (select rid, count(*) - count(distinct l) n from lines group by rid),
base as (
  select d.doc_id, d.source, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(dups.n, 0)::bigint n_dup_lines,
    coalesce(covered.n, 0)::bigint n_repeat_words
  from d left join dups using (rid) left join covered using (rid)
),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base),
hosts as (select source host, count(*) n, sum(base_failed::int) f from judged where source is not null group by 1),
m as (select avg(f / n) mean, var_pop(f / n) spread, avg(1 / n) noise from hosts),
room as (select least(greatest(mean, 1e-6), 1 - 1e-6) lvl, spread, noise from m),
strength as (
  select lvl, case when spread - lvl * (1 - lvl) * noise <= 0 then 1000
    else least(greatest(lvl * (1 - lvl) / (spread - lvl * (1 - lvl) * noise) - 1, 2), 1000) end s from room
),
bad as (select host from hosts, strength where (f + lvl * s) / (n + s) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and (source is null or source not in (select host from bad)) as kept
from judged""",
    "op4_mixing": rf"""
with d as (select doc_id, source, len({WORDS})::bigint size, ('0x' || md5('7:' || coalesce(doc_id::varchar, ''))[1:13])::bigint draw from documents),
s as (
  select source, sum(size)::bigint source_size, (row_number() over (order by source is null, encode(source)) - 1) % 3 + 1 w
  from d group by source
),
total as (select sum(source_size)::double t, sum(w)::double ws from s),
filled as (
  select s.*, 3.0 * source_size cap,
    coalesce(sum(3.0 * source_size) over o, 0) cap_before, coalesce(sum(w) over o, 0) w_before
  from s window o as (order by 3.0 * source_size / w, source rows between unbounded preceding and 1 preceding)
),
level as (select first((t - cap_before) / (ws - w_before) order by cap / w, source) lvl from filled, total where (t - cap_before) / (ws - w_before) * w < cap),
goal as (select source, source_size, least(cap, lvl * w)::double target from filled, level),
part as (
  select *, case when source_size = 0 then 0 else floor(target / source_size) end whole,
    case when source_size = 0 then 0 else target - floor(target / source_size) * source_size end rest from goal
),
placed as (
  select d.doc_id, d.size, d.draw, p.*, sum(d.size) over (partition by p.source order by d.draw, d.size rows unbounded preceding) reached
  from d join part p on d.source is not distinct from p.source
),
gaps as (select source, any_value(rest) - coalesce(max(reached) filter (reached <= rest), 0) gap from placed group by source),
closing as (
  select p.source, first(doc_id order by abs(size - gap), draw, reached) doc_id
  from placed p join gaps g on p.source is not distinct from g.source
  where reached > rest and abs(size - gap) < gap and whole < 3 group by p.source
)
select p.doc_id, p.size, p.source_size, round(p.target, 6) target,
  (p.size * (whole + (reached <= rest or c.doc_id is not null)::int))::bigint taken
from placed p left join closing c on p.source is not distinct from c.source and p.doc_id = c.doc_id""",
    "op5_warc": """
with p as (select page_id, url, encode(coalesce(html, '')) body from pages),
d as (
  select *, sha1(body) h, min(page_id) over (partition by sha1(body)) first_id from p
),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || h[i])::int), 4, '0')), '') bits from d)
select page_id, url, octet_length(body) payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_sum(list_transform(range(5), lambda k: bits[i * 5 + k + 1]::int * (1 << (4 - k))))::bigint + 1]), '') payload_digest,
  case when page_id is null or page_id = first_id then 'response' else 'revisit' end record_type,
  case when page_id <> first_id then first_id end refers_to
from b""",
    "op10_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
o as (
  select *, row_number() over w pos, count(*) over (partition by conv_id) n,
    length(role) + 4 head, length(text) + 4 + len(regexp_extract_all(text, '[<\[]\\*(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|unk>|pad>)')) body
  from t window w as (partition by conv_id order by turn nulls first, role, text)
),
r as (select *, sum(head + body) over (partition by conv_id order by pos) upto from o)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) turns_sha256,
  length(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) loss_sha256,
  sum(case when role = 'assistant' or pos = n then upto else 0 end)::bigint formatted_chars
from r group by conv_id""",
    "op7_exact_dedup": """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) text_sha256 from documents),
g as (select text_sha256, max(doc_id) keep_id, count(*) group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)""",
}
