"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (
    chat,
    decontaminate,
    licenses,
    maxent,
    ordered_minhash,
    packing,
    prefix_trie,
    quality,
    resampling,
    substrings,
    suffixes,
    topk,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


# ---- 1: license scans ----


@query
def op1_license_scan(spark, sf):
    found = licenses.find_notices(_table(spark, sf, "documents", "doc_id", "text"))
    spans = F.col("notices.spans")
    exact = [i for i, n in enumerate(licenses.NOTICES) if n[2] == 0]
    base = F.filter(spans, lambda s: s["notice"].isin(exact))
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda s: s["label"]))), ",")
    firsts = F.transform(base, lambda s: s["first"])
    return found.select(
        "doc_id",
        F.col("notices.n_words").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


# ---- 2: quality rules ----


@query
def op2_quality_rules(spark, sf):
    judged = quality.assess(_table(spark, sf, "documents", "doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "lost_chars", "kept"]
    return judged.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


_WORD = r"[^\x20\x09-\x0D]"
_SPACES = r"[\x20\x09-\x0D]+"
_RULES = rf"""
    not regexp_matches(l, '{_WORD}') or not (
      regexp_matches(l, '\|[^|]*\|[^|]*\||[»›][^»›]*[»›]')
      or (length(l) <= 200 and regexp_matches(l, '{quality.BOILERPLATE}'))
      or regexp_matches(l, '!!.*!!.*!!')
      or (not regexp_matches(l, '[.!?;:,…。！？]') and len(regexp_extract_all(l, '{_WORD}+')) >= {quality.UNPUNCTUATED_FROM})
      or length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) * 20 > length(l))"""

#: Also used for the quality stage of the pipeline; {docs} is a table of documents.
QUALITY_SQL = rf"""
quality_words as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w
  from {{docs}}),
quality_grams as (
  select doc_id, i, word || ' ' || lead(word, 1) over p || ' ' || lead(word, 2) over p || ' '
    || lead(word, 3) over p || ' ' || lead(word, 4) over p as gram
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from quality_words)
  window p as (partition by doc_id order by i)),
quality_starts as (
  select doc_id, i, count(*) over (partition by doc_id, gram) as n from quality_grams where gram is not null),
quality_repeats as (
  select doc_id, count(distinct i + k) as n
  from quality_starts, (select unnest(range(5)) as k) where n > 1 group by doc_id),
quality_lines as (
  select doc_id, t, w, list_filter(string_split(t, chr(10)), lambda l: {_RULES}) as kept_lines,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as ls
  from quality_words),
quality as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
    len(w) < 10 or 100 * coalesce(r.n, 0) > 20 * len(w) as base_failed,
    cast(length(array_to_string(w, ''))
      - length(regexp_replace(array_to_string(kept_lines, chr(10)), '{_SPACES}', '', 'g')) as bigint) as lost_chars,
    array_to_string(kept_lines, chr(10)) as cleaned
  from quality_lines left join quality_repeats r using (doc_id))"""

ORACLES["op2_quality_rules"] = f"""
with {QUALITY_SQL.replace("{docs}", "documents")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars,
  not base_failed and 2 * lost_chars <= word_chars as kept
from quality"""


# ---- 9: URL filters ----

# Verdict, host, path.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query
def op9_url_filter(spark, sf):
    pages = _table(spark, sf, "pages", "page_id", "url")
    judged = urls.judge(pages, urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op9_url_filter"] = f"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(verdict, h, p) as (values {", ".join(str(r) for r in URL_RULES)}),
winners as (
  select host, path, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
  from (select distinct host, path from parts), rules
  where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by host, path)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parts left join winners using (host, path)"""


# ---- 3: chat formatting ----


@query
def op3_role_repair(spark, sf):
    return chat.repair(_table(spark, sf, "conversations", "conv_id", "turn", "role", "text"))


# ---- 4: near-duplicates ----


@query
def op4_order_minhash(spark, sf):
    return ordered_minhash.near_duplicates(_table(spark, sf, "documents", "doc_id", "text"))


# ---- 5: benchmark decontamination ----


@query
def op5_benchmark_leaks(spark, sf):
    found = decontaminate.find_items(
        _table(spark, sf, "documents", "doc_id", "text"), _table(spark, sf, "benchmark", "item_id", "text")
    )
    pairs = found.select("doc_id", F.explode("items").alias("found"))
    return pairs.select("doc_id", F.col("found.item").alias("item_id"), F.col("found.containment").alias("containment"))


#: {docs} stands for a table of documents.
LEAKS_SQL = rf"""
leak_words as (
  select 'd' as kind, doc_id as id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') as w from {{docs}}
  union all
  select 'b', item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') from benchmark),
leak_shingles as (
  select distinct kind, id, array_to_string(list_slice(w, i, i + 4), ' ') as s
  from (select kind, id, w, unnest(range(1, len(w) - 3)) as i from leak_words)),
leaks as (
  select d.id as doc_id, b.id as item_id, count(*) / any_value(n) as containment
  from leak_shingles d
  join (select *, count(*) over (partition by id) as n from leak_shingles where kind = 'b') b using (s)
  where d.kind = 'd' group by d.id, b.id having count(*) >= 0.8 * any_value(n))"""

ORACLES["op5_benchmark_leaks"] = f"""
with {LEAKS_SQL.replace("{docs}", "documents")}
select doc_id, item_id, containment from leaks"""


# ---- 6: language-model scoring ----


@query
def op6_maxent_score(spark, sf):
    return maxent.score_texts(_table(spark, sf, "documents", "doc_id", "text"))


# ---- 7: substring dedup ----


@query
def op7_seed_extend(spark, sf):
    found = substrings.remove_repeats(_table(spark, sf, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("repeats.n_words").alias("n_words"),
        F.col("repeats.n_removed").alias("n_removed"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )


ORACLES["op7_seed_extend"] = rf"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w from documents),
windows as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words)),
removed as (
  select doc_id, list(distinct i + k) as gone
  from (select doc_id, i, min(doc_id) over (partition by s) as m from windows),
    (select unnest(range(13)) as k)
  where m < doc_id group by doc_id),
kept as (
  select doc_id, w, coalesce(gone, []) as gone from words left join removed using (doc_id)),
flat as (
  select doc_id, len(w) as n, len(gone) as r, w, gone from kept),
left_over as (
  select f.doc_id, string_agg(x.word, ' ' order by x.i) as t
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words) x
  join flat f using (doc_id)
  left join (select doc_id, unnest(gone) as i from removed) g on g.doc_id = x.doc_id and g.i = x.i
  where g.i is null group by f.doc_id)
select f.doc_id, cast(n as bigint) as n_words, cast(r as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from flat f left join left_over l on l.doc_id = f.doc_id"""


# ---- 8: packing ----

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def packed(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    pieces = packing.pack(docs, tokenizer or tokenizer_path(), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op8_curve_packing(spark, sf):
    return packed(_table(spark, sf, "documents", "doc_id", "text"))


# ---- 10: suffix-array dedup ----


@query
def op10_interval_expansion(spark, sf):
    found = suffixes.remove_repeats(_table(spark, sf, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("repeats.n_bytes").alias("n_bytes"),
        F.col("repeats.n_removed").alias("n_removed"),
        F.size("repeats.spans").cast("bigint").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )


# Bytes as hexadecimal digits, two for each.
ORACLES["op10_interval_expansion"] = """
with bytes as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as w
  from (select doc_id, h, unnest(range(0, len(h) // 2 - 399)) as i from bytes)),
repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by w) as n from windows) where n > 1),
runs as (
  select doc_id, i, sum(opens) over (partition by doc_id order by i) as run
  from (select doc_id, i, cast(coalesce(i > lag(i) over (partition by doc_id order by i) + 400, true) as integer) as opens
        from repeated)),
spans as (select doc_id, min(i) as a, max(i) + 400 as b from runs group by doc_id, run),
parts as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as after from spans),
removed as (
  select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
    string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' order by a) as head
  from parts join bytes using (doc_id) group by doc_id)
select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when last is null then h else head || substr(h, 2 * last + 1) end)) as kept_sha256
from bytes left join removed using (doc_id)"""


# ---- 12: resampling towards a target ----


@query
def op12_target_resampling(spark, sf):
    ranks = resampling.draw(_table(spark, sf, "documents", "doc_id", "text"), _table(spark, sf, "benchmark", "text"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC-32 of byte lists, from the rule of its table.
_CRC_TABLE = """crc_bits(n, k, x) as (
  select i, 0, i from (select unnest(range(256)) as i)
  union all
  select n, k + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end from crc_bits where k < 8),
crc_table as (select list(x order by n) as t from crc_bits where k = 8)"""


def _crc32_sql(text: str) -> str:
    codes = f"list_transform(range(strlen({text})), lambda i: cast('0x' || substr(hex(encode({text})), 2 * i + 1, 2) as bigint))"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), {step}), 4294967295)"


ORACLES["op12_target_resampling"] = rf"""
with recursive {_CRC_TABLE},
words as (
  select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark)),
counts as (
  select kind, id, word, count(*) as n from (select kind, id, unnest(w) as word from words) group by all),
hashed as (select word, {_crc32_sql("word")} % 10000 as bucket from (select distinct word from counts), crc_table),
buckets as (
  select bucket, coalesce(sum(n) filter (kind = 'd'), 0)::bigint as s, coalesce(sum(n) filter (kind = 'b'), 0)::bigint as t
  from counts join hashed using (word) group by bucket),
totals as (select coalesce(sum(s), 0)::bigint as all_s, coalesce(sum(t), 0)::bigint as all_t from buckets),
gains as (
  select bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::bigint as gain
  from buckets, totals),
weights as (
  select id, floor(sum(n * gain)::bigint / sum(n))::bigint as weight
  from counts join hashed using (word) join gains using (bucket) where kind = 'd' group by id),
noise as (
  select id as doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
    cast('0x' || left(sha256('2024:' || id), 8) as bigint) as h
  from words left join weights using (id) where kind = 'd'),
scores as (
  select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from noise),
ranks as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, 10 * count(*) over () // 100 as wanted
  from scores where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= wanted then rank end as rank
from scores left join ranks using (doc_id)"""


# ---- 11: exact best inner products ----


@query
def op11_block_pruned_topk(spark, sf):
    vectors = _table(spark, sf, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


ORACLES["op11_block_pruned_topk"] = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
  from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scores qualify rank <= 5"""


# ---- 13: conversation prefixes ----


@query
def op13_prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(_table(spark, sf, "conversations", "conv_id", "turn", "role", "text"), every=20)


ORACLES["op13_prefix_trie"] = rf"""
with recursive {_CRC_TABLE},
numbered as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as p
  from conversations where conv_id is not null),
convs as (
  select c, {_crc32_sql("c::varchar")} % 4 as h from (select distinct c from numbered), crc_table),
rebuilt as (
  select c, r, x, row_number() over (partition by c order by own, p) as d
  from (
    select v.c, 0 as own, n.p, n.r, n.x from convs v join numbered n on n.c = v.c - v.c % 20 and n.p < v.h
    union all
    select c, 1, p, r, x from numbered join convs using (c) where p >= h)),
paths as (
  select c, d, x, md5(to_json(list([r, x]) over (partition by c order by d))::varchar) as node from rebuilt
  union all select c, 0, '', '' from convs),
nodes as (
  select node, any_value(d) as d, min(c) as low, count(*) as n, len(regexp_extract_all(any_value(x), '{_WORD}+')) as tokens
  from paths group by node),
above as (
  select distinct a.node, b.node as below, b.d - a.d as down from paths a join paths b on a.c = b.c and a.d <= b.d),
kids as (select node, count(*) filter (down = 1) as kids from above group by node),
sums as (
  select above.node, count(*) filter (kids.kids = 0) as leaves, sum((n - 1) * tokens)::bigint as saved
  from above join nodes on nodes.node = below join kids on kids.node = below group by above.node),
parents as (select above.below as node, low as parent from above join nodes on nodes.node = above.node where down = 1),
ends as (
  select node, string_agg(c::varchar, ',' order by c) as ids
  from paths join (select c, max(d) as d from paths group by c) using (c, d) group by node)
select low as conv_id, d as depth, parent as parent_conv_id, n as n_convs, kids as n_children, leaves as n_leaves,
  saved as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from nodes join kids using (node) join sums using (node) left join parents using (node) left join ends using (node)"""
