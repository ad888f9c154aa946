"""The registered queries in plain SQL, written independently for a second engine."""

from __future__ import annotations

import hashlib

from catalog import params
from parley.functions.models import MODELS as MODEL_TABLE
from parley.functions.stem import rewrites
from parley.functions.topics import TOPIC_KEYWORDS


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


STOP = _quoted(params.STOP_WORDS)
TERMS = _quoted(params.SEARCH_TERMS)
SOME_ID = hashlib.md5(b"2").hexdigest()
SPACE = "[\\s]+"


def _topic_case(key: str, mixed: str) -> str:
    return (
        f"case when {key} < 20 then 'Rare Niche' when ({mixed}) % 23 = 0 then null "
        f"when ({mixed}) % 23 = 1 then 'General / Noise' when ({mixed}) % 23 < 9 then 'Coding & Debugging' "
        f"when ({mixed}) % 23 < 14 then 'Creative Writing' when ({mixed}) % 23 < 18 then 'Math & Logic' "
        f"when ({mixed}) % 23 < 21 then 'Advice & Life' else 'General' end"
    )


def _model_case(key: str) -> str:
    return (
        f"case {key} % 9 when 0 then 'gpt-4o' when 1 then 'gpt-4o-mini' when 2 then 'gpt-4-0314' "
        "when 3 then 'gpt-4' when 4 then 'gpt-3.5-turbo' when 5 then 'gpt-3.5-turbo-0301' "
        "when 6 then 'o1-mini' when 7 then 'gpt-4.1-mini-2025-04-14' else 'unlisted-model' end"
    )


def _family_case(key: str) -> str:
    return (
        f"case {key} % 9 when 0 then 'gpt-4o' when 1 then 'gpt-4o' when 2 then 'gpt-4' "
        "when 3 then 'gpt-4' when 4 then 'gpt-3.5' when 5 then 'gpt-3.5' when 6 then 'o1' "
        "when 7 then 'gpt-4.1' else 'other' end"
    )


HEADERS = f"""
headers as (
  select o_orderkey as key, o_custkey as user_key, md5(cast(o_orderkey as varchar)) as id,
    {_model_case('o_orderkey')} as model, {_family_case('o_orderkey')} as model_family,
    case when o_orderkey % 211 = 0 then null else o_orderdate end as timestamp,
    md5(cast(o_custkey as varchar)) as hashed_ip,
    {_topic_case('o_orderkey', 'o_orderkey + o_custkey')} as topic,
    concat_ws(' ', o_orderpriority, 'order', cast(o_orderkey as varchar), o_orderstatus) as search_text
  from orders)"""

FACT = f"""{HEADERS},
lines as (select l_orderkey as key, count(*) as lines, sum(l_quantity) as quantity
          from lineitem group by l_orderkey),
fact as (
  select h.*, cast(coalesce(lines, 1) * case when h.key % 1000 = 7 then 40 else 1 end as integer) as turn_count,
    cast(coalesce(quantity, 0) * 10 as integer) as token_count
  from headers h left join lines l on l.key = h.key)"""

COUNTRY = f"""{HEADERS},
places as (
  select h.*, n_name as country from headers h left join customer on c_custkey = user_key
  left join nation on n_nationkey = c_nationkey)"""

DOC_FACT = f"""
doc_fact as (
  select doc_id as key, md5(cast(doc_id as varchar)) as id, {_model_case('doc_id')} as model,
    {_family_case('doc_id')} as model_family,
    case when doc_id % 211 = 0 then null
         else timestamp '2024-01-01' + to_minutes(doc_id % 500000) end as timestamp,
    {_topic_case('doc_id', 'doc_id')} as topic, cast(1 + doc_id % 13 as integer) as turn_count,
    text as search_text
  from documents)"""

RAW = r"""
raw as (
  select doc_id, md5(cast(doc_id as varchar)) as conversation_hash,
    case doc_id % 7 when 0 then 'gpt-4o-2024-08-06' when 1 then 'gpt-4-0314' when 2 then 'gpt-3.5-turbo-0613'
      when 3 then 'o1-mini' when 4 then 'unlisted-model' when 5 then 'gpt-4.1-mini-2025-04-14' end as model,
    case when doc_id % 50 = 0 then 'not a time' when doc_id % 50 <> 1 then
      concat('2024-', lpad(cast(1 + doc_id % 12 as varchar), 2, '0'), '-',
             lpad(cast(1 + doc_id % 28 as varchar), 2, '0'), ' ',
             lpad(cast(doc_id % 24 as varchar), 2, '0'), ':15:00') end as timestamp,
    case lang when 'en' then 'English' when 'fr' then 'French' when 'de' then 'German'
      when 'es' then 'Spanish' end as language,
    md5(source) as hashed_ip, upper(lang) as country, cast(null as varchar) as state,
    cast(floor((len(string_split(text, chr(10))) + 1) / 2) as integer) as turn,
    list_transform(string_split(text, chr(10)), lambda line, i: struct_pack(
      role := case when (i - 1) % 2 = 0 then 'user' else 'assistant' end,
      content := case (doc_id + i - 1) % 7
        when 3 then concat('- ', line)
        when 5 then concat('```', chr(10), line, chr(10), '```')
        when 6 then concat('  ', line, ' ', chr(9), ' ValueError: end ')
        else line end)) as conversation
  from documents)"""

FIRST = f"""{RAW},
first_messages as (
  select conversation_hash as id, model, conversation[1].content as text from raw
  where language = 'English' and conversation[1].role = 'user' and conversation[1].content <> '')"""


def _keyword_case(text: str, rules, default: str = "General") -> str:
    arms = " ".join(
        "when "
        + " or ".join("contains(lower({}), '{}')".format(text, k.replace("'", "''")) for k in keys)
        + f" then '{name}'"
        for name, keys in rules.items()
    )
    return f"case {arms} else '{default}' end"


def _lookup(column: str) -> str:
    arms = " ".join(f"when '{name}' then '{{{i}}}'" for i, (name, _, _) in enumerate(MODEL_TABLE))
    chosen = arms.format(*[row[1] if column == "family" else row[2] for row in MODEL_TABLE])
    return f"case model {chosen} {'else ' + chr(39) + 'other' + chr(39) if column == 'family' else ''} end"


CLEAN = f"""{RAW},
texts as (
  select *, list_transform(list_filter(conversation, lambda t: t.role = 'user' and t.content <> ''),
    lambda t: trim(regexp_replace(t.content, '\\s+', ' ', 'g'))) as texts,
    try_cast(timestamp as timestamp) as ts
  from raw where language = 'English'),
clean as (
  select conversation_hash as id, model, cast({_lookup('date')} as date) as model_release_date,
    {_lookup('family')} as model_family, ts as timestamp,
    cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
    cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour,
    hashed_ip, country, state, turn as turn_count,
    cast(trunc(list_sum(list_transform(conversation, lambda t: coalesce(length(t.content), 0))) / 4.0)
      as integer) as token_count,
    {_keyword_case("array_to_string(texts, ' ')", TOPIC_KEYWORDS)} as topic,
    array_to_string(texts, ' ') as search_text, substr(texts[1], 1, 200) as first_turn,
    cast(to_json(conversation) as varchar) as full_content, conversation
  from texts where len(texts) > 0)"""

CLEAN_RESULT = f"""with {CLEAN}
select * exclude (search_text, first_turn, full_content, conversation), md5(search_text) as search_text,
  md5(first_turn) as first_turn, md5(full_content) as full_content from clean"""

TOKENS = f"""
tokens as (
  select doc_id, md5(cast(doc_id as varchar)) as id,
    list_filter(regexp_extract_all(strip_accents(lower(text)), '[a-z]+'),
      lambda t: t not in ({STOP})) as t
  from documents),
stats as (select count(*) as n, avg(len(t)) as mean_length from tokens where len(t) > 0),
postings as (select term, id, len(t) as length, count(*) as tf
  from (select id, t, unnest(t) as term from tokens) group by all)"""

BM25 = f"""{DOC_FACT}, {TOKENS},
freq as (select term, count(*) as df from postings where term in ({TERMS}) group by term),
scores as (
  select id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
      / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))), 9) as score
  from postings join freq using (term), stats group by id)"""


def _stem(word: str) -> str:
    """The stemmer's replacements, one inside the other."""
    inner = word
    for pattern, new in rewrites():
        new = new.replace("$1", "\\1")
        inner = f"regexp_replace({inner}, '{pattern}', '{new}')"
    return f"case when length({word}) < 3 then {word} else {inner} end"


STEMMED_BM25 = BM25.replace(
    "postings as (",
    f"""vocabulary as (
  select term, {_stem("term")} as stem
  from (select distinct unnest(t) as term from tokens union select unnest([{TERMS}]))),
wanted as (select distinct stem from vocabulary where term in ({TERMS})),
spelled as (""",
).replace(
    "freq as (select term, count(*) as df from postings where term in",
    f"""postings as (
  select stem as term, id, length, sum(tf) as tf from spelled join vocabulary using (term) group by all),
freq as (select term, count(*) as df from postings where term in (from wanted) and '' not in""",
)


def _search(where: str, limit: int, bm25: str = "") -> str:
    return f"""with {bm25 or BM25}
select id, model_family, topic, turn_count, round(score, 6) as score, substr(search_text, 1, 200) as snippet
from doc_fact join scores using (id)
where topic <> 'General / Noise' {where}
order by scores.score desc, id limit {limit}"""


ANNOTATIONS = """
annotations as (
  select event_id, event_type,
    case when event_id % 17 <> 0 then concat(' ', event_type, ' c/c++ don''t') end as category,
    case k % 11 when 0 then 'python' when 1 then 'c/c++' when 2 then 'None' when 3 then 'javaSCRIPT'
      when 4 then null when 5 then 'unknown' when 6 then 'SQL' when 7 then 'vba 6a' when 8 then 'null'
      when 9 then 'other' else 'r' end as language,
    case k % 5 when 0 then null when 1 then 'abc' when 2 then 'Unknown'
      else concat(' Error ', k % 40, ': ', event_type) end as error
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)),
normal as (
  select case when category is null then 'Other'
      else concat(upper(substr(event_type, 1, 1)), lower(substr(event_type, 2)), ' C/C++ Don''T') end as category,
    case language when 'python' then 'Python' when 'c/c++' then 'C/C++' when 'None' then 'None'
      when 'javaSCRIPT' then 'Javascript' when 'unknown' then 'Unknown' when 'SQL' then 'Sql'
      when 'vba 6a' then 'Vba 6A' when 'null' then 'Null' when 'other' then 'Other' when 'r' then 'R'
      else 'None' end as language,
    trim(coalesce(error, 'None')) as error
  from annotations),
cats as (select category as value, count(*) as count from normal group by 1 order by 2 desc, 1 limit 15),
langs as (select language as value, count(*) as count from normal
  where language not in ('None', 'Other', 'Unknown', 'Null', 'Nan') group by 1 order by 2 desc, 1 limit 15),
errs as (select error as value, count(*) as count from normal
  where error not in ('None', 'Other', 'Unknown') and length(error) > 3 group by 1 order by 2 desc, 1 limit 15)"""

PROFILE = """
profile as (
  select conv_id as id, count(*) as num_turns, count(*) filter (role = 'user') as user_turns,
    count(*) filter (role = 'assistant') as assistant_turns,
    cast(sum(length(text)) as bigint) as total_chars, count(*) >= 4 as is_multi_turn
  from conversations group by conv_id having count(*) >= 2)"""

BUCKET = (
    "case when contains(model, 'gpt-4o') then 'gpt-4o' when contains(model, 'gpt-3.5-turbo') "
    "then 'gpt-3.5-turbo' when contains(model, 'o1-mini') or contains(model, 'o1-preview') then 'o1' "
    "else 'gpt-4' end"
)


def _first_n(n: int) -> str:
    return f"""{FIRST},
chosen as (select id, bucket as model, text from (
  select *, row_number() over (partition by bucket order by id) as r
  from (select *, {BUCKET} as bucket from first_messages)) where r <= {n})"""


STYLED = rf"""{FIRST},
chosen as (select id, {BUCKET} as model, text from first_messages),
worded as (select *, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') as w from chosen),
styled as (
  select id, model, cast(len(w) as integer) as word_count,
    case when len(w) > 0 then len(list_distinct(w)) / len(w) else 0.0 end as lexical_diversity,
    case when len(w) > 0 then length(text) / len(w) else 0.0 end as avg_word_len,
    cast(contains(text, '```') as integer) as has_code,
    cast(regexp_matches(text, '(?m)^(\s*[-*]|\s*\d+\.) ') as integer) as has_list
  from worded),
means as (select model, avg(word_count) as word_count, avg(lexical_diversity) as lexical_diversity,
  avg(avg_word_len) as avg_word_len, avg(has_code) as has_code, avg(has_list) as has_list
  from styled group by model)"""

CLUSTERED = """
docs as (select doc_id as id, text, source, coalesce(label, -1) as cluster_id
  from documents left join embeddings on vec_id = doc_id)"""


def _keywords(pattern: str, top: int, stop: str = "", text: str = "text") -> str:
    """Words are maximal runs of word characters; the pattern must match a whole run."""
    keep = f"and term not in ({stop})" if stop else ""
    return rf"""{CLUSTERED},
words as (select cluster_id, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{M}}\p{{N}}_]+')) as term
  from docs),
counts as (select cluster_id, term, count(*) as count from words
  where regexp_full_match(term, '{pattern}') {keep} group by all),
vocabulary as (select term from counts group by term order by sum(count) desc, term limit 1000),
keywords as (select * from (
  select cluster_id, term, count,
    cast(row_number() over (partition by cluster_id order by count desc, term) as integer) as position
  from counts where term in (from vocabulary)) where position <= {top})"""


def _grams(source: str, extra: str, text: str = "text", stop: str = "") -> str:
    """Words of two or more word characters and neighbouring pairs, one row each."""
    keep = f" and t not in ({stop})" if stop else ""
    return rf"""
seqs as (select {extra}, list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{M}}\p{{N}}_]+'),
  lambda t: length(t) >= 2{keep}) as w from {source}),
grams as (select {extra}, unnest(list_concat(w, list_transform(list_zip(w[:-2], w[2:]),
  lambda p: concat(p[1], ' ', p[2])))) as term from seqs)"""


MERGED = f"""{CLUSTERED},
sizes as (select cluster_id, count(*) as n from docs group by 1),
merged as (select id, text, case when n >= 45 then cluster_id else -1 end as topic_id
  from docs join sizes using (cluster_id))"""


def _topic_terms(stop: str, min_topics: int) -> str:
    return f"""{MERGED}, {_grams('merged', 'topic_id', stop=stop)},
tf as (select topic_id, term, count(*) as tf from grams group by all),
over_topics as (select term, sum(tf) as f from tf group by term having count(*) >= {min_topics}),
kept as (select topic_id, term, tf, f from tf join over_topics using (term)),
totals as (select topic_id, sum(tf) as size from kept group by 1),
mean as (select floor(avg(size)) as a from totals),
weighted as (select topic_id, term, tf * ln(1 + a / f) as score, score / size as weight
  from kept join totals using (topic_id), mean),
terms as (select * exclude (score) from (select *, cast(row_number() over (partition by topic_id
  order by score desc, term) as integer) as position from weighted) where position <= 10)"""


FENCED = r"""
fenced as (
  select doc_id, source, case doc_id % 3
    when 0 then concat(' Intro ', source, ' ', chr(10), '```python', chr(10), 'x = ', doc_id, chr(10), '```',
      chr(10), 'then', chr(10), '```', chr(10), text, chr(10), '```', chr(10), 'end {"k": ', doc_id,
      ', "s": "v"} and {bad}')
    when 1 then concat('```', chr(10), chr(10), 'y = ', doc_id, chr(10), chr(10),
      '``` {"a": {"b": 1}} {"c": [1, 2]} ', text)
    else concat(text, chr(10), '{}') end as text
  from documents)"""

ANSWERS = """
answers as (
  select event_id, event_type, case event_id % 6
    when 0 then concat(' ```json', chr(10), cat, '", "err": "None"}', chr(10), '``` ')
    when 1 then concat(cat, '", "err": null}')
    when 2 then concat(cat, '"}')
    when 3 then concat('[', cat, '"}]')
    when 4 then concat(cat, '", "err": ')
    else '{}' end as answer
  from (select *, concat('{"cat": "', event_type, '", "lang": "L', event_id % 10) as cat from events))"""


def _any(text: str, words) -> str:
    return " or ".join("contains({}, '{}')".format(text, w.replace("'", "''")) for w in words)


def _rules_case(text: str, rules, default: str) -> str:
    return "case " + " ".join(
        f"when {_any(text, words)} then '{name}'" for name, words in rules.items()
    ) + f" else '{default}' end"


KEYWORD_ANSWERS = f"""with {RAW},
eligible as (
  select conversation[1].content as prompt from raw
  where language = 'English' and conversation[1].role = 'user'
    and length(conversation[1].content) > 5 and length(conversation[1].content) < 10000
    and floor(length(conversation[1].content) / 4) + 120 < 4046),
sorted as (select *, {_rules_case('lower(prompt)', params.ANNOTATION_CATEGORIES, 'Other')} as category,
  {_rules_case('lower(prompt)', params.ANNOTATION_LANGUAGES, 'None')} as spoken,
  regexp_extract(prompt, '\\b[A-Za-z.]*(?:Error|Exception)\\b') as message from eligible)
select substr(prompt, 1, 100) as prompt_preview, category,
  case when category = 'Coding' then spoken else 'None' end as language,
  case when category = 'Coding' and message <> '' then message else 'None' end as error
from sorted"""

ORACLES: dict[str, str] = {
    "topic_stats": f"""with {HEADERS},
kept as (select * from headers where topic <> 'General / Noise')
select topic, count(*) as count,
  cast(count(*) * 100.0::double / (select count(*) from kept) as decimal(5,2)) as percentage
from kept group by topic order by count desc, topic limit 10""",
    "topic_stats_filtered": f"""with {HEADERS},
kept as (select * from headers where topic <> 'General / Noise' and model_family = 'gpt-4o'
  and timestamp >= timestamp '1997-01-01' and timestamp <= timestamp '1999-06-30')
select topic, count(*) as count,
  cast(count(*) * 100.0::double / (select count(*) from kept) as decimal(5,2)) as percentage,
  (select count(*) from kept) as total_conversations
from kept group by topic order by count desc, topic limit 3""",
    "topic_stats_by_model": f"""with {HEADERS},
asked as (select unnest(['gpt-4o', 'o1', 'no-such-model']) as model_family),
counts as (select model_family, topic, count(*) as count from headers
  where topic <> 'General / Noise' group by 1, 2),
ranked as (select *, cast(sum(count) over (partition by model_family) as bigint) as total,
  row_number() over (partition by model_family order by count desc, topic) as r from counts)
select model_family, coalesce(total, 0) as total_conversations, topic, count,
  cast(count * 100.0::double / total as decimal(5,2)) as percentage
from asked left join (from ranked where r <= 3) using (model_family)""",
    "engagement_by_model": f"""with {FACT}
select model_family as group_name, count(*) as total_convos, cast(avg(turn_count) as integer) as avg_turns,
  cast(median(turn_count) as integer) as median_turns, cast(avg(token_count) as integer) as avg_total_tokens,
  cast(sum(token_count) / sum(turn_count) as integer) as avg_tokens_per_turn
from fact where topic <> 'General / Noise' group by 1 having count(*) > 50
order by avg_total_tokens desc, group_name limit 5""",
    "engagement_by_topic": f"""with {FACT}
select topic as group_name, count(*) as total_convos, cast(avg(turn_count) as integer) as avg_turns,
  cast(median(turn_count) as integer) as median_turns, cast(avg(token_count) as integer) as avg_total_tokens,
  cast(sum(token_count) / sum(turn_count) as integer) as avg_tokens_per_turn
from fact where topic <> 'General / Noise' and model_family in ('gpt-4', 'gpt-4o')
group by 1 having count(*) > 50 order by avg_total_tokens desc, group_name limit 10""",
    "trend_month": f"""with {HEADERS}
select cast(date_trunc('month', timestamp) as timestamp) as period, count(*) as count from headers
where topic <> 'General / Noise' group by 1 order by 1""",
    "trend_week": f"""with {HEADERS}
select cast(date_trunc('week', timestamp) as timestamp) as period, count(*) as count from headers
where topic <> 'General / Noise' and model_family = 'gpt-4' group by 1 order by 1""",
    "trend_peak": f"""with {HEADERS}
select cast(date_trunc('month', timestamp) as timestamp) as period, count(*) as count from headers
where topic = 'Coding & Debugging' and timestamp is not null group by 1 order by 2 desc, 1 limit 1""",
    "count_matches": f"""with {HEADERS}
select count(*) as matches from headers where topic = 'Creative Writing' and model_family = 'gpt-3.5'""",
    "filter_builder": f"""with {FACT}
select id, model_family, timestamp, turn_count from fact
where topic = 'Math & Logic' and model_family in ('gpt-4', 'o1') and timestamp >= timestamp '1997-01-01'
  and timestamp <= timestamp '1998-12-31' and turn_count >= 5""",
    "power_users": f"""with {FACT},
kept as (select * from fact where topic <> 'General / Noise'),
fav as (select hashed_ip, topic, row_number() over (partition by hashed_ip order by count(*) desc, topic) as r
  from kept group by 1, 2)
select hashed_ip, count(*) as total_convos, any_value(fav.topic) as favorite_topic,
  cast(avg(turn_count) as integer) as avg_turns
from kept join (from fav where r = 1) fav using (hashed_ip)
group by hashed_ip order by total_convos desc, hashed_ip limit 10""",
    "specialists": f"""with {FACT},
kept as (select * from fact where topic <> 'General / Noise'),
fav as (select hashed_ip, topic, row_number() over (partition by hashed_ip order by count(*) desc, topic) as r
  from kept group by 1, 2)
select hashed_ip, count(*) as total_convos, count(distinct kept.topic) as distinct_topics,
  any_value(fav.topic) as main_interest, round(count(distinct kept.topic) / count(*), 6) as diversity
from kept join (from fav where r = 1) fav using (hashed_ip)
group by hashed_ip having count(*) > 10
order by count(distinct kept.topic) / count(*), total_convos desc, hashed_ip limit 10""",
    "length_outlier": f"""with {FACT},
kept as (select * from fact where topic <> 'General / Noise')
select id, model_family, turn_count as metric_value,
  (select cast(trunc(avg(turn_count)) as integer) from kept) as avg_benchmark, substr(search_text, 1, 100) as snippet
from kept where turn_count > 10.0 * (select avg(turn_count) from kept)
order by turn_count desc, id limit 10""",
    "length_outlier_one_model": f"""with {FACT},
kept as (select * from fact where topic <> 'General / Noise' and model_family = 'gpt-4')
select id, model_family, turn_count as metric_value,
  (select cast(trunc(avg(turn_count)) as integer) from kept) as avg_benchmark, substr(search_text, 1, 100) as snippet
from kept where turn_count > 20.0 * (select avg(turn_count) from kept)
order by turn_count desc, id limit 5""",
    "rare_topic": f"""with {DOC_FACT}
select id, model_family, topic, substr(search_text, 1, 100) as snippet from doc_fact
where topic in (select topic from doc_fact group by topic having count(*) < 50) order by id limit 10""",
    "dataset_summary": f"""with {COUNTRY},
m as (select model_family as name, count(*) as count from places group by 1 order by 2 desc, 1 limit 10),
t as (select topic as name, count(*) as count from places where topic <> 'General / Noise'
  group by 1 order by 2 desc, 1 limit 10),
c as (select country as name, count(*) as count from places where country is not null
  group by 1 order by 2 desc, 1 limit 10)
select count(*) as total_count, min(timestamp) as start_date, max(timestamp) as end_date,
  (select cast(to_json(list(m order by count desc, name)) as varchar) from m) as model_json,
  (select cast(to_json(list(t order by count desc, name)) as varchar) from t) as topic_json,
  (select cast(to_json(list(c order by count desc, name)) as varchar) from c) as country_json
from places""",
    "dist_model": f"""with {HEADERS}
select model_family as name, count(*) as count from headers group by 1 order by 2 desc, 1 limit 10""",
    "dist_topic": f"""with {HEADERS}
select topic as name, count(*) as count from headers where topic <> 'General / Noise'
group by 1 order by 2 desc, 1 limit 10""",
    "dist_country": f"""with {COUNTRY}
select country as name, count(*) as count from places where country is not null
group by 1 order by 2 desc, 1 limit 10""",
    "search_filters": f"""with {DOC_FACT}
select id, model_family, topic, turn_count, 0.0::double as score, substr(search_text, 1, 200) as snippet
from doc_fact where topic = 'Creative Writing' and model_family = 'gpt-4o' and turn_count >= 3
order by timestamp desc nulls last, id limit 10""",
    "search_bm25": _search("", 50),
    "search_bm25_filtered": _search(
        "and topic = 'Coding & Debugging' and model_family = 'gpt-4o' and turn_count >= 2", 20
    ),
    "search_bm25_index": _search("", 50),
    "search_bm25_stemmed": _search("", 50, STEMMED_BM25),
    "search_stems": _search("", 50, STEMMED_BM25),
    "count_bm25_stemmed": f"""with {STEMMED_BM25}
select count(*) as matches from doc_fact
where topic <> 'General / Noise' and model_family = 'gpt-4o' and id in (select id from scores)""",
    "count_bm25": f"""with {BM25}
select count(*) as matches from doc_fact
where topic <> 'General / Noise' and model_family = 'gpt-4o' and id in (select id from scores)""",
    "tokenize": f"""with {TOKENS}
select doc_id, cast(len(t) as integer) as n_tokens, md5(array_to_string(t, ' ')) as digest from tokens""",
    "build_index": f"with {TOKENS} select term, id, cast(length as integer) as length, tf from postings",
    "index_terms": f"""with {TOKENS}
select term, count(*) as doc_freq from postings group by term""",
    "index_stats": f"""with {TOKENS}
select n as n_docs, round(mean_length, 6) as mean_length from stats""",
    "clean_records": CLEAN_RESULT,
    "stream_ingest": CLEAN_RESULT,
    "fact_written": CLEAN_RESULT,
    "stream_once": CLEAN_RESULT,
    "fact_interleaved": f"""with {DOC_FACT}
select topic, model_family, count(*) as n, min(timestamp) as first, max(timestamp) as last
from doc_fact group by topic, model_family""",
    "distinct_users": f"""with {FACT}
select topic, count(distinct hashed_ip) as n_users, true as within from fact group by topic""",
    "pca": """select cast(c as integer) as component, n, 0.0 as mean, true as ordered, true as uncorrelated
from (select count(*) as n from embeddings), (select unnest(range(5)) as c)""",
    "kmeans": "select vec_id, true as nearest, true as known from embeddings",
    "topic_info_csv": f"""with {CLUSTERED}
select cast(cluster_id as integer) as topic_id, count(*) as count, concat('a "b", ', min(source)) as name
from docs group by cluster_id""",
    "model_docs": """select substr(md5(cast(doc_id as varchar)), 1, 8) as short, md5(replace(text, chr(10), ' ')) as digest
from documents where length(text) > 10""",
    "resume_skip": f"""with {DOC_FACT}
select id, model_family, topic from doc_fact where key not in (select doc_id from labels)""",
    "clean_whitespace": r"""select doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) as digest from documents""",
    "model_family": f"""with {HEADERS}
select model, {_lookup('family')} as model_family, cast({_lookup('date')} as date) as model_release_date,
  count(*) as count from headers group by all""",
    "topic_keywords": f"""select doc_id, {_keyword_case('text', TOPIC_KEYWORDS)} as topic,
  {_keyword_case('text', params.CORPUS_RULES)} as corpus_topic from documents""",
    "conversation_by_id": f"""with {CLEAN}
select id, md5(full_content) as digest from clean where id = '{SOME_ID}'""",
    "conversation_content": f"""with {CLEAN},
one as (select * from clean where id = '{SOME_ID}')
select id, model, topic, cast(len(conversation) as integer) as message_count, md5(search_text) as digest,
  cast(position - 1 as integer) as position, conversation[position].role as role,
  conversation[position].content as content
from (select *, unnest(range(1, len(conversation) + 1)) as position from one)""",
    "top_categories": f"with {ANNOTATIONS} select * from cats",
    "top_languages": f"with {ANNOTATIONS} select * from langs",
    "top_errors": f"with {ANNOTATIONS} select * from errs",
    "freq_report": f"""with {ANNOTATIONS}
select section, cast(row_number() over (partition by section order by count desc, value) as integer) as position,
  value, count
from (select 'Top Categories' as section, * from cats union all select 'Top Languages', * from langs
      union all select 'Top Errors', * from errs)""",
    "title_case": r"""select doc_id, md5(array_to_string(list_transform(
  regexp_extract_all(text, '\p{L}+|[^\p{L}]+'),
  lambda r: concat(case when r[1] = 'ß' then 'Ss' else upper(r[1]) end, lower(substr(r, 2)))), '')) as digest
from documents""",
    "length_profile": f"with {PROFILE} select * from profile",
    "length_profile_nested": f"""with {RAW}
select conversation_hash as id, len(conversation) as num_turns,
  len(list_filter(conversation, lambda t: t.role = 'user')) as user_turns,
  len(list_filter(conversation, lambda t: t.role = 'assistant')) as assistant_turns,
  cast(list_sum(list_transform(conversation, lambda t: length(t.content))) as bigint) as total_chars,
  len(conversation) >= 4 as is_multi_turn
from raw where len(conversation) >= 2""",
    "length_describe": f"""with {PROFILE},
long as (unpivot (select num_turns, user_turns, assistant_turns, total_chars from profile)
  on num_turns, user_turns, assistant_turns, total_chars into name metric value v)
select metric, count(*) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, min(v) as min,
  round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.75), 6) as p75,
  round(quantile_cont(v, 0.9), 6) as p90, round(quantile_cont(v, 0.95), 6) as p95, max(v) as max
from long group by metric""",
    "avg_words_by_topic": r"""select source as topic_name,
  round(avg(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))), 6) as avg_words
from documents group by 1
order by avg(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))) desc, 1 limit 10""",
    "model_bucket": f"""with {HEADERS}
select model, {BUCKET} as bucket, count(*) as count from headers group by all""",
    "stratified_first_n": f"""with {_first_n(100)} select id, model, md5(text) as digest from chosen""",
    "style_features": f"""with {STYLED}
select * replace (round(lexical_diversity, 6) as lexical_diversity, round(avg_word_len, 6) as avg_word_len)
from styled""",
    "style_by_model": f"""with {STYLED}
select model, round(word_count, 6) as word_count, round(lexical_diversity, 6) as lexical_diversity,
  round(avg_word_len, 6) as avg_word_len, round(has_code, 6) as has_code, round(has_list, 6) as has_list
from means""",
    "style_extremes": f"""with {STYLED}
select (select model from means order by word_count desc, model limit 1) as longest_model,
  (select round(max(word_count), 6) from means) as longest_words,
  (select model from means order by has_code desc, model limit 1) as coder_model,
  (select round(max(has_code) * 100, 6) from means) as coder_percent,
  (select model from means order by lexical_diversity, model limit 1) as repetitive_model""",
    "normalize_vectors": """select vec_id, cast(i - 1 as integer) as position,
  round(cast(embedding[i] as double) / norm, 6) as value
from (select *, sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * cast(x as double)))) as norm,
  unnest(range(1, len(embedding) + 1)) as i from embeddings)""",
    "cluster_samples": f"""with {CLUSTERED}
select cluster_id, cast(r - 1 as integer) as position, md5(text) as digest
from (select *, row_number() over (partition by cluster_id order by id) as r from docs) where r <= 3""",
    "cluster_keywords": f"with {_keywords('[a-z]{3,}', 15, STOP)} select * from keywords",
    "cluster_keywords_whole_words": f"with {_keywords('..+', 3)} select * from keywords",
    "long_prompts": rf"""with {FIRST}
select model, count(*) as count from first_messages
where len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) > 3 group by model""",
    "cluster_keywords_chat": f"""with {_keywords(
        '[a-z]{3,}', 15,
        STOP + ", 'please', 'help', 'write', 'create', 'make', 'chatgpt', 'openai', 'code'",
        text="concat('Please HELP me write code: ', text)")} select * from keywords""",
    "cluster_labels": f"""with {_keywords('[a-z]{3,}', 15)},
lists as (select cluster_id, list(term order by position) as k from keywords group by 1)
select cluster_id, case when list_has_any(k, ['eaux', 'aux']) then 'French-like'
    when list_has_any(k, ['ing', 'est']) then 'English-like'
    when list_has_any(k, ['class', 'div', 'span']) then 'Web Development (HTML/CSS)'
    else concat_ws('_', k[1], k[2]) end as label,
  array_to_string(list_transform(k[1:3], lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), '_') as keyword_label
from lists""",
    "clean_label": r"""select doc_id, md5(trim(replace(regexp_replace(
  string_split(trim(concat(' "Label: ', text, '''', chr(10), 'Because it is so.'), ' ' || chr(10) || chr(9) || chr(13)),
  chr(10))[1], '["'']', '', 'g'), 'Label:', ''), ' ' || chr(10) || chr(9) || chr(13))) as digest from documents""",
    "ngram_counts": f"""with {_grams('documents', 'doc_id', stop=STOP)}
select term, cast(sum(c) as bigint) as count, count(*) as doc_freq
from (select doc_id, term, count(*) as c from grams group by all) group by term having count(*) >= 10""",
    "ctfidf": f"""with {_topic_terms(STOP, 2)}
select topic_id, term, round(weight, 6) as weight, position from terms""",
    "topic_info": f"""with {_topic_terms('', 1)}
select topic_id, count(*) as count, any_value(name) as name
from merged join (select topic_id, concat(topic_id, '_', string_agg(term, '_' order by position)) as name
  from terms where position <= 4 group by 1) using (topic_id)
group by topic_id""",
    "dedup_keep_last": """select user_id, event_id, event_type, value
from events qualify row_number() over (partition by user_id order by event_id desc) = 1""",
    "topic_updates": f"""with {CLUSTERED}
select source as id, case when cluster_id in (select label from embeddings)
  then concat('Topic ', cluster_id) else 'General' end as new_topic
from docs qualify row_number() over (partition by source order by id desc) = 1""",
    "apply_topics": f"""with {DOC_FACT}
select id, case quality when 1 then 'Good' when 0 then 'Poor' else topic end as topic
from doc_fact left join labels on doc_id = key""",
    "sample_fixed": f"""with {HEADERS}
select id, topic from headers order by md5('42:' || id), id limit 100""",
    "extract_code": f"""with {FENCED}
select doc_id, md5(case when doc_id % 3 = 2 then regexp_replace(text, '^\\n|\\n$', '', 'g')
  else array_to_string(regexp_extract_all(text, '(?s)```(?:python)?\\n*(.*?)\\n*```', 1), chr(10) || chr(10)) end)
  as digest from fenced""",
    "text_before_code": f"""with {FENCED}
select doc_id, case when contains(text, '```') then trim(split_part(text, '```', 1), ' ' || chr(10)) else '' end
  as intro from fenced""",
    "extract_json": f"""with {FENCED}
select doc_id, array_to_string(list_filter(regexp_extract_all(text, '(?s)\\{{.*?\\}}'),
  lambda j: json_valid(j)), '|') as objects from fenced""",
    "trim_middle": """with t as (select doc_id, case when length(text) > 5100 then concat(substr(text, 1, 2500),
  chr(10), ' ... [', length(text) - 5000, ' characters truncated] ... ', chr(10), right(text, 2500))
  else text end as t from documents)
select doc_id, cast(length(t) as integer) as n, md5(t) as digest from t""",
    "parse_annotation": """select event_id,
  case event_id % 6 when 3 then 'Error' when 4 then 'Error' when 5 then 'Other' else event_type end as category,
  case event_id % 6 when 3 then 'None' when 4 then 'None' when 5 then 'None'
    else concat('L', event_id % 10) end as language,
  case event_id % 6 when 1 then null else 'None' end as error
from events""",
    "annotate_prompts": KEYWORD_ANSWERS,
    "annotations_csv": KEYWORD_ANSWERS,
    "profile_json_folder": """select min(event_id) as first_id, arg_min(event_type, event_id) as first_type,
  count(*) as num_items, 'event_id, event_type, user_id' as keys
from events group by event_id // 2000""",
    "profile_json": """select event_type, count(*) as num_items,
  array_to_string(json_keys(arg_min(props, event_id)), ', ') as keys, arg_min(props, event_id) as first_item
from events group by 1""",
    "json_records": f"""with {HEADERS}
select concat('{{"id":"', id, '","topic":', case when topic is null then 'null' else concat('"', topic, '"') end,
  ',"timestamp":', case when timestamp is null then 'null' else
    concat('"', strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%g'), '"') end, '}}') as record
from headers""",
    "guarded_sql": f"""with {DOC_FACT}
select topic, model_family, count(*) as n, max(turn_count) as longest from doc_fact
where search_text like '%ing%' and topic <> 'General / Noise' and turn_count > 3
group by 1, 2 order by n desc, topic, model_family limit 20""",
}

ORACLES["conversation_by_id_written"] = ORACLES["conversation_by_id"]

_APART = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_LOT = "cast('0x' || left(md5({text}), 8) as bigint)"
# Starts are drawn one after the other, then batches follow each other; both are recursions.
ORACLES["minibatch_kmeans"] = f"""
with recursive dealt as (
  select i, v, lot % batches as batch, batches
  from (
    select vec_id as i, list_transform(embedding, lambda x: cast(x as double)) as v,
      {_LOT.format(text="'42:' || vec_id")} as lot, greatest(1, cast(ceil(count(*) over () / 256) as bigint)) as batches
    from embeddings)),
starts as (
  select 0 as j, cast([] as double[][]) as centres
  union all
  select j + 1, list_append(any_value(centres), arg_max(v, (ln((lot + 0.5) / 4294967296) / apart, -i)))
  from (
    select j, centres, i, v, {_LOT.format(text="'42:' || i || ':' || j")} as lot,
      coalesce(list_min(list_transform(centres, lambda c: {_APART.format(a="v", b="c")})), 1) as apart
    from starts, dealt where j < 10 and batch = 0)
  where apart > 0 group by j),
steps as (
  select 0 as t, j as c, centres[j + 1] as v, 0 as seen
  from (select centres, unnest(range(len(centres))) as j from starts where j = (select max(j) from starts))
  union all
  select t + 1, c, case when n = 0 then v else list_transform(list_zip(v, s), lambda z: z[1] + (z[2] - z[1] * n) / (seen + n)) end,
    seen + n
  from (
    select s.t, s.c, any_value(s.v) as v, any_value(s.seen) as seen, count(b.i) as n,
      [{", ".join(f"sum(b.v[{k}])" for k in range(1, 65))}] as s
    from steps s left join (
      select t.t, d.i, d.v, arg_min(t.c, ({_APART.format(a="d.v", b="t.v")}, t.c)) as c
      from steps t join dealt d on d.batch = t.t % d.batches group by t.t, d.i, d.v) b on b.t = s.t and b.c = s.c
    where s.t < 12 group by s.t, s.c))
select d.i as vec_id, arg_min(s.c, ({_APART.format(a="d.v", b="s.v")}, s.c)) as cluster_id
from dealt d, steps s where s.t = 12 group by d.i"""

# Every vector with every other; what cores reach is a recursion.
ORACLES["density_topics"] = """
with recursive vectors as (
  select vec_id as i, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings),
near as (
  select a.i, b.i as j, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 as d
  from vectors a, vectors b where (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 0.06 * 0.06),
cores as (select i from near group by i having count(*) >= 12),
links as (select i, j from near where i in (from cores) and j in (from cores)),
reached as (select i, i as j from cores union select r.i, l.j from reached r join links l on l.i = r.j),
clusters as (select i, min(j) as cluster from reached group by i),
borders as (
  select n.i, arg_min(cluster, (d, n.j)) as cluster
  from near n join clusters c on c.i = n.j where n.i not in (from cores) group by n.i),
members as (from clusters union all from borders),
numbers as (
  select cluster, row_number() over (order by count(*) desc, cluster) - 1 as topic_id from members group by cluster)
select v.i as vec_id, coalesce(topic_id, -1) as topic_id
from vectors v left join members using (i) left join numbers using (cluster)"""

ORACLES["topics_rewritten"] = f"""with {DOC_FACT}
select id, case when toxic = 1 then 'Toxic' when quality = 1 then 'Good' when quality = 0 then 'Poor' else topic end as topic,
  turn_count, md5(search_text) as digest
from doc_fact left join labels on doc_id = key"""

for _name, _same in (
    ("search_blocks", "search_bm25_index"), ("search_blocks_filtered", "search_bm25_filtered"),
    ("search_blocks_stemmed", "search_bm25_stemmed"),
):
    ORACLES[_name] = ORACLES[_same]
ORACLES["block_maxima"] = f"""with {TOKENS}
select term, count(*) as doc_freq,
  round(max(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))), 6) as top
from postings, stats group by term"""

ORACLES["summary_merged"] = ORACLES["dataset_summary"]
ORACLES["summary_row"] = f"""
select total_count, strftime(start_date, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(end_date, '%Y-%m-%d %H:%M:%S') as date_range,
  model_json, topic_json, country_json
from ({ORACLES["dataset_summary"]})"""
ORACLES["stream_totals"] = f"""with {CLEAN}
select d.n as rows, d.n as rows_read, c.n as rows_kept, c.n as written
from (select count(*) as n from documents) d, (select count(*) as n from clean) c"""
