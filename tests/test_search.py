import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from parley.functions.stem import porter_stem, stem
from parley.functions.tokens import english_stop_words, query_terms, tokens
from parley.operators import search

STOP = ["the", "a", "of", "and"]
TEXTS = [
    "The relational database and the relations of tables",
    "Conditional relation: a hopping rabbit, hopped and hops",
    "Café crème, CAFE creme! naïve",
    "",
    "the a of",
    "rabbit rabbit rabbit database",
    "Databases relate; rabbits hop. 123 x1y2",
] + ["filler words number %d about tables" % i for i in range(30)]
QUERY = "The hopping rabbits, café database"


def py_tokens(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return [t for t in re.findall("[a-z]+", plain) if t not in STOP]


def brute_force(query, stem=lambda t: t):
    docs = {f"d{i:02d}": [stem(t) for t in py_tokens(t)] for i, t in enumerate(TEXTS)}
    docs = {k: v for k, v in docs.items() if v}
    mean = sum(map(len, docs.values())) / len(docs)
    scores = {}
    for term in {stem(t) for t in py_tokens(query)}:
        df = sum(term in v for v in docs.values())
        for key, words in docs.items():
            tf = words.count(term)
            if tf:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                part = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
                scores[key] = scores.get(key, 0) + part
    return sorted(scores.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(f"d{i:02d}", "gpt-4", "A" if i % 2 else "B", i, None, t) for i, t in enumerate(TEXTS)]
    schema = "id string, model_family string, topic string, turn_count int, timestamp timestamp_ntz, search_text string"
    return spark.createDataFrame(rows, schema)


def check(rows, expected):
    assert [r.id for r in rows] == [k for k, _ in expected]
    assert [r.score for r in rows] == pytest.approx([v for _, v in expected], abs=1e-8)


def test_tokens(one):
    assert one(lambda c: tokens(c, STOP), TEXTS[:7]) == [py_tokens(t) for t in TEXTS[:7]]
    assert query_terms(QUERY, STOP) == sorted(set(py_tokens(QUERY)))


def test_stop_words(spark):
    assert {"the", "you"} <= set(english_stop_words())


def test_scan_matches_brute_force(fact):
    check(search.search(fact, QUERY, limit=100, stop_words=STOP).collect(), brute_force(QUERY))


def test_index_matches_brute_force(spark, fact, tmp_path):
    path = str(tmp_path / "index")
    for _ in range(2):  # the second build replaces the first
        search.write_index(search.build_index(fact, STOP, stems=True), path)
    index = search.read_index(spark, path)
    plain = search.search_index(index, fact, QUERY, limit=100, stop_words=STOP)
    check(plain.collect(), brute_force(QUERY))
    stemmed = search.search_index(index, fact, QUERY, limit=100, stop_words=STOP, stems=True)
    check(stemmed.collect(), brute_force(QUERY, porter_stem))
    lazy = search.build_index(fact, STOP, stems=True)
    check(
        search.search_index(lazy, fact, QUERY, limit=100, stop_words=STOP, stems=True).collect(),
        brute_force(QUERY, porter_stem),
    )
    counted = search.count_index(index, fact, QUERY, stop_words=STOP).first().matches
    assert counted == len(brute_force(QUERY))


def test_filters_apply_after_scoring(fact):
    full = {k: v for k, v in brute_force(QUERY)}
    rows = search.search(fact, QUERY, topic="A", min_turns=2, stop_words=STOP).collect()
    assert rows and all(r.topic == "A" and r.turn_count >= 2 for r in rows)
    assert all(abs(full[r.id] - r.score) < 1e-8 for r in rows)


def test_count_and_empty(fact):
    assert search.count_matches(fact, QUERY, stop_words=STOP).first().matches == len(brute_force(QUERY))
    assert search.search(fact, "the of", stop_words=STOP).count() == 0
    assert search.count_matches(fact, "the of", stop_words=STOP).first().matches == 0
    assert search.count_matches(fact, topic="A").first().matches == len(TEXTS) // 2
    assert search.search(fact, "zzz", stop_words=STOP).count() == 0


def test_search_without_query(fact):
    rows = search.search_conversations(fact, topic="B", min_turns=10, limit=3).collect()
    assert [r.id for r in rows] == ["d10", "d12", "d14"] and rows[0].score == 0.0


PORTER = """caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop falling fall
hissing hiss failing fail filing file happy happi sky sky relational relat conditional condit
rational ration vietnamization vietnam operator oper feudalism feudal decisiveness decis triplicate
triplic formative form hopeful hope goodness good revival reviv allowance allow adoption adopt
probate probat rate rate cease ceas controll control roll roll generalizations gener""".split()


@pytest.mark.parametrize("word, stem", list(zip(PORTER[::2], PORTER[1::2])))
def test_porter(word, stem):
    assert porter_stem(word) == stem


def test_stems_share_a_prefix_with_the_word():
    stems = ["relat", "sens", "abil", "hap", "us", "form", "gener", "electr", "hop", "fl"]
    ends = """s es ed ing ational tional izer abli alli entli eli ousli ization ation ator alism iveness
    fulness ousness aliti iviti biliti icate ative alize iciti ical ful ness ance ement ment ion y ies eed
    ibility ability ally ing ly""".split()
    for word in (s + e for s in stems for e in ends):
        stem = porter_stem(word)
        assert word.startswith(stem[: max(1, len(stem) - 2)]), (word, stem)


def test_stems_of_a_column(spark):
    words = ["caresses", "ponies", "cats", "feed", "agreed", "plastered", "sing", "hopping", "falling", "filing", "happy",
             "sky", "relational", "conditional", "vietnamization", "triplicate", "hopeful", "adoption", "action", "probate",
             "rate", "cease", "controll", "roll", "yy", "y", "yes", "syzygy", "by", "xyyed", "generalizations"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(stem(F.col("w"))).collect()] == [porter_stem(w) for w in words]


def test_stemmed_search_from_the_texts(spark):
    texts = [("a", "A cat sat"), ("b", "cats and cats"), ("c", "category"), ("d", "dog")]
    df = spark.createDataFrame(texts, "id string, search_text string").withColumns(
        {"model_family": F.lit("m"), "topic": F.lit("t"), "turn_count": F.lit(2)}
    )
    assert [r.id for r in search.search(df, "cats", stems=True).collect()] == ["b", "a"]
    assert [r.id for r in search.search(df, "cats").collect()] == ["b"]
    assert search.count_matches(df, "cats", stems=True).first().matches == 2
    twice = df.union(df)
    assert sorted(r.id for r in search.search(twice, "cats", stems=True, limit=9).collect()) == ["a", "a", "b", "b"]


def test_stop_words_follow_the_token_rule(spark):
    df = spark.createDataFrame([("\u00c9t\u00e9 the The ETE word",)], "t string")
    assert df.select(tokens(F.col("t"), ["\u00e9t\u00e9", "The"])).first()[0] == ["word"]
