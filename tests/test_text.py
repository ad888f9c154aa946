import re

from pyspark.sql import functions as F

from parley.functions import text as tx


def test_clean_whitespace_as_python(one):
    texts = ["  a \t b\r\nc ", "x y", "a\x1c\x1fb", "   ", "", "plain", "a b"]
    expected = [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert one(tx.clean_whitespace, texts + [None]) == expected + [""]


def test_title_case_as_python(one):
    texts = ["c/c++", "don't", "VBA", "javaSCRIPT", "vba 6a", "  x", "straße ßa", "", "a1b2", "élan VITAL"]
    assert one(tx.title_case, texts + [None]) == [t.title() for t in texts] + [None]


def test_words_as_python(one):
    texts = ["a  b\tc", "", "  ", "x y\x1cz", " lead and trail "]
    assert one(tx.words, texts) == [t.split() for t in texts]


def test_extract_code(one):
    texts = [
        "hi ```python\nx = 1\n``` and ```\ny = 2\n\n``` end",
        "```\n\na\n```",
        "no fence at all",
        "```python\nprint(1)",
        "",
        "a\nb\n",
    ]
    expected = ["x = 1\n\ny = 2", "a", "no fence at all", "print(1)", "", "a\nb"]
    assert one(tx.extract_code, texts) == expected


def test_extract_valid_python_only(one):
    texts = ["```python\nx = 1\n``` ```\nnot python at all\n```", "this is no code", "y = 2"]
    assert one(lambda c: tx.extract_code(c, valid_python_only=True), texts) == ["x = 1", "", "y = 2"]


def test_text_before_code(one):
    texts = [" \n Some text \t\n```x``` more ```y```", "no fence", "```x```"]
    assert one(tx.text_before_code, texts) == ["Some text", "", ""]


def test_json_objects(one):
    texts = ['a {"k": 1} b {bad} {"x": [1, 2]}', '{"a": {"b": 1}}', "none", '{"m":\n 2}{}']
    expected = [['{"k": 1}', '{"x": [1, 2]}'], [], [], ['{"m":\n 2}', "{}"]]
    assert one(tx.json_objects, texts) == expected


def test_trim_middle(one):
    long = "a" * 3000 + "é" * 3000
    cut = long[:2500] + "\n ... [1000 characters truncated] ... \n" + long[-2500:]
    assert one(tx.trim_middle, ["x" * 5100, long, None]) == ["x" * 5100, cut, None]


def test_clean_label(one):
    texts = [' "Label: Web Dev"\nreason', "'Plain'", "Label:", "\n\n Two \n lines"]
    assert one(tx.clean_label, texts) == ["Web Dev", "Plain", "", "Two"]


def test_style_features(spark):
    texts = ["a b a", "x\n- item", "1. first", "one\r- not a list", "```c```", "", "-nospace"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn(
        "w", tx.words(F.col("t"))
    )
    rows = df.orderBy("i").select(
        *[c.alias(n) for n, c in tx.style_features(F.col("t"), F.col("w")).items()]
    ).collect()
    assert rows[0].lexical_diversity == 2 / 3 and rows[0].avg_word_len == 5 / 3
    assert [r.has_list for r in rows] == [0, 1, 1, 0, 0, 0, 0]
    assert [r.has_code for r in rows] == [0, 0, 0, 0, 1, 0, 0]
    assert (rows[5].word_count, rows[5].lexical_diversity, rows[5].avg_word_len) == (0, 0.0, 0.0)
