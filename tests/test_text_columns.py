"""Words and terms found in columns of texts are those that the patterns find."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.functions import text_columns
from rankloom.functions.features import extract_skills, extract_skills_nearby
from rankloom.functions.terms import add_joined_words, add_words, count_terms
from rankloom.functions.vocabulary import vocabulary
from rankloom.operators import term_columns

# Words, marks and characters of one to four bytes, one of them (U+A7DC) without a class in older editions of Unicode.
PARTS = [
    "a", "b2", "the", "everything", "everythings", "nevertheless", "Straße", "ÄÖ", "é", "é", "İstanbul", "ΣΑΣ", "数据", "日", "٣٤", "x_y", "_", "²",
    "—", "…", " ", " ", "\t", "\n", " ", "  ", ".", ",", "😀", "𐐷𐐸", "Ƛ", "\u0000", "w" * 40, "python", "java", "javascript", "c++", "C#", "c#0",
    "node.js", "react.js", "power bi", "power", "rest apis", "rest api", "a/b testing", "SQL", "nosql", "js", "r programming", "+", "#", "-",
]


def texts(seed: int, many: int) -> list[str | None]:
    draw = random.Random(seed)
    found = ["".join(draw.choices(PARTS, k=draw.randrange(25))) for _ in range(many)]
    return [None, "", " ", "a", "é", "python", "xpython", "python#", "日", *found, *(" ".join(draw.choices(PARTS, k=30)) for _ in range(many))]


def both(spark, rows, left, right):
    df = spark.createDataFrame(list(enumerate(rows)), "pos long, text string").repartition(3)
    found = df.withColumn("left", left).withColumn("right", right).collect()
    assert len(found) == len(rows)
    return [(r.text, r.left, r.right) for r in found if r.left != r.right or r.left is None]


@pytest.mark.parametrize("stop_words", [(), ("the", "everything", "nevertheless", "b2")])
def test_joined_words_are_the_words_of_the_pattern(spark, stop_words):
    df = spark.createDataFrame(list(enumerate(texts(1, 300))), "pos long, text string").repartition(3)
    joined = {r.pos: r.words for r in add_joined_words(df, stop_words).collect()}
    listed = {r.pos: " ".join(r.words) for r in add_words(df, stop_words).collect()}
    assert joined == listed


def test_texts_with_unsure_characters_are_left_to_the_pattern():
    cut = text_columns._joined(text_columns.Texts(pa.array(["one two", "one Ƛtwo", "one 😀", "Straße 数据 ", ""])), ())
    assert cut.to_pylist() == ["one two", None, None, "Straße 数据", ""]


def test_slices_hold_all_texts(monkeypatch):
    given = pa.array(["one two " * 5, None, "", "three" * 30, "four"])
    monkeypatch.setattr(text_columns, "BYTES_AT_ONCE", 10)
    found = pa.concat_arrays([text_columns._joined(text_columns.Texts(t), ()) for t in text_columns._slices(given)])
    assert found.to_pylist() == [("one two " * 5).strip(), "", "", "three" * 30, "four"]


OTHERS = vocabulary({"x": [".net", "net", "c", "c#", "data", "data science of", "数据", "é b", "it's"]}, {"foo_": "net"})


@pytest.mark.parametrize("vocab", [None, OTHERS])
def test_skills_nearby_are_all_skills(spark, vocab):
    asked = (F.coalesce("text", F.lit("")), *([vocab] if vocab else []))
    more = [".net", "x.net", "..net", "c", "c#", "it’s", "é b", "foo_", "data science of", "data science off", "数据库", " 数据 "] if vocab else []
    rows = texts(2, 300) + [" ".join(random.Random(i).choices(PARTS + more, k=12)) for i in range(200)] + more
    assert not both(spark, rows, extract_skills_nearby(*asked), extract_skills(*asked))


def test_only_what_stands_near_a_term_is_read():
    heads = text_columns._Heads(["python", "power bi"], "_+#.")
    found = text_columns._near(text_columns.Texts(pa.array(["long text " * 50 + "python" + " and more" * 50, "nothing", ""])), heads).to_pylist()
    assert "python" in found[0] and len(found[0]) < 40 and found[1:] == ["", ""]


def counted(words: list[str | None], key: int = 0) -> list:
    terms = term_columns._Terms(pa.RecordBatch.from_pydict({"words": pa.array(words, pa.string())}), key, named=True)
    name = dict(zip(terms.numbers[1:].tolist(), terms.words.to_pylist()))
    pairs = zip(terms.row_of, terms.numbers[terms.first], terms.numbers[terms.last], terms.tf)
    return sorted((int(r), " ".join(([name[f]] if f else []) + [name[x]]), int(tf)) for r, f, x, tf in pairs)


def test_terms_of_joined_words_are_those_counted_from_texts(spark):
    rows = ["one two one two", "", None, "two", "internationalisation of internationalisations", "of " * 3 + "数据 " + "x" * 100 + " " + "x" * 101]
    rows = [r and r.strip() for r in rows]
    df = count_terms(spark.createDataFrame(list(enumerate(rows)), "pos long, words string").coalesce(1))
    assert counted(rows) == sorted((r.pos, t, c) for r in df.collect() for t, c in zip(r.terms, r.counts))
    assert counted(rows, 1) == counted(rows) and counted([]) == counted([None, ""]) == []


def test_words_that_share_a_number_are_all_named(monkeypatch):
    monkeypatch.setattr(term_columns, "_numbered", lambda data, starts, sizes, key: np.ones(len(starts), np.int64))
    terms = term_columns._Terms(pa.RecordBatch.from_pydict({"words": pa.array(["one two", "one three"])}), 0, named=True)
    assert set(terms.words.to_pylist()) == {"one", "two", "three"} and set(terms.numbers[1:].tolist()) == {1}


def test_numbers_hang_on_the_whole_word_and_the_key():
    words = pa.array(["a", "aa", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "ab", "ba", "abcdefgh1", "abcdefgh2", "1abcdefgh", "", "\0", "\0\0"])
    numbers = term_columns.word_numbers(words, 0)
    assert len(set(numbers.tolist())) == len(words) and (numbers != 0).all()
    assert (numbers != term_columns.word_numbers(words, 1)).all()
    assert (numbers == term_columns.word_numbers(words.cast(pa.large_string()), 0)).all()
