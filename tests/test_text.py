import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.functions import text as X
from rankloom.functions.terms import add_joined_words, add_ngrams, add_term_counts, add_words, chunk_words, count_terms, listed_words


def redacted(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in X.redact_pii(rows).orderBy("i").collect()]


def test_clean_text(column):
    cases = {
        "  a \t b  ": "a b",
        "it’s ‘so’": "it's 'so'",
        "a  b": "a b",
        "a\n \n\t\nb": "a\nb",
        "a\nb": "a\nb",
        "a\n\nb\n\n": "a\nb",
        " \x1f\x85a　": "a",
        "a \n b": "a \n b",
        "": "",
        " \n ": "",
    }
    assert column(X.clean_text, list(cases)) == list(cases.values())


def test_redaction_of_contacts(spark):
    (line,) = redacted(spark, ["Write to jo.doe+x@mail.example.org or call +91 98765 43210, https://site.example/in/jo?x=1 now"])
    assert "@" not in line and "9876" not in line and "site.example" not in line
    assert line.startswith("Write to ") and line.endswith(" now")


def test_phone_needs_ten_to_fifteen_digits(column):
    cases = {
        "2019 - 2022": "2019 - 2022",
        "from 2019 - 2022 (4)": "from 2019 - 2022 (4)",
        "1234567890": " ",
        "123456789": "123456789",
        "(020) 7946-0958 12": " ",
        "1234567890123456": "1234567890123456",
        "a1234567890": "a1234567890",
        "1/1234567890": "1/1234567890",
        "1234567890x": "1234567890x",
        "1234567890, 0987654321": " ,  ",
        "1234567890,0987654321;": " , ;",
        "no number": "no number",
        "": "",
    }
    assert column(X.redact_phone, list(cases)) == list(cases.values())


def test_mail_addresses_may_touch(column):
    cases = {
        "a@b.c+d@e.f": "  ",
        "ümläut@bücher.example!": " !",
        "@b.c": "@b.c",
        "a@b": "a@b",
        "a..b@c-d.e.": " ",
    }
    assert column(X.redact_email, list(cases)) == list(cases.values())


def test_links_run_to_the_next_space(column):
    cases = {"see www.x.example/a,b. c": "see   c", "HTTP://x": "HTTP://x", "http://": "http://", "https://ä b": "  b"}
    assert column(X.redact_url, list(cases)) == list(cases.values())


def test_long_unbroken_text_is_linear(column):
    blob = "x" * 200_000
    assert column(X.redact_email, [blob + "@"]) == [blob + "@"]


def test_preview(column):
    assert column(lambda t: X.text_preview(t, 2, 7), ["ab  c\n\n d e"]) == ["c d"]
    assert column(lambda t: X.text_preview(t, 50, 6), ["short"]) == [""]


def grams_of(spark, text, stop=()):
    df = spark.createDataFrame([(1, text)], "pos long, text string")
    return add_ngrams(df, stop).first()["grams"]


def test_ngrams_skip_stop_words_before_pairing(spark):
    assert grams_of(spark, "The Cat, the x hat_1 déjà!", ["the"]) == [
        "cat", "hat_1", "déjà", "cat hat_1", "hat_1 déjà",
    ]
    assert grams_of(spark, "one") == ["one"]
    assert grams_of(spark, "") == []
    assert grams_of(spark, None) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["aa", "bb", "cc", "d", "éé"]), max_size=30), min_size=1, max_size=8))
def test_term_counts_equal_a_plain_count(spark, word_lists):
    texts = [" ".join(words) for words in word_lists]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    for row in add_term_counts(df, ["bb"]).collect():
        words = [w for w in texts[row.pos].split() if len(w) > 1 and w != "bb"]
        expected = {}
        for gram in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            expected[gram] = expected.get(gram, 0) + 1
        assert dict(zip(row.terms, row.counts)) == expected
        assert len(row.terms) == len(row.counts)


def test_chunks(spark):
    words = [f"w{i}" for i in range(450)]
    texts = [" \n".join(words), "", "  one  ", None, "　".join(words[:200])]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    rows = chunk_words(df).orderBy("pos", "chunk_no").collect()
    assert [(r.pos, r.chunk_no) for r in rows] == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (3, 0), (4, 0)]
    assert rows[0].chunk == " ".join(words[:200]) and rows[2].chunk == " ".join(words[400:])
    assert [r.chunk for r in rows[3:6]] == ["", "one", ""]
    assert rows[6].chunk == " ".join(words[:200])


def test_chunks_of_any_size(spark):
    df = spark.createDataFrame([(0, "a b c d e")], "pos long, text string")
    assert [r.chunk for r in chunk_words(df, size=2).orderBy("chunk_no").collect()] == ["a b", "c d", "e"]


def test_norm_quotes(column):
    assert column(X.norm_quotes, ["‘a’ “b”"]) == ["'a' “b”"]


def test_strip_knows_unicode_space(column):
    assert column(X.strip, ["   a b  \x1c"]) == ["a b"]
    assert column(lambda t: F.length(X.strip(t)), ["​"]) == [1]


def test_default_stop_words():
    from rankloom.functions.terms import default_stop_words

    words = default_stop_words()
    assert len(words) == len(set(words)) == 318 and list(words) == sorted(words)
    assert {"the", "whereafter", "co", "bill"} <= set(words) and "python" not in words


def test_stop_words_from_a_file_are_bounded(spark, tmp_path, monkeypatch):
    from rankloom.functions import terms

    (tmp_path / "words.txt").write_text("The of\nand")
    assert terms.read_stop_words(spark, str(tmp_path / "words.txt")) == ("and", "of", "the")
    monkeypatch.setattr(terms, "MOST_STOP_WORDS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        terms.read_stop_words(spark, str(tmp_path / "words.txt"))


def test_stored_words_are_the_tokens_in_order(spark):
    df = spark.createDataFrame([(1, "The Cat, the x hat_1 déjà!"), (2, None)], "pos long, text string")
    assert {r.pos: r.words for r in add_words(df, ["the"]).collect()} == {1: ["cat", "hat_1", "déjà"], 2: []}


def test_joined_words_are_listed_again():
    """Also from the middle of a batch; an empty text has no words."""
    texts = ["déjà vu", "", None, "cat", "hat_1 cat hat"] * 40
    joined = pa.array(texts)
    for some, of in ((joined, texts), (joined.slice(3, 150), texts[3:153]), (joined.slice(1, 2), texts[1:3])):
        assert listed_words(some).to_pylist() == [(t or "").split() for t in of]
    lists = pa.array([["a b"], []])
    assert listed_words(lists) is lists


def test_joined_words_are_counted_like_lists(spark):
    df = spark.createDataFrame([(1, "The cat. The cat sat"), (2, None), (3, "")], "pos long, text string")
    as_text, as_list = ({r.pos: dict(zip(r.terms, r.counts)) for r in count_terms(add(df, ["the"]).drop("text")).collect()} for add in (add_joined_words, add_words))
    assert as_text == as_list == {1: {"cat": 2, "sat": 1, "cat cat": 1, "cat sat": 1}, 2: {}, 3: {}}
