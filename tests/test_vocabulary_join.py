import random

import pytest

from rankloom.functions.features import extract_skills
from rankloom.functions.vocabulary import DEFAULT_VOCABULARY, vocabulary
from rankloom.operators import vocabulary_join as V
from tests.conftest import plan_of

OWN = vocabulary({"a": ["Red Wine", "red", "C", "C++", "c#", ".net", "it's", "wine-making", "R&D", "a b a"], "b": ["Wine", "é"]}, {"b a": "red"})
TEXTS = [
    "Red wine, C++ and c#; .NET but not x.net, .net+ or .netx", "it’s wine-making", "C", "c.", ".c", "c++.", "xc", "R&D R&D2", "É éé é",
    "a b a b a", "", None, "   ", "red-wine red\nwine", "wine" * 3, "Wine " * 2000 + "red", "a " * 600 + "b a",
]


def table(spark, vocab):
    return spark.createDataFrame(list(vocab.skill_of.items()), "term string, skill string")


def same(spark, vocab, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    got = {r.pos: r.skills for r in V.skills_by_table(docs, table(spark, vocab)).collect()}
    want = {r.pos: r.s or [] for r in docs.select("pos", extract_skills(docs.text, vocab).alias("s")).collect()}
    assert got == want
    return got


@pytest.mark.parametrize("piece, light", [(512, 500_000), (3, 500_000), (5, 0)])
def test_tables_equal_the_pattern(spark, monkeypatch, piece, light):
    monkeypatch.setattr(V, "PIECE", piece)
    monkeypatch.setattr(V, "LIGHT_TERMS", light)
    got = same(spark, OWN, TEXTS)
    assert got[0] == [".net", "C++", "Red Wine", "Wine", "c#", "red"] and got[9] == ["a b a", "red"] and got[13] == ["Wine", "red"]


def test_default_vocabulary(spark):
    rng = random.Random(2)
    terms = list(DEFAULT_VOCABULARY.skill_of)
    same(spark, DEFAULT_VOCABULARY, [rng.choice([" ", ", ", "/", "."]).join(rng.choice(terms) for _ in range(12)) for _ in range(60)])


def test_a_large_vocabulary_is_joined(spark):
    terms = spark.range(100_000).selectExpr("concat('term', id, if(id % 3 = 0, concat(' and ', id), '')) AS term", "concat('s', id % 1000) AS skill")
    docs = spark.createDataFrame([(1, "Term7, term9 and 9; term12 and 13 term99998"), (2, "nothing")], "pos long, text string")
    out = V.skills_by_table(docs, terms)
    assert {r.pos: r.skills for r in out.collect()} == {1: ["s7", "s9", "s998"], 2: []}
    assert "NestedLoop" not in plan_of(out) and "EvalPython" not in plan_of(out)
    assert V.skills_by_table(docs, terms.limit(0)).where("size(skills) = 0").count() == 2


def test_a_text_is_cut_to_atoms_once(spark):
    documents = spark.createDataFrame([(1, "a b " * 600), (2, ""), (3, None), (4, " ")], "pos long, text string")
    places = V._places(documents, ["pos"], 3)
    assert plan_of(places).split("Initial Plan")[0].count("regexp_extract_all(") == 1
    assert {r.pos: r["count"] for r in places.groupBy("pos").count().collect()} == {1: 1200}
