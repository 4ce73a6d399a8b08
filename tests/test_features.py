import pytest
from pyspark.sql import functions as F

from rankloom.functions import features as FE
from rankloom.functions.vocabulary import DEFAULT_VOCABULARY, vocabulary


def test_default_vocabulary():
    assert len(DEFAULT_VOCABULARY.skills) == 100
    assert len(set(DEFAULT_VOCABULARY.category_of.values())) == 8
    assert len(DEFAULT_VOCABULARY.skill_of) == 137
    assert set(DEFAULT_VOCABULARY.skill_of.values()) == set(DEFAULT_VOCABULARY.skills)


def test_skills_aliases_and_boundaries(column):
    cases = {
        "Knows Advanced Excel, powerbi and MYSQL; wrote C++ and c#. Trains with SkLearn, serves with Node.js.": [
            "c#", "c++", "excel", "mysql", "node.js", "power bi", "scikit-learn",
        ],
        "node js": ["javascript", "node.js"],
        "React.js": ["react"],
        "sql.": ["sql"],
        ".sql #sql +sql _sql sql+ sql# sqls": [],
        "c++": ["c++"],
        "c+++": [],
        "Data  analysis": [],
        "data\nanalysis": [],
        "machine learning/deep learning": ["deep learning", "machine learning"],
        "ésql": [],
        "javascript java": ["java", "javascript"],
        "": [],
    }
    assert column(FE.extract_skills, list(cases)) == list(cases.values())


def test_every_spelling_is_found_alone(column):
    spellings = list(DEFAULT_VOCABULARY.skill_of)
    found = column(FE.extract_skills, spellings)
    assert all(DEFAULT_VOCABULARY.skill_of[s] in skills for s, skills in zip(spellings, found))


def test_overlapping_terms_of_an_own_vocabulary(column):
    own = vocabulary({"x": ["red wine", "wine glass", "red", "it's on"]}, {"red wine glass": "wine glass"})
    found = column(lambda t: FE.extract_skills(t, own), ["Red wine glass", "red wines", "It’s on"])
    assert found == [["red", "red wine", "wine glass"], ["red"], ["it's on"]]


def test_stated_years(column):
    cases = {
        "Clerk with 4+ years of hands-on experience": 4,
        "3-5 yrs of sound work experience": 3,
        "7 years' experience": 7,
        "7 years’ experience": 7,
        "7 years‘ experience": 7,
        "120 years of experience": 20,
        "60 years of experience": None,
        "60 years of experience, 2 years experience, 5 YEARS EXPERIENCE": 5,
        "5 years of a b c d experience": 5,
        "5 years of a b c d e experience": None,
        "5 years": None,
        "0 years of experience": 0,
    }
    assert column(FE.explicit_years, list(cases)) == list(cases.values())


def spans(column, texts, year=2026):
    found = column(lambda t: FE.work_spans(t, year), texts)
    return [[(s.s, s.e) for s in row] for row in found]


def test_year_spans(column):
    cases = {
        "X (2019 - 2022)": [(2019, 2022)],
        "2019–2021, 2021 — present": [(2019, 2021), (2021, 2026)],
        "Jan 2019 to Mar 2020": [(2019, 2020)],
        "01/2019 - 03/2020": [(2019, 2020)],
        "2019 -\n2020": [(2019, 2020)],
        "2019 TILL Date": [(2019, 2026)],
        "12019 - 2020": [],
        "2022 - 2019": [],
        "2019 - 2030": [],
        "1950 - 2001": [],
        "2019 2020": [],
        "2019 - 20201": [(2019, 2020)],
    }
    assert spans(column, list(cases)) == list(cases.values())


def test_schooling_nearby_removes_a_span(column):
    far = "x" * 60
    cases = {
        "B.Tech, Some University (2014 - 2018)": [],
        "2014 - 2018 B.E.": [],
        "2014 - 2018 b.e. done": [(2014, 2018)],
        "School\n2014 - 2018": [(2014, 2018)],
        "2014 - 2018\nSchool": [(2014, 2018)],
        f"School {far} 2014 - 2018": [(2014, 2018)],
        f"2014 - 2018 {far} school": [(2014, 2018)],
        "2014 - 2018 " + "x" * 42 + " school": [],
        "2014 - 2018 " + "x" * 43 + " school": [(2014, 2018)],
        "preschool 2014 - 2018": [(2014, 2018)],
        "Master’s 2014 - 2018": [],
    }
    assert spans(column, list(cases)) == list(cases.values())


def test_merged_length(spark):
    cases = [
        ([(2010, 2012), (2012, 2014)], 4), ([(2010, 2015), (2011, 2012)], 5), ([(2015, 2016), (2010, 2011)], 2),
        ([(2010, 2010)], 0), ([], 0), ([(2010, 2013), (2012, 2016), (2020, 2021)], 7),
    ]
    rows = spark.createDataFrame([(c, n) for c, n in cases], "spans array<struct<s:int,e:int>>, n int")
    assert rows.where(FE.merged_length(F.col("spans")) != F.col("n")).count() == 0


def test_experience(column):
    cases = {
        "B.Sc, Town College (2014 - 2018)\nClerk, X (2020 - 2022)\nClerk, Y (2022 - Present)": 6.0,
        "Clerk with 4 years of experience (2000 - 2020)": 4.0,
        "60 years of experience (2018 - 2020)": 2.0,
        "nothing": 0.0,
    }
    assert column(lambda t: FE.experience_years(t, 2026), list(cases)) == list(cases.values())


def test_education(column):
    cases = {
        "Scrum Master, should be fine": [],
        "B.Tech in Drawing": [2],
        "MBA, B.E. Mechanics": [2, 3],
        "Ph.D and diploma": [1, 4],
        "Master of Arts": [3],
        "Masters in Law": [3],
        "master's": [3],
        "master’s": [3],
        "a master": [],
        "b.e. and be": [],
        "undergraduate, post-graduate": [2, 3],
        "Bachelors": [2],
        "ambassador": [],
        "diplomas": [],
        "": [],
    }
    assert column(FE.education_levels, list(cases)) == list(cases.values())
    assert column(FE.education_level, list(cases)) == [max(v, default=0) for v in cases.values()]


def test_education_labels(spark):
    got = spark.range(6).select(FE.education_label(F.col("id").cast("int")).alias("l")).collect()
    assert [r.l for r in got] == ["Not stated", "Diploma", "Bachelor's", "Master's", "PhD", None]


def test_features_of_missing_text(spark):
    row = FE.build_features(spark.createDataFrame([(None,)], "text string"), 2026).first()
    assert (row.skills, row.experience_years, row.education_level) == ([], 0.0, 0)


@pytest.mark.parametrize("name", ["skills", "experience_years", "education_level"])
def test_features_stay_in_the_jvm(spark, name):
    from tests.conftest import plan_of

    plan = plan_of(FE.build_features(spark.range(1).selectExpr("'x' AS text"), 2026).select(name))
    assert "EvalPython" not in plan and "Exchange" not in plan
