from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from rankloom.operators import insights, pools
from rankloom.operators.scoring import DEFAULT_WEIGHTS
from rankloom.plans.screening import in_one_pool, rank_candidates, rank_for_jobs, top_candidates, weights_used
from rankloom.operators.jobs import parse_job_descriptions

JOB = "Requirements:\n- Python, SQL and Excel\n- 2+ years of experience\n- Bachelor's degree\nNice to have: Tableau"
PEOPLE = [
    (1, "weak", "Sales executive with CRM and negotiation. 5 years of experience."),
    (2, "strong", "Analyst skilled in Python, SQL and Excel, some Tableau. 3 years of experience. B.Sc done."),
    (3, "middle", "Python. 1 year of experience. Diploma."),
    (4, "copy", "Python. 1 year of experience. Diploma."),
]


def ranked(spark, job=JOB, people=PEOPLE, **options):
    rows = spark.createDataFrame(people, "pos long, id string, text string")
    jobs = spark.createDataFrame([(7, job)], "jd_id long, text string")
    return rank_candidates(in_one_pool(rows, 7), jobs, 2026, stop_words=["the", "and", "in"], **options)


@pytest.fixture(scope="module")
def plain(spark):
    return ranked(spark).cache()


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_best_match_first(plain):
    got = plain.orderBy("rank").collect()
    assert [r.id for r in got][0] == "strong"
    assert [r["rank"] for r in got] == [1, 2, 3, 4]
    assert all(0 <= r.final_score <= 100 + 1e-9 for r in got)


def test_scores_and_explanation(plain):
    rows = by_id(plain)
    strong, middle, weak = rows["strong"], rows["middle"], rows["weak"]
    assert strong.skills_score == 1.0 and strong.experience_score == 1.0 and strong.education_score == 1.0
    assert middle.skills_score == pytest.approx(0.8 / 3) and middle.experience_score == 0.5 and middle.education_score == 0.5
    assert strong.semantic_score is None and strong.contrib_semantic is None
    assert strong.explanation == (
        "Matches 3/3 required skills; 1/1 nice-to-have; experience 3 yrs vs 2 required; education Bachelor's vs Bachelor's required"
    )
    assert weak.explanation == (
        "Matches 0/3 required skills; missing: excel, python, sql; 0/1 nice-to-have; experience 5 yrs vs 2 required; "
        "education Not stated vs Bachelor's required"
    )
    assert (middle.matched_required, middle.missing_required, middle.matched_nice) == ("python", "excel, sql", "")


def test_contributions_add_up_and_weights_renormalize(plain):
    for r in plain.collect():
        parts = [r.contrib_skills, r.contrib_tfidf, r.contrib_experience, r.contrib_education]
        assert sum(parts) == pytest.approx(r.final_score)
    strong = by_id(plain)["strong"]
    share = DEFAULT_WEIGHTS["skills"] / (1 - DEFAULT_WEIGHTS["semantic"])
    assert strong.contrib_skills == pytest.approx(100 * share)


def test_equal_candidates_keep_input_order(plain):
    rows = by_id(plain)
    assert rows["copy"]["rank"] == rows["middle"]["rank"] + 1


def test_own_weights(spark):
    rows = by_id(ranked(spark, weights={"skills": 1.0, "tfidf": 0.0, "experience": 0, "education": -1}))
    assert rows["strong"].final_score == 100.0
    assert rows["strong"].contrib_tfidf is None and rows["strong"].tfidf_score is not None
    nothing = by_id(ranked(spark, weights=dict.fromkeys(DEFAULT_WEIGHTS, 0)))
    assert {r.final_score for r in nothing.values()} == {0.0}


def test_job_that_asks_for_nothing(spark):
    rows = by_id(ranked(spark, job="Join us at the analyst desk"))
    assert rows["strong"].skills_score is None and rows["strong"].experience_score is None
    assert rows["strong"].final_score == pytest.approx(100 * rows["strong"].tfidf_score)
    assert rows["strong"].explanation == ""


def test_only_nice_skills(spark):
    rows = by_id(ranked(spark, job="Analyst\nBonus: Tableau, git"))
    assert rows["strong"].skills_score == 0.5 and rows["weak"].skills_score == 0.0


def test_zero_years_asked(spark):
    people = [(1, "none", "python"), (2, "some", "python, 1 year of experience")]
    rows = by_id(ranked(spark, job="python, 0 years of experience", people=people))
    assert rows["none"].experience_score == 0.0 and rows["some"].experience_score == 1.0


def test_single_candidate_is_clipped_not_scaled(spark):
    (row,) = ranked(spark, people=PEOPLE[1:2]).collect()
    assert 0 < row.tfidf_score < 1 and row["rank"] == 1


def test_vectors(spark):
    chunks = spark.createDataFrame([(7, 1, [1.0, 0.0]), (7, 2, [0.6, 0.8])], "jd_id long, pos long, vector array<float>")
    asked = spark.createDataFrame([(7, [1.0, 0.0])], "jd_id long, vector array<float>")
    rows = by_id(ranked(spark, vectors=chunks, job_vectors=asked))
    assert [rows[i].semantic_score for i in ("weak", "strong", "middle")] == pytest.approx([1.0, 0.6, 0.0])
    assert rows["weak"].contrib_semantic == pytest.approx(20.0)


def test_empty_and_missing_text(spark):
    rows = by_id(ranked(spark, people=[*PEOPLE, (5, "empty", ""), (6, "null", None)]))
    assert rows["empty"].tfidf_score == rows["null"].tfidf_score == 0.0
    assert len(rows) == 6


def test_duplicate_ids_stay(spark):
    got = ranked(spark, people=[*PEOPLE, (9, "weak", "Python")]).collect()
    assert [r.id for r in got].count("weak") == 2


def test_weights_used(spark):
    profiles = parse_job_descriptions(spark.createDataFrame([(7, JOB), (8, "hello")], "jd_id long, text string"))
    rows = {(r.jd_id, r.component): r.weight for r in weights_used(profiles).collect()}
    assert rows[8, "tfidf"] == 1.0 and len(rows) == 5
    assert rows[7, "skills"] == pytest.approx(0.45 / 0.8)


def test_reports(spark, plain):
    result = plain
    assert insights.ranked_table(result).columns[0] == "jd_id"
    gaps = {r.skill: r.missing for r in insights.skill_gap_counts(result, 3).collect()}
    assert gaps["sql"] == 2 and "tableau" not in gaps
    breakdown = insights.score_breakdown(result, 1).collect()
    assert {r.component for r in breakdown} == {"skills", "tfidf", "experience", "education"}
    profiles = parse_job_descriptions(spark.createDataFrame([(7, JOB)], "jd_id long, text string"))
    (summary,) = insights.screening_summary(result, profiles).collect()
    assert (summary.candidates, summary.required_skills, summary.min_years) == (4, 3, 2.0)
    assert [r.id for r in insights.lookup_by_id(result, "strong").collect()] == ["strong"]
    assert insights.top_n(result, 2).count() == 2


def pool_input(spark, n=200):
    return spark.range(n).select(
        F.lit(1).alias("jd_id"),
        (F.col("id") + 1).alias("rank"),
        F.concat(F.lit("c"), "id").alias("id"),
        F.when(F.col("id") % 4 == 0, "A").when(F.col("id") % 4 == 1, "B").alias("category"),
        (1 - F.col("id") / n).alias("skills_score"),
        (F.col("id") / n).alias("tfidf_score"),
    )


def test_a_large_draw_moves_rows_twice(spark):
    ranked = spark.range(40_000).select(
        F.concat(F.lit("j"), F.col("id") % 2).alias("jd_id"), (F.col("id") / 2).cast("int").alias("rank"),
        F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, "B").alias("category"),
        F.rand(1).alias("skills_score"), F.when(F.col("id") % 5 > 0, F.rand(2)).alias("tfidf_score"),
    )
    pool = pools.stratified_pool(ranked, 5000, relevant=["A"])
    assert plan_of(pool).count("Exchange hashpartitioning") <= 2
    rows = pool.collect()
    for job in ("j0", "j1"):
        mine = [r for r in rows if r.jd_id == job]
        assert len({r.id for r in mine}) == len(mine) == 5000
        assert sorted(r.pick for r in mine) == list(range(1, 5001))
        held = Counter(r.stratum for r in mine)
        assert held["top_skill"] == 40 and 0 < held["top_tfidf"] <= 40 and held["relevant"] == 1250 and held["other"] == 750
    assert pools.stratified_pool(ranked.limit(0), 10, relevant=[]).count() == 0


def test_stratified_pool(spark):
    pool = pools.stratified_pool(pool_input(spark), 30, relevant=["A"]).collect()
    assert len(pool) == len({r.id for r in pool}) == 30
    assert sorted(r.pick for r in pool) == list(range(1, 31))
    count = lambda s: sum(r.stratum == s for r in pool)
    assert [count(s) for s in ("top_skill", "top_tfidf", "relevant", "other", "any")] == [9, 9, 8, 4, 0]
    number = lambda r: int(r.id[1:])
    assert all(number(r) < 40 for r in pool if r.stratum == "top_skill")
    assert all(number(r) >= 160 for r in pool if r.stratum == "top_tfidf")
    assert all(number(r) % 4 == 0 for r in pool if r.stratum == "relevant")
    assert all(number(r) % 4 != 0 for r in pool if r.stratum == "other")
    again = pools.stratified_pool(pool_input(spark).repartition(3), 30, relevant=["A"]).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, pool))
    other = pools.stratified_pool(pool_input(spark), 30, seed=1, relevant=["A"]).collect()
    assert {r.id for r in other} != {r.id for r in pool}


def test_short_pools_give_less_and_the_rest_fills_up(spark):
    pool = pools.stratified_pool(pool_input(spark, 50), 40, relevant=["none"]).collect()
    assert len({r.id for r in pool}) == 40
    assert len(pools.stratified_pool(pool_input(spark, 5), 40, relevant=["A"]).collect()) == 5


def test_unlabelled(spark):
    pool = spark.createDataFrame([("1",), ("2",)], "id string")
    labels = spark.createDataFrame([(1, 0)], "id long, label int")
    assert [r.id for r in pools.unlabelled(pool, labels).collect()] == ["2"]


def test_several_jobs_on_one_read_equal_single_rankings(spark):
    people = spark.createDataFrame(
        [(i, str(i), "A", f"python {'sql' * (i % 2)} word{i} 3 years of experience") for i in range(12)],
        "pos long, id string, category string, text string",
    )
    jobs = spark.createDataFrame([("x", "Python and SQL\n2 years of experience"), ("y", "word3 python"), ("z", "excel")], "jd_id string, text string")
    together = rank_for_jobs(people, jobs, 2026)
    got = {}
    for r in together.collect():
        got.setdefault(r.jd_id, []).append(r)
    for name, rows in got.items():
        alone = rank_candidates(in_one_pool(people, name), jobs.where(F.col("jd_id") == name), 2026).collect()
        assert sorted(rows, key=lambda r: r["rank"]) == sorted(alone, key=lambda r: r["rank"])
        best = top_candidates(in_one_pool(people, name), jobs.where(F.col("jd_id") == name), 2026, 4).collect()
        assert sorted(best, key=lambda r: r["rank"]) == sorted(alone, key=lambda r: r["rank"])[:4]
    with pytest.raises(ValueError, match="1 to"):
        rank_for_jobs(people, jobs.limit(0), 2026)


def test_the_best_are_cut_before_the_shuffle(spark):
    people = spark.createDataFrame([(i, str(i), "A", f"python word{i}") for i in range(30)], "pos long, id string, category string, text string")
    jobs = spark.createDataFrame([("x", "python sql")], "jd_id string, text string")
    assert plan_of(top_candidates(in_one_pool(people, "x"), jobs, 2026, 3)).count("WindowGroupLimit") >= 2
