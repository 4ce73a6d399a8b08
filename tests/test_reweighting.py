import pytest
from pyspark.sql import functions as F

from rankloom.operators import scoring
from rankloom.operators.ordering import rank_rows
from rankloom.plans import reweighting as R
from tests.conftest import plan_of

WEIGHTINGS = [
    None,
    {"skills": 1.0, "tfidf": 0.0, "experience": 0.0, "education": 0.0},
    {"skills": 0.0, "education": 0.9},
    {"tfidf": 0.01, "education": 0.0, "experience": 2.0},
    dict.fromkeys(scoring.COMPONENTS, 0.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    """Two jobs, the second of which asks for neither skills nor education; many ties."""
    i = F.col("pos")
    rows = spark.range(3000).select(F.col("id").alias("pos"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("jd_id"))
    asks = F.col("jd_id") == "a"
    return rows.select(
        "jd_id", "pos", F.concat(F.lit("c"), i).alias("id"), F.lit("x").alias("category"),
        F.when(asks, (i * 7 % 11) / 10.0).alias("skills_score"),
        ((i * 7919 % 3001) / 3000.0).alias("tfidf_score"),
        F.lit(None).cast("double").alias("semantic_score"),
        ((i * 31 % 13) / 12.0).alias("experience_score"),
        F.when(asks, (i % 5) / 4.0).alias("education_score"),
        F.lit(2.0).alias("experience_years"), F.lit("PhD").alias("education"),
        *[F.lit("").alias(c) for c in ("matched_required", "missing_required", "matched_nice", "explanation")],
    )


@pytest.fixture(scope="module")
def store(scored):
    return R.store_components(scored)


def expected(scored, weights):
    final = scoring.with_final_score(scoring.with_weights(scored, weights))
    ranked = rank_rows(final, ["jd_id"], scoring.rank_order()).select(*R.RANKING_COLUMNS)
    return sorted(map(tuple, ranked.collect()), key=lambda r: (r[1], r[0]))


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("weights", WEIGHTINGS, ids=str)
def test_best_under_any_weights_equal_the_full_ranking(scored, store, monkeypatch, weights):
    monkeypatch.setattr(R, "LEAST_DEPTH", 5)
    want = expected(scored, weights)
    for n in (3, 40):
        assert rows(R.top_reweighted(store, n, weights)) == [r for r in want if r[0] <= n]
    assert rows(R.rank_reweighted(store, weights)) == want


def test_lists_are_read_no_deeper_than_needed(store, monkeypatch):
    monkeypatch.setattr(R, "LEAST_DEPTH", 20)
    # One list decides: its head is enough.
    best, depth = R.candidates_met(store, 5, {"tfidf": 1.0} | dict.fromkeys(["skills", "semantic", "experience", "education"], 0.0))
    assert depth == 20 and best.count() == 10
    # Nothing decides but the order among equals: all entries are read.
    assert R.candidates_met(store, 5, dict.fromkeys(scoring.COMPONENTS, 0.0))[1] >= 3000


def test_fewer_candidates_than_asked_for(scored, spark):
    few = R.store_components(scored.where("pos < 3"))
    assert R.top_reweighted(few, 10).count() == 6
    assert R.top_reweighted(R.store_components(scored.limit(0)), 10).count() == 0


def test_a_depth_is_a_filter_on_the_stored_lists(store):
    plan = plan_of(store.lists.where("component = 'tfidf' AND place <= 20"))
    assert "LessThanOrEqual(place,20)" in plan and "PartitionFilters: [isnotnull(component" in plan


def test_a_store_is_opened_again(spark, scored, tmp_path):
    R.store_components(scored.where("pos < 50"), str(tmp_path / "kept"))
    again = R.open_store(spark, str(tmp_path / "kept"))
    assert rows(R.top_reweighted(again, 4)) == [r for r in expected(scored.where("pos < 50"), None) if r[0] <= 4]
