"""Rank candidates for jobs, end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import build_features, education_label, extract_skills_nearby
from ..functions.terms import add_joined_words, default_stop_words
from ..functions.vocabulary import DEFAULT_VOCABULARY, Vocabulary
from ..operators import scoring
from ..operators.jobs import parse_job_descriptions
from ..operators.ordering import first_rows, rank_rows
from ..operators.similarity import (
    check_pools, cosine_with_job, cosine_with_jobs, minmax, semantic_for_jobs, semantic_similarity,
)
from ..runtime import attach, is_small, materialize, spread

RANKING_COLUMNS = [
    "rank", "jd_id", "id", "category", "final_score",
    *(f"{c}_score" for c in scoring.COMPONENTS),
    *(f"contrib_{c}" for c in scoring.COMPONENTS),
    "experience_years", "education", "matched_required", "missing_required", "matched_nice", "explanation",
]


# Jobs that one call ranks a collection for.
MOST_JOBS = 20


def in_one_pool(documents: DataFrame, jd_id: str | int) -> DataFrame:
    """All documents as candidates for a single job.

    The id hangs on a column that every row has. As a mere constant it would be optimized out of the
    joins on it, which turns them into joins without a key.
    """
    return documents.withColumn("jd_id", F.when(F.col("pos").isNotNull(), F.lit(jd_id)))


def score_candidates(candidates: DataFrame, jobs: DataFrame, current_year: int, **options) -> DataFrame:
    """Candidates ``(jd_id, pos, id, category, text)`` with all scores and their explanation, in no order.

    The texts are read once, which is by far the dearest step, in one pass without a shuffle. What
    was read is stored: features and words. Options are those of :func:`score_read`.
    """
    return explained(_scored(candidates, jobs, current_year, **options))


def _scored(
    candidates: DataFrame, jobs: DataFrame, current_year: int, stop_words: Sequence[str] | None = None,
    vocab: Vocabulary = DEFAULT_VOCABULARY, **options,
) -> DataFrame:
    check_pools(candidates, jobs)
    stop_words = default_stop_words() if stop_words is None else stop_words
    read = materialize(read_documents(candidates, current_year, stop_words, vocab), "read-documents")
    return score_read(read, jobs, stop_words, vocab, **options)


def score_read(
    read: DataFrame,
    jobs: DataFrame,
    stop_words: Sequence[str],
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    weights: Mapping[str, float] | None = None,
    vectors: DataFrame | None = None,
    job_vectors: DataFrame | None = None,
) -> DataFrame:
    """Scores of documents that :func:`read_documents` has read and stored; every pool has its job in ``jobs``."""
    small = is_small(jobs)
    similar = cosine_with_job(read, jobs, stop_words, small)
    met = semantic_similarity(vectors, job_vectors) if vectors is not None and job_vectors is not None else None
    return _combined(read.drop("words"), jobs, similar, met, vocab, weights, small)


def _combined(
    rows: DataFrame, jobs: DataFrame, similar: DataFrame, met: DataFrame | None, vocab: Vocabulary,
    weights: Mapping[str, float] | None, small: bool,
) -> DataFrame:
    """Scores of feature rows from their features and the similarities to their job, ``similar`` in words and ``met`` in vectors."""
    profiles = parse_job_descriptions(jobs, vocab)
    scored = rows.join(_scaled(similar, "tfidf_score", small), ["jd_id", "pos"])
    if met is not None:
        all_rows = rows.select("jd_id", "pos").join(met, ["jd_id", "pos"], "left").fillna(0.0, ["similarity"])
        scored = scored.join(_scaled(materialize(all_rows, "semantic"), "semantic_score", small), ["jd_id", "pos"])
    else:
        scored = scored.withColumn("semantic_score", F.lit(None).cast("double"))

    profiled = attach(scored, profiles.drop("text"), "jd_id", F.col("pos"), small)
    return scoring.with_final_score(scoring.with_weights(scoring.with_feature_scores(profiled), weights))


def explained(scored: DataFrame) -> DataFrame:
    """Scored rows with their matches, education in words and explanation."""
    return scoring.with_matches(scored).withColumns(
        {"education": education_label(F.col("education_level")), "explanation": scoring.explanation()}
    )


def read_documents(
    candidates: DataFrame, current_year: int, stop_words: Sequence[str], vocab: Vocabulary = DEFAULT_VOCABULARY
) -> DataFrame:
    """Features and words of every candidate; the text itself is left behind."""
    category = F.col("category") if "category" in candidates.columns else F.lit("")
    texts = candidates.select("jd_id", F.col("pos").cast("bigint").alias("pos"), "id", category.alias("category"), "text")
    featured = build_features(spread(texts, "pos"), current_year, vocab, skills_of=extract_skills_nearby)
    return add_joined_words(featured, stop_words).drop("text")


def _scaled(similarity: DataFrame, name: str, small: bool) -> DataFrame:
    return minmax(similarity, "similarity", name, small).select("jd_id", "pos", name)


def _ranked(scored: DataFrame) -> DataFrame:
    # Stored before the ranges are drawn, which takes a pass of its own.
    narrow = materialize(explained(scored).select("pos", *(c for c in RANKING_COLUMNS if c != "rank")), "scored")
    return rank_rows(narrow, ["jd_id"], scoring.rank_order()).select(*RANKING_COLUMNS)


def rank_candidates(candidates: DataFrame, jobs: DataFrame, current_year: int, **options) -> DataFrame:
    """The full ranking, one row per candidate with ``rank`` from 1 within its job.

    Options are those of :func:`score_read`, ``stop_words`` and ``vocab``.
    """
    return _ranked(_scored(candidates, jobs, current_year, **options))


def top_candidates(candidates: DataFrame, jobs: DataFrame, current_year: int, n: int, **options) -> DataFrame:
    """The first ``n`` rows of every job's ranking.

    Every task cuts its scored rows down before they move, and only the rows that are left are explained; the
    ranking itself is never sorted or stored.
    """
    best = first_rows(_scored(candidates, jobs, current_year, **options), ["jd_id"], scoring.rank_order(), n, "rank")
    return explained(best).select(*RANKING_COLUMNS)


def score_for_jobs(
    documents: DataFrame, jobs: DataFrame, current_year: int, stop_words: Sequence[str] | None = None,
    vocab: Vocabulary = DEFAULT_VOCABULARY, weights: Mapping[str, float] | None = None,
    vectors: DataFrame | None = None, job_vectors: DataFrame | None = None,
) -> DataFrame:
    """One collection scored for each of a handful of jobs; options as for :func:`rank_for_jobs`.

    The texts are read once, and so are the chunk vectors. Document frequencies and lengths of the whole collection are
    computed once; a job only corrects those of its own terms (:func:`cosine_with_jobs`).
    """
    names = [r.jd_id for r in jobs.select("jd_id").distinct().orderBy("jd_id").limit(MOST_JOBS + 1).collect()]
    if not 0 < len(names) <= MOST_JOBS:
        raise ValueError(f"a collection is ranked for 1 to {MOST_JOBS} jobs at once")
    stop_words = default_stop_words() if stop_words is None else stop_words
    read = materialize(read_documents(in_one_pool(documents, names[0]), current_year, stop_words, vocab), "read-documents")
    kind = jobs.schema["jd_id"].dataType
    every_job = F.explode(F.array(*[F.lit(name).cast(kind) for name in names])).alias("jd_id")

    def for_every_job(df: DataFrame) -> DataFrame:
        return df.select(every_job, *(c for c in df.columns if c != "jd_id"))

    cosines = cosine_with_jobs(read.select("pos", "words"), jobs, stop_words)
    similar = for_every_job(read.select("pos")).join(cosines, ["jd_id", "pos"], "left").fillna(0.0, ["similarity"])
    met = semantic_for_jobs(vectors, job_vectors) if vectors is not None and job_vectors is not None else None
    rows = for_every_job(read.drop("words"))
    return _combined(rows, jobs, materialize(similar, "similar"), met, vocab, weights, True)


def rank_for_jobs(documents: DataFrame, jobs: DataFrame, current_year: int, **options) -> DataFrame:
    """One collection ranked for each of a handful of jobs.

    ``documents`` has ``pos, id, category, text`` and ``jobs`` has ``jd_id, text``, at most MOST_JOBS of them, as every
    job ranks the whole collection. Options are ``stop_words``, ``vocab``, ``weights``, and ``vectors`` (``pos, vector``) together
    with ``job_vectors`` (``jd_id, vector``).
    """
    return _ranked(score_for_jobs(documents, jobs, current_year, **options))


def weights_used(jobs: DataFrame, weights: Mapping[str, float] | None = None, semantic: bool = False) -> DataFrame:
    """Per job profile the weights after dropping what does not apply: ``(jd_id, component, weight)``."""
    marks = jobs.withColumns(
        {
            "skills_score": F.when((F.size("required") > 0) | (F.size("nice") > 0), F.lit(1.0)),
            "tfidf_score": F.lit(1.0),
            "semantic_score": F.lit(1.0 if semantic else None).cast("double"),
            "experience_score": F.when(F.col("min_years").isNotNull(), F.lit(1.0)),
            "education_score": F.when(F.col("min_education").isNotNull(), F.lit(1.0)),
        }
    )
    wide = scoring.with_weights(marks, weights).select(
        "jd_id", *(F.col(f"weight_{c}").alias(c) for c in scoring.COMPONENTS)
    )
    long = wide.unpivot(["jd_id"], list(scoring.COMPONENTS), "component", "weight")
    return long.where(F.col("weight").isNotNull())
