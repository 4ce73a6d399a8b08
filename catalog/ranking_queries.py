"""Similarity, scoring, ranking, evaluation, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import features
from rankloom.operators import evaluation, insights, jobs as job_ops, pools, scoring, similarity
from rankloom.operators.ordering import row_ordinals
from rankloom.plans import reweighting, screening
from rankloom.runtime import attach, is_small, materialize, scratch_path
from rankloom.sources import sinks

from . import fixtures as fx
from .fixtures import SINGLE_JOB, YEAR, sql_list, table, with_fixtures
from .text_queries import sql_grams

TOP = 10
POOL = 30
SEED = 42
WEIGHTS = {"skills": 0.5, "tfidf": 0.25, "education": 0.0}


# ---- inputs ---------------------------------------------------------------------------------


def _plain(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Raw documents as one pool each per source, with the benchmark item of that number as query text."""
    documents = table(spark, sf, "documents").select(
        F.substring("source", 4, 9).cast("bigint").alias("jd_id"), F.col("doc_id").alias("pos"), "text"
    )
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("jd_id"), "text")
    return documents, items.join(documents.select("jd_id").distinct(), "jd_id", "left_semi")


def _by_source(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Candidates screened for the job with the number of their source."""
    people = fx.candidates(spark, sf)
    return people, fx.jobs(spark, sf).join(people.select("jd_id").distinct(), "jd_id", "left_semi")


def _single(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All candidates screened for one job."""
    return screening.in_one_pool(fx.candidates(spark, sf), SINGLE_JOB), fx.single_job(spark, sf)


def _vectors(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Embeddings as chunks, four or more to an owner, the owners spread over all candidates; vector 0 is the query."""
    vectors = table(spark, sf, "embeddings")
    owners = F.lit(max(vectors.count() // 4, 1))
    apart = F.lit(max(table(spark, sf, "documents").count() // max(vectors.count() // 4, 1), 1))
    owner = (F.col("vec_id") % owners * apart).alias("pos")
    rows = vectors.select("vec_id", owner, F.col("embedding").alias("vector"))
    in_pool = screening.in_one_pool(rows, SINGLE_JOB)
    return in_pool.where("vec_id <> 0").drop("vec_id"), in_pool.where("vec_id = 0").select("jd_id", "vector")


def _featured(spark, sf, pools_of=_by_source) -> DataFrame:
    """Candidates with features next to the profile of their job."""
    people, openings = pools_of(spark, sf)
    profiles = job_ops.parse_job_descriptions(openings).drop("text")
    rows = features.build_features(people, YEAR).drop("text")
    return attach(rows, profiles, "jd_id", F.col("pos"), is_small(profiles))


# ---- SQL building blocks --------------------------------------------------------------------


def tfidf_ctes(documents: str, queries: str, prefix: str = "") -> list[str]:
    """CTEs up to ``cosines(jd_id, pos, similarity)`` from selects of (jd_id, pos, text) and (jd_id, text)."""
    return [
        f"corpus AS ({documents} UNION ALL SELECT jd_id, -1 AS pos, text FROM ({queries}))",
        f"words AS (SELECT jd_id, pos, {sql_grams('text')} AS w FROM corpus)",
        "grams AS (SELECT jd_id, pos, unnest(list_concat(w, list_transform(range(1, len(w)), "
        "lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words)",
        "tf AS (SELECT jd_id, pos, term, count(*) AS c FROM grams GROUP BY ALL)",
        "sizes AS (SELECT jd_id, count(*) AS n FROM corpus GROUP BY ALL)",
        "idf AS (SELECT jd_id, term, count(*) AS df, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf "
        "FROM tf JOIN sizes USING (jd_id) GROUP BY ALL)",
        "weighted AS (SELECT jd_id, pos, term, (1 + ln(c)) * idf AS w FROM tf JOIN idf USING (jd_id, term))",
        "norms AS (SELECT jd_id, pos, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY ALL)",
        "dots AS (SELECT d.jd_id, d.pos, sum(d.w * q.w) AS dot FROM weighted d JOIN weighted q "
        "ON q.jd_id = d.jd_id AND q.term = d.term AND q.pos = -1 WHERE d.pos <> -1 GROUP BY ALL)",
        "cosines AS (SELECT c.jd_id, c.pos, round(coalesce(dot / (d.norm * q.norm), 0), 10) AS similarity "
        "FROM corpus c LEFT JOIN dots USING (jd_id, pos) LEFT JOIN norms d USING (jd_id, pos) "
        "LEFT JOIN norms q ON q.jd_id = c.jd_id AND q.pos = -1 WHERE c.pos <> -1)",
    ]


def scaled_cte(name: str, source: str) -> str:
    return f"""{name} AS (
    SELECT jd_id, pos, CASE WHEN count(*) OVER p < 2 OR max(similarity) OVER p - min(similarity) OVER p < 1e-12
        THEN least(greatest(similarity, 0), 1)
        ELSE (similarity - min(similarity) OVER p) / (max(similarity) OVER p - min(similarity) OVER p) END AS score
    FROM {source} WINDOW p AS (PARTITION BY jd_id))"""


PLAIN_DOCUMENTS = "SELECT CAST(substr(source, 4) AS BIGINT) AS jd_id, doc_id AS pos, text FROM documents"
PLAIN_QUERIES = "SELECT item_id AS jd_id, text FROM benchmark WHERE item_id IN (SELECT CAST(substr(source, 4) AS BIGINT) FROM documents)"
PLAIN_TFIDF = tfidf_ctes(PLAIN_DOCUMENTS, PLAIN_QUERIES)


def plain(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([*PLAIN_TFIDF, *ctes]) + "\n" + select


SEMANTIC_SQL = """
sims AS (
    SELECT e.vec_id % (SELECT greatest(count(*) // 4, 1) FROM embeddings)
        * (SELECT greatest((SELECT count(*) FROM documents) // greatest(count(*) // 4, 1), 1) FROM embeddings) AS pos, list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS sim
    FROM embeddings e JOIN embeddings q ON q.vec_id = 0 WHERE e.vec_id <> 0),
best AS (
    SELECT pos, round(avg(sim), 10) AS similarity
    FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY sim DESC) AS r FROM sims) WHERE r <= 3 GROUP BY pos)"""

COMPONENTS = scoring.COMPONENTS


def ranked_ctes(single: bool | list[int], weights: dict | None = None, semantic: bool = False) -> list[str]:
    """CTEs up to ``ranked`` with all columns of a ranking, out of the expected features."""
    weights = scoring.merge_weights(weights)
    jobs = [SINGLE_JOB] if single is True else single or []
    pool = "pool AS (SELECT {0} AS jd_id, * FROM cand{1})".format(
        *(("asked", f", (SELECT unnest({jobs}) AS asked)") if jobs else ("source_no", ""))
    )
    documents = "SELECT jd_id, pos, text FROM pool"
    queries = "SELECT jd_id, text FROM prof WHERE jd_id IN (SELECT jd_id FROM pool)"
    met = "SELECT p.jd_id, p.pos, coalesce(b.similarity, 0) AS similarity FROM pool p LEFT JOIN best b USING (pos)"
    active = {
        c: f"CASE WHEN {c}_score IS NOT NULL THEN {weights[c]!r} ELSE 0 END" if weights[c] > 0 else "0" for c in COMPONENTS
    }
    total = " + ".join(active.values())
    explain = """
        CASE WHEN len(required) > 0 THEN 'matches ' || len(list_intersect(required, skills)) || '/' || len(required) || ' required skills' END,
        CASE WHEN missing_required <> '' THEN 'missing: ' || missing_required END,
        CASE WHEN len(nice) > 0 THEN len(list_intersect(nice, skills)) || '/' || len(nice) || ' nice-to-have' END,
        CASE WHEN min_years IS NOT NULL THEN 'experience ' || CAST(experience_years AS INTEGER) || ' yrs vs '
            || CAST(min_years AS INTEGER) || ' required' END,
        CASE WHEN min_education IS NOT NULL THEN 'education ' || education || ' vs ' || labels[min_education + 1] || ' required' END"""
    listing = "array_to_string(list_sort(list_filter({0}, lambda s: {1}list_contains(skills, s))), ', ')"
    return [
        pool,
        *tfidf_ctes(documents, queries),
        scaled_cte("tfidf", "cosines"),
        *([SEMANTIC_SQL, scaled_cte("semantic", f"({met})")] if semantic else []),
        f"""scored AS (
    SELECT pool.*, required, nice, min_years, min_education,
        ['Not stated', 'Diploma', 'Bachelor''s', 'Master''s', 'PhD'] AS labels,
        labels[education_level + 1] AS education,
        CASE WHEN len(required) > 0 THEN len(list_intersect(required, skills)) / len(required) END AS must,
        CASE WHEN len(nice) > 0 THEN len(list_intersect(nice, skills)) / len(nice) END AS may,
        coalesce(0.8::DOUBLE * must + 0.2::DOUBLE * may, must, may) AS skills_score,
        tfidf.score AS tfidf_score,
        {"semantic.score" if semantic else "CAST(NULL AS DOUBLE)"} AS semantic_score,
        CASE WHEN min_years IS NOT NULL THEN least(greatest(experience_years / greatest(min_years, 1e-9), 0), 1) END AS experience_score,
        CASE WHEN min_education IS NOT NULL THEN least(greatest(education_level / min_education, 0), 1) END AS education_score,
        {listing.format('required', '')} AS matched_required,
        {listing.format('required', 'NOT ')} AS missing_required,
        {listing.format('nice', '')} AS matched_nice,
        concat_ws('; ', {explain}) AS sentence
    FROM pool JOIN prof USING (jd_id) JOIN tfidf USING (jd_id, pos)
        {"JOIN semantic USING (jd_id, pos)" if semantic else ""})""",
        f"""finals AS (
    SELECT *, CAST({total} AS DOUBLE) AS total,
        {", ".join(f"CAST({active[c]} AS DOUBLE) / nullif(total, 0) AS weight_{c}" for c in COMPONENTS)},
        {", ".join(f"CASE WHEN {active[c]} > 0 THEN 100 * weight_{c} * {c}_score END AS contrib_{c}" for c in COMPONENTS)},
        100 * ({" + ".join(f"coalesce(weight_{c} * {c}_score, 0)" for c in COMPONENTS)}) AS final_score
    FROM scored)""",
        """ranked AS (
    SELECT row_number() OVER (PARTITION BY jd_id ORDER BY final_score DESC NULLS LAST, skills_score DESC NULLS LAST, pos) AS rank,
        *, upper(sentence[1]) || sentence[2:] AS explanation
    FROM finals)""",
    ]


def ranked_sql(select: str, *ctes: str, single: bool | list[int] = False, weights: dict | None = None, semantic: bool = False) -> str:
    return with_fixtures(select, *ranked_ctes(single, weights, semantic), *ctes)


SCORES = [f"{c}_score" for c in ("final", *COMPONENTS)]
CONTRIBS = [f"contrib_{c}" for c in COMPONENTS]


def _rounded(columns: list[str]) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


def sql_rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


TEXTUAL = ["education", "matched_required", "missing_required", "matched_nice", "explanation"]


def _shown(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "rank", F.col("jd_id").cast("bigint").alias("jd_id"), "id", "category", *_rounded(SCORES + CONTRIBS), "experience_years", *TEXTUAL
    )


SQL_SHOWN = (
    f"SELECT rank, CAST(jd_id AS BIGINT) AS jd_id, id, category, {sql_rounded(SCORES + CONTRIBS)}, experience_years, {', '.join(TEXTUAL)} FROM ranked"
)


# ---- similarity -----------------------------------------------------------------------------


def sublinear_tf(spark, sf):
    """Every document's number of terms, and the sum and sum of squares of their weights."""
    documents, _ = _plain(spark, sf)
    tf = similarity.term_frequencies(documents, fx.STOP_WORDS)
    weight = similarity.sublinear_tf(F.col("tf"))
    return tf.groupBy("jd_id", "pos").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.sum(weight), 6).alias("total"), F.round(F.sum(weight * weight), 6).alias("squares")
    )


SUBLINEAR_TF = plain(
    "SELECT jd_id, pos, count(*) AS terms, round(sum(1 + ln(c)), 6) AS total, round(sum((1 + ln(c)) * (1 + ln(c))), 6) AS squares "
    "FROM tf WHERE pos <> -1 GROUP BY ALL"
)


def smooth_idf(spark, sf):
    """Per pool and document frequency: the weight, and how many terms have it."""
    corpus = similarity.with_job_texts(*_plain(spark, sf))
    counted = similarity.document_frequencies(similarity.term_frequencies(corpus, fx.STOP_WORDS))
    sizes = similarity.corpus_sizes(corpus)
    sized = attach(counted, sizes, "jd_id", F.col("term"), is_small(sizes))
    weighted = sized.withColumn("idf", similarity.smooth_idf(F.col("df"), F.col("n")))
    return weighted.groupBy("jd_id", "df").agg(F.round(F.max("idf"), 6).alias("idf"), F.count(F.lit(1)).alias("terms"))


SMOOTH_IDF = plain("SELECT jd_id, df, round(max(idf), 6) AS idf, count(*) AS terms FROM idf GROUP BY jd_id, df")


def _cosines(spark, sf):
    return similarity.tfidf_similarity(*_plain(spark, sf))


def tfidf_cosine(spark, sf):
    return _cosines(spark, sf).select("jd_id", "pos", F.round("similarity", 6).alias("similarity"))


TFIDF_COSINE = plain("SELECT jd_id, pos, round(similarity, 6) AS similarity FROM cosines")


def semantic_top3_mean(spark, sf):
    return similarity.semantic_similarity(*_vectors(spark, sf)).select("pos", F.round("similarity", 6).alias("similarity"))


def semantic_for_jobs(spark, sf):
    """The chunks of every owner against three jobs at once: the vectors 0, 1 and 2."""
    chunks, _ = _vectors(spark, sf)
    queries = table(spark, sf, "embeddings").where("vec_id < 3").select(F.col("vec_id").alias("jd_id"), F.col("embedding").alias("vector"))
    return similarity.semantic_for_jobs(chunks, queries).select("jd_id", "pos", F.round("similarity", 6).alias("similarity"))


SEMANTIC_JOBS = """
WITH sims AS (
    SELECT q.vec_id AS jd_id, e.vec_id % (SELECT greatest(count(*) // 4, 1) FROM embeddings)
        * (SELECT greatest((SELECT count(*) FROM documents) // greatest(count(*) // 4, 1), 1) FROM embeddings) AS pos,
        list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS sim
    FROM embeddings e JOIN embeddings q ON q.vec_id < 3 WHERE e.vec_id <> 0)
SELECT jd_id, pos, round(avg(sim), 6) AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY jd_id, pos ORDER BY sim DESC) AS r FROM sims) WHERE r <= 3 GROUP BY jd_id, pos"""


def minmax(spark, sf):
    cosines = materialize(_cosines(spark, sf), "cosines")
    scaled = similarity.minmax(cosines, "similarity", "score", is_small(cosines.select("jd_id").distinct()))
    return scaled.select("jd_id", "pos", F.round("score", 6).alias("score"))


MINMAX = plain("SELECT jd_id, pos, round(score, 6) AS score FROM tfidf", scaled_cte("tfidf", "cosines"))


# ---- scoring --------------------------------------------------------------------------------


def _feature_scores(spark, sf):
    return scoring.with_feature_scores(_featured(spark, sf))


def _one_score(name):
    def query(spark, sf):
        return _feature_scores(spark, sf).select("jd_id", "id", F.round(name, 6).alias(name))

    return query


SQL_MEMBERS = "cand JOIN prof ON prof.jd_id = cand.source_no"
SKILL_SCORE = with_fixtures(f"""
SELECT jd_id, id, round(coalesce(0.8 * must + 0.2 * may, must, may), 6) AS skills_score FROM (
    SELECT jd_id, id, len(list_intersect(required, skills)) / nullif(len(required), 0) AS must,
        len(list_intersect(nice, skills)) / nullif(len(nice), 0) AS may FROM {SQL_MEMBERS})""")
EXPERIENCE_SCORE = with_fixtures(
    f"SELECT jd_id, id, round(least(experience_years / min_years, 1.0), 6) AS experience_score FROM {SQL_MEMBERS}"
).replace("least(experience_years / min_years, 1.0)", "CASE WHEN min_years IS NOT NULL THEN least(experience_years / min_years, 1.0) END")
EDUCATION_SCORE = with_fixtures(
    f"SELECT jd_id, id, CASE WHEN min_education IS NOT NULL THEN round(least(education_level / min_education, 1.0), 6) END "
    f"AS education_score FROM {SQL_MEMBERS}"
)


def renormalize_weights(spark, sf):
    """Weights used for every job description of the table."""
    weights = screening.weights_used(job_ops.parse_job_descriptions(fx.jobs(spark, sf)), WEIGHTS)
    return weights.select("jd_id", "component", F.round("weight", 6).alias("weight"))


RENORMALIZE = with_fixtures("""
SELECT jd_id, component, round(weight / sum(weight) OVER (PARTITION BY jd_id), 6) AS weight FROM (
    SELECT jd_id, 'skills' AS component, 0.5::DOUBLE AS weight FROM prof WHERE len(required) + len(nice) > 0
    UNION ALL SELECT jd_id, 'tfidf', 0.25 FROM prof
    UNION ALL SELECT jd_id, 'experience', 0.12 FROM prof WHERE min_years IS NOT NULL)""")


def matched_missing(spark, sf):
    return scoring.with_matches(_featured(spark, sf)).select("jd_id", "id", "matched_required", "missing_required", "matched_nice")


MATCHED_MISSING = ranked_sql("SELECT jd_id, id, matched_required, missing_required, matched_nice FROM scored")


def explain(spark, sf):
    return _featured(spark, sf).select("jd_id", "id", scoring.explanation().alias("explanation"))


EXPLAIN = ranked_sql("SELECT jd_id, id, upper(sentence[1]) || sentence[2:] AS explanation FROM scored")


def skill_algebra(operator):
    def query(spark, sf):
        chosen = operator(F.col("required"), F.col("skills"))
        return _featured(spark, sf).select("jd_id", "id", F.array_join(F.array_sort(chosen), ",").alias("skills"))

    return query


def _algebra_sql(negation: str) -> str:
    return with_fixtures(
        f"SELECT jd_id, id, array_to_string(list_sort(list_filter(required, lambda s: {negation} list_contains(skills, s))), ',') "
        f"AS skills FROM {SQL_MEMBERS}"
    )


def doc_job_cross(spark, sf):
    """Every document next to the profile of the one job."""
    return _featured(spark, sf, _single).select(
        F.col("jd_id").cast("bigint").alias("jd_id"), "id", F.size("required").alias("required"),
        F.size(F.array_intersect("required", "skills")).alias("matched"),
    )


DOC_JOB = with_fixtures(
    f"SELECT CAST(jd_id AS BIGINT) AS jd_id, id, CAST(len(required) AS INTEGER) AS required, "
    f"CAST(len(list_intersect(required, skills)) AS INTEGER) AS matched FROM cand JOIN prof ON jd_id = {SINGLE_JOB}"
)


# ---- ranking --------------------------------------------------------------------------------


def _rank(spark, sf, pools_of=_by_source, **options) -> DataFrame:
    return screening.rank_candidates(*pools_of(spark, sf), YEAR, **options)


def rank_candidates(spark, sf):
    """The whole table against one job."""
    return _shown(_rank(spark, sf, _single))


def rank_candidates_by_source(spark, sf):
    """The whole table, every source a pool of its own with its own job."""
    return _shown(_rank(spark, sf))


def rank_candidates_weighted(spark, sf):
    """Own weights: one component switched off, two changed."""
    return _shown(_rank(spark, sf, _single, weights=WEIGHTS))


def rank_candidates_semantic(spark, sf):
    """With vectors for candidates all over the table; those without any count as 0."""
    chunks, asked = _vectors(spark, sf)
    return _shown(_rank(spark, sf, _single, vectors=chunks, job_vectors=asked))


def final_score(spark, sf):
    return _scored_only(spark, sf).select("jd_id", "id", *_rounded(["final_score"]))


def contributions(spark, sf):
    return _scored_only(spark, sf).select("jd_id", "id", *_rounded(CONTRIBS))


def _scored_only(spark, sf):
    return screening.score_candidates(*_by_source(spark, sf), YEAR)


def rank(spark, sf):
    return _rank(spark, sf).select("jd_id", "rank", "id")


def top_n(spark, sf):
    return _shown(screening.top_candidates(*_single(spark, sf), YEAR, TOP))


def rank_for_jobs(spark, sf):
    """The whole table against several jobs, its texts read once."""
    openings = fx.jobs(spark, sf).where(F.col("jd_id").isin(fx.SEVERAL_JOBS))
    return _shown(screening.rank_for_jobs(fx.candidates(spark, sf).drop("jd_id"), openings, YEAR))


WEIGHTINGS = {"even": {"skills": 0.2, "tfidf": 0.2, "experience": 0.2, "education": 0.2}, "terms": WEIGHTS | {"skills": 0.05, "tfidf": 0.9}}


def _component_store(spark, sf):
    return reweighting.store_components(screening.score_candidates(*_single(spark, sf), YEAR))


def _each_weighting(rank):
    """Every weighting ranked from one store of components."""

    def query(spark, sf):
        store = _component_store(spark, sf)
        parts = [_shown(rank(store, weights)).withColumn("weighting", F.lit(name)) for name, weights in WEIGHTINGS.items()]
        return reduce(DataFrame.unionByName, parts)

    return query


top_n_reweighted = _each_weighting(lambda store, weights: reweighting.top_reweighted(store, TOP, weights))
rank_reweighted = _each_weighting(reweighting.rank_reweighted)


def reweighted_sql(where: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT *, '{name}' AS weighting FROM ({ranked_sql(SQL_SHOWN + where, single=True, weights=weights)})" for name, weights in WEIGHTINGS.items()
    )


def ranking_sink(spark, sf):
    """Written without contributions, once as parquet and once as CSV, each in several files, and read back from both.

    ``place`` is the row's number when the files are read in order of their names.
    """
    ranked = materialize(_rank(spark, sf), "ranking")
    paths = {fmt: scratch_path(spark, f"ranking-{fmt}") for fmt in ("parquet", "csv")}
    for fmt, path in paths.items():
        sinks.write_ranking(ranked, path, fmt, files=5)
    back = spark.read.parquet(paths["parquet"])
    csv = spark.read.schema(back.schema).csv(paths["csv"], header=True, quote='"', escape='"', multiLine=True)
    texts = ["category", *TEXTUAL]
    # CSV has one notation for an empty text and none for a missing one.
    parts = [row_ordinals(df, "place").withColumn("written_as", F.lit(name)) for name, df in (("parquet", back), ("csv", csv))]
    both = reduce(DataFrame.unionByName, parts)
    return both.select(
        "written_as", "rank", (F.col("place") + 1).alias("place"), "jd_id", "id",
        *_rounded([c for c in back.columns if c.endswith("_score")]), "experience_years",
        *(F.coalesce(c, F.lit("")).alias(c) for c in texts),
    )


RANKING_SINK = ranked_sql(
    f"SELECT written_as, rank, row_number() OVER (PARTITION BY written_as ORDER BY jd_id, rank) AS place, jd_id, id, {sql_rounded(SCORES)}, experience_years, "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in ["category", *TEXTUAL])
    + " FROM ranked, (VALUES ('parquet'), ('csv')) formats(written_as)"
)


# ---- evaluation -----------------------------------------------------------------------------


def _relabelled(spark, sf):
    """A label store to which every third label was appended again, with another value."""
    first = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), F.col("quality").alias("label"))
    again = first.where("cast(id as bigint) % 3 = 0").withColumn("label", 1 - F.col("label"))
    return first.withColumn("pos", F.lit(0)).unionByName(again.withColumn("pos", F.lit(1)))


def _labels(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), F.col("quality").alias("label"))


def join_labels(spark, sf):
    joined = evaluation.join_labels(_rank(spark, sf), _labels(spark, sf))
    return joined.select("jd_id", "rank", "id", "label")


JOIN_LABELS = ranked_sql("SELECT jd_id, rank, id, quality AS label FROM ranked JOIN labels ON pos = doc_id")


def _method_scores(spark, sf, pools_of=_by_source, labels=None):
    joined = evaluation.join_labels(_rank(spark, sf, pools_of), (labels or _labels)(spark, sf))
    return materialize(evaluation.scores_by_method(joined.drop("semantic_score")), "method-scores")


def _metric(metric, columns, pools_of=_by_source, labels=None, **options):
    def query(spark, sf):
        return metric(_method_scores(spark, sf, pools_of, labels), **options).select("jd_id", "method", *_rounded(columns))

    return query


KS = evaluation.KS
P_COLUMNS = [f"p_at_{k}" for k in KS]
N_COLUMNS = [f"ndcg_at_{k}" for k in KS]


STORED = "(SELECT doc_id, quality, 0 AS nth FROM labels)"
RELABELLED = "(SELECT doc_id, quality, 0 AS nth FROM labels UNION ALL SELECT doc_id, 1 - quality, 1 FROM labels WHERE doc_id % 3 = 0)"


def _metric_ctes(methods: list[str], labels: str = STORED) -> list[str]:
    """P@K, NDCG@K with averaged ties and Spearman over average ranks, straight from their definitions."""
    unpivoted = " UNION ALL ".join(
        f"SELECT jd_id, '{m}' AS method, rank, CAST(quality AS DOUBLE) AS label, nth, coalesce({m}_score, 0) AS score "
        f"FROM ranked JOIN {labels} ON pos = doc_id" for m in methods
    )
    discount = "CASE WHEN {0} <= {1} THEN 1 / log2({0} + 1) ELSE 0 END"
    return [
        f"long AS ({unpivoted})",
        """placed AS (
    SELECT *, row_number() OVER (PARTITION BY jd_id, method ORDER BY score DESC, rank, nth) AS place,
        row_number() OVER (PARTITION BY jd_id, method ORDER BY label DESC) AS ideal,
        avg(label) OVER (PARTITION BY jd_id, method, score) AS shared,
        rank() OVER (PARTITION BY jd_id, method ORDER BY score) + (count(*) OVER (PARTITION BY jd_id, method, score) - 1) / 2 AS rs,
        rank() OVER (PARTITION BY jd_id, method ORDER BY label) + (count(*) OVER (PARTITION BY jd_id, method, label) - 1) / 2 AS rl
    FROM long)""",
        "metrics AS (SELECT jd_id, method, "
        + ", ".join(f"round(avg(CASE WHEN label >= 1 THEN 1 ELSE 0 END) FILTER (place <= {k}), 6) AS p_at_{k}" for k in KS)
        + ", "
        + ", ".join(
            f"round(CASE WHEN count(*) > 1 THEN coalesce(sum(shared * {discount.format('place', k)}) / "
            f"nullif(sum(label * {discount.format('ideal', k)}), 0), 0) END, 6) AS ndcg_at_{k}" for k in KS
        )
        + ", CASE WHEN min(label) < max(label) AND min(score) < max(score) THEN round(corr(rs, rl), 6) END AS spearman "
        "FROM placed GROUP BY jd_id, method)",
    ]


METHODS = ["final", "skills", "tfidf"]


def metric_sql(columns: list[str], single: bool = False, semantic: bool = False, labels: str = STORED) -> str:
    methods = METHODS + ["semantic"] * semantic
    keep = "" if semantic else "WHERE method <> 'skills' OR jd_id IN (SELECT jd_id FROM prof WHERE len(required) + len(nice) > 0)"
    return ranked_sql(
        f"SELECT CAST(jd_id AS BIGINT) AS jd_id, method, {', '.join(columns)} FROM metrics {keep if not single else ''}",
        *_metric_ctes(methods, labels), single=single, semantic=semantic,
    )


def evaluate_rankings(spark, sf):
    """All metrics per source; methods that do not apply to a job are left out."""
    return evaluation.evaluate_rankings(_rank(spark, sf), _labels(spark, sf), relevant=1, digits=6)


def evaluate_rankings_semantic(spark, sf):
    """All metrics for the whole table as one pool, all four methods."""
    chunks, asked = _vectors(spark, sf)
    ranked = _rank(spark, sf, _single, vectors=chunks, job_vectors=asked)
    result = evaluation.evaluate_rankings(ranked, _labels(spark, sf), relevant=1, digits=6)
    return result.withColumn("jd_id", F.col("jd_id").cast("bigint"))


# ---- reports and pools ----------------------------------------------------------------------


def screening_summary(spark, sf):
    people, openings = _by_source(spark, sf)
    summary = insights.screening_summary(_rank(spark, sf), job_ops.parse_job_descriptions(openings))
    return summary.withColumn("top_score", F.round("top_score", 6))


SCREENING_SUMMARY = ranked_sql(
    "SELECT jd_id, count(*) AS candidates, CAST(any_value(len(required)) AS INTEGER) AS required_skills, "
    "any_value(min_years) AS min_years, round(max(final_score), 6) AS top_score FROM ranked GROUP BY jd_id"
)


def ranked_table(spark, sf):
    """All candidates with the columns people read, at six digits so that both engines round alike."""
    return insights.ranked_table(_rank(spark, sf), 6)


RANKED_TABLE = ranked_sql(
    f"SELECT jd_id, rank, id, category, {sql_rounded(['final_score', 'skills_score', 'tfidf_score', 'semantic_score'])}, "
    "experience_years, education, explanation FROM ranked"
)


def skill_gap_counts(spark, sf):
    return insights.skill_gap_counts(_rank(spark, sf), TOP)


SKILL_GAPS = ranked_sql(f"""
SELECT jd_id, skill, count(*) AS missing FROM (
    SELECT jd_id, unnest(list_filter(required, lambda s: NOT list_contains(skills, s))) AS skill FROM ranked WHERE rank <= {TOP})
GROUP BY jd_id, skill""")


def score_breakdown(spark, sf):
    breakdown = insights.score_breakdown(_rank(spark, sf), TOP)
    return breakdown.withColumn("contribution", F.round("contribution", 6))


SCORE_BREAKDOWN = ranked_sql(
    " UNION ALL ".join(
        f"SELECT jd_id, rank, id, '{c}' AS component, round(contrib_{c}, 6) AS contribution FROM ranked "
        f"WHERE rank <= {TOP} AND contrib_{c} IS NOT NULL" for c in COMPONENTS
    )
)


def topk_pool(spark, sf):
    best = pools.topk_pool(materialize(_rank(spark, sf), "ranking"), "tfidf_score")
    return best.select("jd_id", "id", *_rounded(["tfidf_score"]))


TOPK_POOL = ranked_sql("""
SELECT jd_id, id, round(tfidf_score, 6) AS tfidf_score FROM (
    SELECT *, row_number() OVER (PARTITION BY jd_id ORDER BY tfidf_score DESC NULLS LAST, rank) AS place FROM ranked) WHERE place <= 40""")


def stratified_pool(spark, sf):
    return pools.stratified_pool(_rank(spark, sf), POOL, SEED, fx.RELEVANT_CATEGORIES)


def _stratified_ctes() -> list[str]:
    """Draw the strata one after the other, each without what is already drawn."""
    draw = f"md5('{SEED}|' || id)"
    relevant = f"coalesce(list_contains({sql_list(fx.RELEVANT_CATEGORIES)}, category), false)"
    strata = {
        "top_skill": "skill_place <= 40", "top_tfidf": "tfidf_place <= 40",
        "relevant": relevant, "other": f"NOT {relevant}", "any": "true",
    }
    quotas = {s: round(POOL * share) for s, share in pools.QUOTAS}
    ctes = [f"""placed_rows AS (
    SELECT jd_id, id, rank, category, {draw} AS draw,
        row_number() OVER (PARTITION BY jd_id ORDER BY skills_score DESC NULLS LAST, rank) AS skill_place,
        row_number() OVER (PARTITION BY jd_id ORDER BY tfidf_score DESC NULLS LAST, rank) AS tfidf_place
    FROM ranked)""", "picks0 AS (SELECT jd_id, id, '' AS stratum FROM placed_rows WHERE false)"]
    for i, (stratum, condition) in enumerate(strata.items()):
        quota = quotas.get(stratum, f"{POOL} - (SELECT count(*) FROM picks{i} q WHERE q.jd_id = t.jd_id)")
        ctes.append(f"""picks{i + 1} AS MATERIALIZED (
    SELECT * FROM picks{i} UNION ALL
    SELECT jd_id, id, '{stratum}' FROM (
        SELECT *, row_number() OVER (PARTITION BY jd_id ORDER BY draw, rank) AS place FROM placed_rows r
        WHERE {condition} AND NOT EXISTS (SELECT 1 FROM picks{i} p WHERE p.jd_id = r.jd_id AND p.id = r.id)) t
    WHERE place <= {quota})""")
    return ctes


STRATIFIED_POOL = ranked_sql(
    f"SELECT * FROM (SELECT jd_id, CAST(row_number() OVER (PARTITION BY jd_id ORDER BY md5('{SEED}shuffle|' || id), id) AS INTEGER) AS pick, "
    f"id, stratum FROM picks5) WHERE pick <= {POOL}",
    *_stratified_ctes(),
)


def unlabelled_anti(spark, sf):
    return pools.unlabelled(fx.candidates(spark, sf).select("jd_id", "id"), _labels(spark, sf))


UNLABELLED = with_fixtures("SELECT source_no AS jd_id, id FROM cand WHERE pos NOT IN (SELECT doc_id FROM labels)")


def _category_names(spark):
    return spark.createDataFrame([(c,) for c in fx.RELEVANT_CATEGORIES], "category string")


def category_semi(spark, sf):
    return insights.split_by_category(fx.candidates(spark, sf).select("id", "category"), _category_names(spark))


def category_anti(spark, sf):
    return insights.split_by_category(fx.candidates(spark, sf).select("id", "category"), _category_names(spark), relevant_rows=False)


CATEGORY_SEMI = with_fixtures(f"SELECT id, category FROM cand WHERE list_contains({sql_list(fx.RELEVANT_CATEGORIES)}, category)")
CATEGORY_ANTI = with_fixtures(
    f"SELECT id, category FROM cand WHERE category IS NULL OR NOT list_contains({sql_list(fx.RELEVANT_CATEGORIES)}, category)"
)


def lookup_by_id(spark, sf):
    """The texts of the labelled documents."""
    return insights.texts_of(_labels(spark, sf), fx.candidates(spark, sf).select("id", "text")).select("id", "label", "text")


def lookup_in_store(spark, sf):
    """Some labelled documents, looked up in a store of all documents in ranges of their ids."""
    path = scratch_path(spark, "documents")
    sinks.write_documents(fx.candidates(spark, sf).select("id", "category", "text"), path)
    ids = _labels(spark, sf).where("id is not null").select("id").distinct().orderBy("id").limit(LOOKED_UP).collect()
    return insights.lookup_by_id(spark.read.parquet(path), [r.id for r in ids]).select("id", "category", "text")


LOOKED_UP = 7
LOOKUP_IN_STORE = with_fixtures(f"""SELECT id, category, text FROM cand WHERE id IN (
    SELECT DISTINCT CAST(doc_id AS VARCHAR) AS l FROM labels WHERE doc_id IS NOT NULL ORDER BY l LIMIT {LOOKED_UP})""")
LOOKUP = with_fixtures("SELECT id, quality AS label, text FROM cand JOIN labels ON pos = doc_id")


QUERIES = {
    "sublinear_tf": (sublinear_tf, SUBLINEAR_TF),
    "smooth_idf": (smooth_idf, SMOOTH_IDF),
    "tfidf_cosine": (tfidf_cosine, TFIDF_COSINE),
    "semantic_top3_mean": (
        semantic_top3_mean, f"WITH {SEMANTIC_SQL} SELECT pos, round(similarity, 6) AS similarity FROM best"
    ),
    "semantic_for_jobs": (semantic_for_jobs, SEMANTIC_JOBS),
    "minmax": (minmax, MINMAX),
    "skill_score": (_one_score("skills_score"), SKILL_SCORE),
    "experience_score": (_one_score("experience_score"), EXPERIENCE_SCORE),
    "education_score": (_one_score("education_score"), EDUCATION_SCORE),
    "renormalize_weights": (renormalize_weights, RENORMALIZE),
    "final_score": (final_score, ranked_sql("SELECT jd_id, id, round(final_score, 6) AS final_score FROM ranked")),
    "contributions": (contributions, ranked_sql(f"SELECT jd_id, id, {sql_rounded(CONTRIBS)} FROM ranked")),
    "matched_missing": (matched_missing, MATCHED_MISSING),
    "explain": (explain, EXPLAIN),
    "rank": (rank, ranked_sql("SELECT jd_id, rank, id FROM ranked")),
    "rank_candidates": (rank_candidates, ranked_sql(SQL_SHOWN, single=True)),
    "rank_candidates_by_source": (rank_candidates_by_source, ranked_sql(SQL_SHOWN)),
    "rank_candidates_weighted": (rank_candidates_weighted, ranked_sql(SQL_SHOWN, single=True, weights=WEIGHTS)),
    "rank_candidates_semantic": (rank_candidates_semantic, ranked_sql(SQL_SHOWN, single=True, semantic=True)),
    "rank_for_jobs": (rank_for_jobs, ranked_sql(SQL_SHOWN, single=fx.SEVERAL_JOBS)),
    "top_n": (top_n, ranked_sql(SQL_SHOWN + f" WHERE rank <= {TOP}", single=True)),
    "top_n_reweighted": (top_n_reweighted, reweighted_sql(f" WHERE rank <= {TOP}")),
    "rank_reweighted": (rank_reweighted, reweighted_sql()),
    "ranking_sink": (ranking_sink, RANKING_SINK),
    "join_labels": (join_labels, JOIN_LABELS),
    "unlabelled_anti": (unlabelled_anti, UNLABELLED),
    "category_semi": (category_semi, CATEGORY_SEMI),
    "category_anti": (category_anti, CATEGORY_ANTI),
    "skill_intersect": (skill_algebra(F.array_intersect), _algebra_sql("")),
    "skill_except": (skill_algebra(F.array_except), _algebra_sql("NOT")),
    "doc_job_cross": (doc_job_cross, DOC_JOB),
    "lookup_by_id": (lookup_by_id, LOOKUP),
    "lookup_in_store": (lookup_in_store, LOOKUP_IN_STORE),
    "skill_gap_counts": (skill_gap_counts, SKILL_GAPS),
    "screening_summary": (screening_summary, SCREENING_SUMMARY),
    "score_breakdown": (score_breakdown, SCORE_BREAKDOWN),
    "ranked_table": (ranked_table, RANKED_TABLE),
    "topk_pool": (topk_pool, TOPK_POOL),
    "stratified_pool": (stratified_pool, STRATIFIED_POOL),
    "precision_at_k": (
        _metric(evaluation.precision_at_k, P_COLUMNS, labels=_relabelled, relevant=1), metric_sql(P_COLUMNS, labels=RELABELLED)
    ),
    "ndcg_at_k": (_metric(evaluation.ndcg_at_k, N_COLUMNS), metric_sql(N_COLUMNS)),
    "spearman": (_metric(evaluation.spearman, ["spearman"]), metric_sql(["spearman"])),
    "evaluate_rankings": (evaluate_rankings, metric_sql([*P_COLUMNS, *N_COLUMNS, "spearman"])),
    "evaluate_rankings_semantic": (
        evaluate_rankings_semantic, metric_sql([*P_COLUMNS, *N_COLUMNS, "spearman"], single=True, semantic=True)
    ),
}
