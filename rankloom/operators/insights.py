"""Reports on a ranking: summary, table, gaps, breakdown, categories, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import DEFAULT_VOCABULARY, Vocabulary, lookup_table
from ..runtime import is_light
from .scoring import COMPONENTS

TABLE_COLUMNS = (
    "jd_id", "rank", "id", "category", "final_score", "skills_score", "tfidf_score", "semantic_score",
    "experience_years", "education", "explanation",
)


def top_n(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.where(F.col("rank") <= n)


def screening_summary(ranked: DataFrame, jobs: DataFrame) -> DataFrame:
    """Per job: candidates screened, required skills, years asked for, best score."""
    per_job = ranked.groupBy("jd_id").agg(
        F.count(F.lit(1)).alias("candidates"), F.max("final_score").alias("top_score")
    )
    facts = jobs.select("jd_id", F.size("required").alias("required_skills"), "min_years")
    return per_job.join(facts, "jd_id").select("jd_id", "candidates", "required_skills", "min_years", "top_score")


def ranked_table(ranked: DataFrame, digits: int = 2) -> DataFrame:
    """The columns people read, numbers rounded half to even."""
    numeric = {name for name, kind in ranked.dtypes if kind == "double"}
    return ranked.select(
        *(
            F.bround(c, digits).alias(c) if c in numeric else F.col(c)
            for c in TABLE_COLUMNS
            if c in ranked.columns
        )
    )


def skill_gap_counts(ranked: DataFrame, n: int) -> DataFrame:
    """How many of the first ``n`` miss each required skill."""
    missing = F.explode(F.split("missing_required", ", ")).alias("skill")
    return (
        top_n(ranked, n).select("jd_id", missing).where("skill <> ''")
        .groupBy("jd_id", "skill").agg(F.count(F.lit(1)).alias("missing"))
    )


def score_breakdown(ranked: DataFrame, n: int) -> DataFrame:
    """Contributions of the first ``n`` as rows ``(jd_id, rank, id, component, contribution)``."""
    columns = [F.col(f"contrib_{c}").alias(c) for c in COMPONENTS]
    wide = top_n(ranked, n).select("jd_id", "rank", "id", *columns)
    long = wide.unpivot(["jd_id", "rank", "id"], list(COMPONENTS), "component", "contribution")
    return long.where(F.col("contribution").isNotNull())


def skill_category_rollup(featured: DataFrame, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """Per skill category: mentions, and documents with at least one. Counted per document first."""
    table = lookup_table(vocab.category_of)
    category = F.transform("skills", lambda s: F.element_at(table, s))
    rows = featured.select(category.alias("categories")).select(
        "categories", F.explode(F.array_distinct("categories")).alias("category")
    )
    mentions = F.size(F.filter("categories", lambda c: c == F.col("category")))
    return rows.groupBy("category").agg(
        F.sum(mentions).alias("mentions"), F.count(F.lit(1)).alias("documents")
    )


def split_by_category(rows: DataFrame, relevant: DataFrame, relevant_rows: bool = True) -> DataFrame:
    """Rows whose category is, or is not, in the one-column table ``relevant``. NULL is not."""
    how = "left_semi" if relevant_rows else "left_anti"
    names = relevant.select("category").distinct()
    return rows.join(F.broadcast(names) if is_light(names) else names, "category", how)


def lookup_by_id(rows: DataFrame, ids: Column | str | list[str]) -> DataFrame:
    """The rows of the chosen ids. On a store of ``sinks.write_documents`` the scan skips what cannot hold them.

    A list of up to ten ids reaches the files id by id, a longer one by its least and largest id only.
    """
    wanted = [ids] if isinstance(ids, str) else ids
    return rows.where(F.col("id").isin(wanted))


def texts_of(chosen: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the text to a handful of chosen ids, however many documents there are."""
    return documents.join(F.broadcast(chosen) if is_light(chosen) else chosen, "id", "inner")


