"""Files in, ranking and evaluation out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.evaluation import evaluate_rankings
from ..operators.pools import stratified_pool, unlabelled
from ..runtime import materialize
from ..sources.readers import load_csv, load_folder, load_jobs, load_labels
from ..sources.sinks import write_ranking
from .screening import in_one_pool, rank_candidates


def load_documents(spark: SparkSession, source: str, redact: bool = True) -> DataFrame:
    """A CSV file or a folder of text files, loaded once and kept as a table."""
    load = load_csv if source.lower().endswith(".csv") else load_folder
    return materialize(load(spark, source, redact), "documents")


def rank_files(
    spark: SparkSession, job: str, documents: str, current_year: int, out: str | None = None,
    labels: str | None = None, **options,
) -> tuple[DataFrame, DataFrame | None]:
    """Rank a collection for the job description in one file; evaluate it where labels are given."""
    jobs = load_jobs(spark, job)
    found = [r.jd_id for r in jobs.select("jd_id").limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"{job} must be one job description, but holds {found or 'none'}{' or more' * (len(found) > 2)}")
    name = found[0]
    ranked = rank_candidates(in_one_pool(load_documents(spark, documents), name), jobs, current_year, **options)
    if out:
        write_ranking(ranked, out)
    return ranked, evaluate_rankings(ranked, load_labels(spark, labels)) if labels else None


def labelling_pool(ranked: DataFrame, labels: DataFrame, n: int, **options) -> DataFrame:
    """Who to label next: a fresh draw minus what is labelled."""
    return unlabelled(stratified_pool(ranked, n, **options), labels)
