"""Ranking quality against labels: Precision@K, NDCG@K, Spearman.

Everything is computed from counts per distinct score, so neither a large tie nor a large pool ends
up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .ordering import first_rows, running_total

SCORE_COLUMNS = ("final_score", "skills_score", "tfidf_score", "semantic_score")
KS = (3, 5, 10)
RELEVANT = 2

_BY = ["jd_id", "method"]


def join_labels(ranked: DataFrame, labels: DataFrame) -> DataFrame:
    """Ranked rows that have a label. Ids meet as text; repeated ids give one row per pair.

    ``label_pos`` is the place of the label in its store: the column ``pos`` of ``labels`` where there is one
    (:func:`rankloom.sources.readers.load_labels` gives it), else the order in which they are read.
    """
    place = F.col("pos") if "pos" in labels.columns else F.monotonically_increasing_id()
    tags = labels.select(F.col("id").cast("string").alias("id"), F.col("label"), place.alias("label_pos"))
    return ranked.withColumn("id", F.col("id").cast("string")).join(tags, "id", "inner")


def scores_by_method(labelled: DataFrame, score_columns: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """One row per method and labelled candidate: ``(jd_id, method, rank, label, label_pos, score, scored)``.

    A missing score counts as 0; ``scored`` remembers that it was there.
    """
    present = [c for c in score_columns if c in labelled.columns]
    pairs = F.array(
        *(
            F.struct(F.lit(c.replace("_score", "")).alias("method"), F.col(c).cast("double").alias("raw"))
            for c in present
        )
    )
    columns = ["jd_id", "rank", F.col("label").cast("double"), "label_pos"]
    return labelled.select(*columns, F.explode(pairs).alias("m")).select(
        "jd_id",
        "m.method",
        "rank",
        "label",
        "label_pos",
        F.coalesce("m.raw", F.lit(0.0)).alias("score"),
        F.col("m.raw").isNotNull().alias("scored"),
    )


def precision_at_k(scores: DataFrame, ks: Sequence[int] = KS, relevant: float = RELEVANT) -> DataFrame:
    """Share of relevant rows among the first k, ties in ranked order; labels of one id in the order of their store."""
    top = first_rows(scores, _BY, [F.col("score").desc(), F.col("rank").asc(), F.col("label_pos").asc()], max(ks))
    hit = (F.col("label") >= relevant).cast("double")
    return top.groupBy(*_BY).agg(*(F.avg(F.when(F.col("_place") <= k, hit)).alias(f"p_at_{k}") for k in ks))


def _gain(counts: DataFrame, by: Sequence[str], level: str, ks: Sequence[int], prefix: str) -> DataFrame:
    """Discounted gain of rows ordered by ``level``; rows on one level share their mean gain.

    ``counts`` has ``n`` rows and their ``gain`` per level. Every level holds a row or more, so the
    best max(k) levels are all that can reach the first k places.
    """
    top = first_rows(counts, by, [F.col(level).desc()], max(ks))
    earlier = Window.partitionBy(*by).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = top.withColumn("_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    discounts = F.array(*map(F.lit, accumulate((1 / log2(i + 2) for i in range(max(ks))), initial=0.0)))

    def upto(place: Column, k: int) -> Column:
        return F.element_at(discounts, (F.least(place, F.lit(k)) + 1).cast("int"))

    def share(k: int) -> Column:
        return F.col("gain") / F.col("n") * (upto(F.col("_start") + F.col("n"), k) - upto(F.col("_start"), k))

    return placed.groupBy(*by).agg(*(F.sum(share(k)).alias(f"{prefix}{k}") for k in ks))


def ndcg_at_k(scores: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Linear gain, log2 discount; 0 without any gain, NULL for a single document."""
    by_score = scores.groupBy(*_BY, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("gain"))
    by_label = scores.groupBy(*_BY, "label").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("gain"))
    sizes = scores.groupBy(*_BY).agg(F.count(F.lit(1)).alias("n"))
    both = _gain(by_score, _BY, "score", ks, "_dcg").join(_gain(by_label, _BY, "label", ks, "_best"), _BY)
    ratio = {
        k: F.when(F.col("n") < 2, None)
        .when(F.col(f"_best{k}") > 0, F.col(f"_dcg{k}") / F.col(f"_best{k}"))
        .otherwise(0.0)
        for k in ks
    }
    return both.join(sizes, _BY).select(*_BY, *(ratio[k].alias(f"ndcg_at_{k}") for k in ks))


def _mean_ranks(counts: DataFrame, level: str, name: str) -> DataFrame:
    """Average rank of every level: the rows before it plus half of its own."""
    return running_total(counts, _BY, [F.col(level).asc()], "n", "_before").withColumn(
        name, F.col("_before") + (F.col("n") + 1) / 2
    )


def spearman(scores: DataFrame) -> DataFrame:
    """Correlation of average ranks; NULL if scores or labels are constant."""
    cells = materialize(
        scores.groupBy(*_BY, "score", "label").agg(F.count(F.lit(1)).alias("c")), "score-label-counts"
    )
    of_score = _mean_ranks(cells.groupBy(*_BY, "score").agg(F.sum("c").alias("n")), "score", "rs")
    of_label = _mean_ranks(cells.groupBy(*_BY, "label").agg(F.sum("c").alias("n")), "label", "rl")
    ranked = cells.join(of_score.select(*_BY, "score", "rs"), [*_BY, "score"]).join(
        of_label.select(*_BY, "label", "rl"), [*_BY, "label"]
    )
    c, rs, rl = F.col("c"), F.col("rs"), F.col("rl")
    moments = ranked.groupBy(*_BY).agg(
        F.sum(c).alias("n"), F.sum(c * rs * rl).alias("sl"), F.sum(c * rs * rs).alias("ss"), F.sum(c * rl * rl).alias("ll")
    )
    # The ranks 1..n have the same mean whatever the ties.
    offset = F.col("n") * ((F.col("n") + 1) / 2) * ((F.col("n") + 1) / 2)
    spread = (F.col("ss") - offset) * (F.col("ll") - offset)
    return moments.select(*_BY, F.when(spread > 0, (F.col("sl") - offset) / F.sqrt(spread)).alias("spearman"))


def evaluate_rankings(
    ranked: DataFrame,
    labels: DataFrame,
    ks: Sequence[int] = KS,
    relevant: float = RELEVANT,
    score_columns: Sequence[str] = SCORE_COLUMNS,
    digits: int = 3,
) -> DataFrame:
    """``(jd_id, method, p_at_*, ndcg_at_*, spearman)``; methods without any score are left out."""
    needed = ["jd_id", "id", "rank", *(c for c in score_columns if c in ranked.columns)]
    scores = materialize(scores_by_method(join_labels(ranked.select(*needed), labels), score_columns), "labelled-scores")
    n, labelled, lowest = scores.agg(F.count(F.lit(1)), F.count("label"), F.min("label")).first()
    if not n:
        raise ValueError("no ranked id has a label")
    if labelled < n:
        raise ValueError("labels must not be missing")
    if lowest is not None and lowest < 0:
        raise ValueError("labels must not be negative")

    used = scores.groupBy(*_BY).agg(F.max("scored").alias("_used")).where("_used").drop("_used")
    metrics = (
        used.join(precision_at_k(scores, ks, relevant), _BY)
        .join(ndcg_at_k(scores, ks), _BY)
        .join(spearman(scores), _BY)
    )
    figures = [*(f"p_at_{k}" for k in ks), *(f"ndcg_at_{k}" for k in ks), "spearman"]
    return metrics.select(*_BY, *(F.bround(c, digits).alias(c) for c in figures))
