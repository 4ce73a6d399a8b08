"""Ranking again under other weights, from stored components.

The weights of a ranking change far more often than its texts: components are computed once and stored, in two forms.
``rows`` holds every candidate with all components and what is shown of it. ``lists`` holds, for every job and component, the
candidates from the best score down; each entry carries all components of its candidate, so that whoever is met in one
list need not be looked up in the others.

The best ``n`` under any weights are found by the threshold algorithm. All lists are read to the same depth. A candidate met
in none of them scores at most what the last entries read would score together, as the final score never falls when a
component grows; once the n-th best of those met is above that, nobody further down can be among the best. Otherwise the
lists are read deeper. Entries are stored in order with their place, so reading to a depth reads the head of each list.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import scoring
from ..operators.ordering import first_rows, rank_rows
from ..runtime import is_small, materialize, scratch_path
from .screening import RANKING_COLUMNS, explained

# Entries of every list that are read first, per row asked for and at the least; then how much deeper each time.
FIRST_DEPTH, LEAST_DEPTH, DEEPER = 4, 1_000, 8

SCORES = [f"{c}_score" for c in scoring.COMPONENTS]
# Every candidate has this component, so its list reaches all of them whatever the weights are.
ALWAYS = "tfidf"


@dataclass
class ComponentStore:
    rows: DataFrame
    lists: DataFrame


def store_components(scored: DataFrame, path: str | None = None) -> ComponentStore:
    """Store scored candidates (:func:`score_candidates`, :func:`score_for_jobs`), under ``path`` or for this session only."""
    spark = scored.sparkSession
    path = path or scratch_path(spark, "components")
    full = scored if "explanation" in scored.columns else explained(scored)
    shown = [c for c in RANKING_COLUMNS if c not in ("rank", "final_score") and not c.startswith("contrib_")]
    full.select("pos", *shown).write.parquet(f"{path}/rows")
    narrow = spark.read.parquet(f"{path}/rows").select("jd_id", "pos", *SCORES)
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(f"{c}_score").alias("score")) for c in scoring.COMPONENTS]))
    entries = narrow.select("*", entry.alias("e")).select("jd_id", "pos", *SCORES, "e.component", "e.score").where(F.col("score").isNotNull())
    placed = rank_rows(entries, ["component", "jd_id"], [F.col("score").desc(), F.col("pos").asc()], "place")
    # A folder per component; within a file the entries stand by job and place.
    placed.sortWithinPartitions("component", "jd_id", "place").write.partitionBy("component").parquet(f"{path}/lists")
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> ComponentStore:
    rows = spark.read.parquet(f"{path}/rows")
    # Given, as an empty list has no files to infer it from.
    entry = StructType([rows.schema[c] for c in ("jd_id", "pos", *SCORES)]).add("score", "double").add("place", "long").add("component", "string")
    return ComponentStore(rows, spark.read.schema(entry).parquet(f"{path}/lists"))


def _final(rows: DataFrame, weights: Mapping[str, float] | None) -> DataFrame:
    return scoring.with_final_score(scoring.with_weights(rows, weights))


def _listed(store: ComponentStore, weights: Mapping[str, float] | None) -> DataFrame:
    used = [c for c, w in scoring.merge_weights(weights).items() if w > 0 or c == ALWAYS]
    return store.lists.where(F.col("component").isin(used))


def candidates_met(store: ComponentStore, n: int, weights: Mapping[str, float] | None = None) -> tuple[DataFrame, int]:
    """The ``n`` best candidates of every job ``(jd_id, pos, components, final_score, _place)``, and how deep the lists were read."""
    lists = _listed(store, weights)
    depth = max(FIRST_DEPTH * n, LEAST_DEPTH)
    while True:
        head = lists.where(F.col("place") <= depth)
        met = _final(head.select("jd_id", "pos", *SCORES).dropDuplicates(["jd_id", "pos"]), weights)
        best = materialize(first_rows(met, ["jd_id"], scoring.rank_order(), n), "best")
        # What somebody who is met nowhere has at most: the last score read of every list, none where the job has no such list.
        ends = head.groupBy("jd_id").agg(
            *[F.min(F.when(F.col("component") == c, F.col("score"))).alias(f"{c}_score") for c in scoring.COMPONENTS],
            F.max(F.when(F.col("component") == ALWAYS, F.col("place"))).alias("reached"),
        )
        bound = _final(ends, weights).select("jd_id", "reached", F.col("final_score").alias("bound"))
        last = best.groupBy("jd_id").agg(F.min("final_score").alias("worst"), F.count(F.lit(1)).alias("held"))
        # At equal scores somebody further down could still win by the order among equals.
        more = bound.join(last, "jd_id").where((F.col("reached") >= depth) & ((F.col("held") < n) | (F.col("worst") <= F.col("bound"))))
        if more.isEmpty():
            return best, depth
        depth *= DEEPER


def top_reweighted(store: ComponentStore, n: int, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The first ``n`` rows of every job's ranking under ``weights``, in the columns of a ranking."""
    best, _ = candidates_met(store, n, weights)
    extra = ["final_score", *(f"contrib_{c}" for c in scoring.COMPONENTS)]
    chosen = best.select("jd_id", "pos", F.col("_place").alias("rank"), *extra)
    few = F.broadcast(chosen) if is_small(chosen) else chosen
    return store.rows.join(few, ["jd_id", "pos"]).select(*RANKING_COLUMNS)


def rank_reweighted(store: ComponentStore, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The full ranking under ``weights``. Only keys and scores are sorted; what is shown is joined to the ranks."""
    keys = _final(store.rows.select("jd_id", "pos", *SCORES), weights)
    extra = ["final_score", *(f"contrib_{c}" for c in scoring.COMPONENTS)]
    ranks = rank_rows(keys.select("jd_id", "pos", "skills_score", *extra), ["jd_id"], scoring.rank_order())
    return store.rows.join(ranks.drop("skills_score"), ["jd_id", "pos"]).select(*RANKING_COLUMNS)
