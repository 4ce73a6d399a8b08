"""Choosing which candidates to label next."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import first_rows

POOL_TOP = 40

# ---- fixed values: quota per stratum, filled in this order; the rest comes from anywhere -----
QUOTAS = (("top_skill", 0.3), ("top_tfidf", 0.3), ("relevant", 0.25), ("other", 0.15))

# ---- fixed values: categories taken as relevant by default ----------------------------------
RELEVANT_CATEGORIES = (
    "INFORMATION-TECHNOLOGY", "BUSINESS-DEVELOPMENT", "FINANCE", "ACCOUNTANT", "CONSULTANT",
    "ENGINEERING", "BANKING",
)


def topk_pool(ranked: DataFrame, column: str, k: int = POOL_TOP) -> DataFrame:
    """The ``k`` best of every job by one score, in ranked order on ties."""
    best = first_rows(ranked, ["jd_id"], [F.col(column).desc_nulls_last(), F.col("rank").asc()], k)
    return best.drop("_place")


def draw_order(seed: int, salt: str = "") -> Column:
    """A reproducible random order: the digest of seed and id."""
    return F.md5(F.concat_ws("|", F.lit(f"{seed}{salt}"), F.col("id")))


def stratified_pool(
    ranked: DataFrame, n: int, seed: int = 42, relevant: Sequence[str] = RELEVANT_CATEGORIES
) -> DataFrame:
    """Draw ``n`` ids per job: ``(jd_id, pick, id, stratum)``, no id twice.

    Strata are drawn one after the other and leave out what is already picked. At most ``n`` ids can be, so each stratum needs
    to offer no more than its quota plus ``n``: every row of the ranking says which strata it belongs to, each task cuts
    the offers of each, and one shuffle cuts them again. What is left, at most some ``7 n`` ids a job whatever the size of
    the ranking, meets in one row per job, where the strata are drawn in order.
    """
    quotas = {stratum: round(n * share) for stratum, share in QUOTAS} | {"any": n}
    sizes = {s: quota + n for s, quota in quotas.items()} | {"top_skill": POOL_TOP, "top_tfidf": POOL_TOP}
    draw, no_score = draw_order(seed), F.lit(None).cast("double")
    kind = F.when(F.coalesce(F.col("category").isin(list(relevant)), F.lit(False)), F.lit("relevant")).otherwise(F.lit("other"))

    def offer(stratum: Column, score: Column, order: Column) -> Column:
        return F.struct(stratum.alias("stratum"), score.cast("double").alias("score"), order.alias("order"))

    def within(stratum: str):
        return lambda o: o["stratum"] == stratum

    def named(stratum: str):
        return lambda x: F.struct(x.alias("id"), F.lit(stratum).alias("stratum"))

    nothing = F.lit(None).cast("string")
    offered = ranked.select(
        "jd_id", "id", "rank",
        F.explode(F.array(
            offer(F.lit("top_skill"), F.col("skills_score"), nothing),
            offer(F.lit("top_tfidf"), F.col("tfidf_score"), nothing),
            offer(kind, no_score, draw),
            offer(F.lit("any"), no_score, draw),
        )).alias("_o"),
    ).select("jd_id", "id", "rank", "_o.*")
    best = [F.col("score").desc_nulls_last(), F.col("order").asc(), F.col("rank").asc()]
    cut = first_rows(offered, ["jd_id", "stratum"], best, max(sizes.values()))
    room = reduce(lambda c, s: c.when(F.col("stratum") == s, F.lit(sizes[s])), sizes, F)
    rows = cut.where(F.col("_place") <= room).groupBy("jd_id").agg(
        F.sort_array(F.collect_list(F.struct("stratum", draw.alias("draw"), "rank", "id"))).alias("_all")
    ).withColumn("_picked", F.expr("cast(array() as array<string>)"))
    for i, (stratum, quota) in enumerate(quotas.items()):
        ids = F.transform(F.filter("_all", within(stratum)), lambda o: o["id"])
        # Quotas are rounded and may add up to more than n by one or two; the last cut below sees to that.
        most = F.greatest(F.lit(0), F.lit(quota) - F.size("_picked")) if stratum == "any" else F.lit(quota)
        rows = rows.withColumn(f"_t{i}", F.slice(F.array_except(ids, F.col("_picked")), F.lit(1), most))
        rows = rows.withColumn("_picked", F.concat("_picked", f"_t{i}"))
    taken = [F.transform(f"_t{i}", named(stratum)) for i, stratum in enumerate(quotas)]
    picks = rows.select("jd_id", F.explode(F.concat(*taken)).alias("_p")).select("jd_id", "_p.*")
    shuffled = [draw_order(seed, "shuffle"), F.col("id").asc()]
    pick = F.row_number().over(Window.partitionBy("jd_id").orderBy(*shuffled))
    return picks.withColumn("pick", pick).where(F.col("pick") <= n).select("jd_id", "pick", "id", "stratum")


def unlabelled(pool: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of a pool that nobody has labelled yet."""
    return pool.join(labels.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")
