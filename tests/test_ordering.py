import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators.ordering import first_rows, rank_rows, row_ordinals, running_total
from tests.conftest import plan_of


def test_rank_over_a_hot_group_with_ties(spark):
    """One group has nine of ten rows and half of them share one score."""
    n = 20_000
    rows = spark.range(n, numPartitions=7).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 30).otherwise(F.lit(99)).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.xxhash64("id") % 50).alias("s"),
        "id",
    )
    ranked = rank_rows(rows, ["g"], [F.col("s").desc_nulls_last(), F.col("id").asc()]).collect()
    assert len(ranked) == n
    groups = {}
    for r in ranked:
        groups.setdefault(r.g, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in members] == list(range(1, len(members) + 1))
        assert members == sorted(members, key=lambda r: (-r.s, r.id))


def test_no_task_holds_a_hot_group(spark):
    rows = spark.range(10_000, numPartitions=4).select(F.lit(1).alias("g"), "id")
    from rankloom.operators import ordering

    # Adaptive execution merges partitions of a few kilobytes; not so here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordering._ranged(rows, ["g"], [F.col("id").desc()], "spread").groupBy("_part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(p["count"] for p in parts) < 6_000


def test_rank_puts_null_last(spark):
    rows = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0), (4, None)], "id int, s double").withColumn("g", F.lit("x"))
    got = rank_rows(rows, ["g"], [F.col("s").desc_nulls_last(), F.col("id").asc()]).orderBy("rank").collect()
    assert [r.id for r in got] == [3, 2, 1, 4]


def test_row_ordinals(spark):
    got = row_ordinals(spark.range(1_000, numPartitions=6)).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1_000)) == [r.id for r in got]


def test_running_total(spark):
    values = [(random.Random(i).choice("ab"), i, i % 7) for i in range(500)]
    rows = spark.createDataFrame(values, "g string, k int, v int").repartition(5)
    got = {(r.g, r.k): r.before for r in running_total(rows, ["g"], [F.col("k").asc()], "v", "before").collect()}
    seen = {"a": 0, "b": 0}
    for g, k, v in values:
        assert got[g, k] == seen[g]
        seen[g] += v


def test_first_rows_cuts_before_the_shuffle(spark):
    rows = spark.range(1_000, numPartitions=4).select((F.col("id") % 2).alias("g"), "id")
    best = first_rows(rows, ["g"], [F.col("id").desc()], 3)
    assert sorted(r.id for r in best.collect()) == [994, 995, 996, 997, 998, 999]
    assert plan_of(best).count("WindowGroupLimit") >= 2, plan_of(best)


@pytest.mark.parametrize("n", [1_001, 5_000])
def test_first_rows_cuts_before_the_shuffle_for_any_n(spark, n):
    rows = spark.range(20_000, numPartitions=4).select((F.col("id") % 3 == 0).alias("g"), "id")
    best = first_rows(rows, ["g"], [F.col("id").desc()], n)
    plan = plan_of(best)
    window, cut = plan.index("Window"), plan.index("(_row#")
    assert window < plan.index("Exchange hashpartitioning(g") < cut
    got = {}
    for r in best.collect():
        got.setdefault(r.g, []).append(r.id)
    want = [i for i in range(20_000) if i % 3 == 0]
    assert sorted(got[True]) == want[-n:] and len(got[False]) == n


def test_offsets_do_not_move_the_rows(spark):
    rows = spark.range(3_000, numPartitions=4).select((F.col("id") % 5).alias("g"), "id", F.lit("wide").alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(rank_rows(rows, ["g"], [F.col("id").asc()]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_nothing_to_number(spark):
    none = spark.range(0).select(F.lit(1).alias("g"), "id")
    assert rank_rows(none, ["g"], [F.col("id").asc()]).count() == 0
    assert running_total(none, ["g"], [F.col("id").asc()], "id", "t").count() == 0
