import zlib

from pyspark.sql import functions as F

from rankloom.llm.sharding import first_map, op6_virtual_slot_sharding, rebalance, shard_documents, slot_loads
from tests.conftest import SF, plan_of


def test_law_of_bytes_and_gapless_positions(spark):
    df = op6_virtual_slot_sharding(spark, SF)
    plan = plan_of(df)
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    rows = df.collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    loads, places = {}, {}
    for r in rows:
        assert r["size"] == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        loads[r.shard] = loads.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(r["size"] for r in rows)
    assert max(loads.values()) <= sum(loads.values()) / 40 + largest


def test_awkward_rows(documents, nothing):
    rows, slot_map = shard_documents(documents, shards=3, virtual_slots=16)
    got = rows.collect()
    assert len(got) == documents.count()
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert slot_map.groupBy("version").count().orderBy("version").collect() == [(1, 16), (2, 16)]
    rows, slot_map = shard_documents(nothing, shards=3, virtual_slots=16)
    assert rows.count() == 0 and slot_map.where("version = 2").count() == 16


def test_rebalancing_moves_only_what_does_not_fit(spark):
    rows = spark.range(1000).select((F.col("id") % 64).cast("int").alias("virtual_slot"), F.lit(10).cast("long").alias("size"))
    loads = slot_loads(rows, 64)
    even = rebalance(first_map(spark, 4, 64), loads, 4)
    moved = even.where("version = 1").join(even.where("version = 2").withColumnRenamed("shard", "to"), "virtual_slot").where("shard <> to")
    assert moved.count() <= 8
    fewer = rebalance(even, loads, 3)
    by_shard = fewer.where("version = 3").join(loads, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()
    assert len(by_shard) == 3 and max(r.b for r in by_shard) - min(r.b for r in by_shard) <= 160
