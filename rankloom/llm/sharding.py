"""Sharding by fixed virtual slots, with DataFrame functions only.

Records are hashed into a fixed number of virtual slots. Bytes are added up per slot, and a versioned table maps slots
to shards. Version 1 deals slots out in turn; rebalancing writes a next version, in which a slot stays in its shard
while that shard has room and goes to the emptiest shard otherwise. Records never move between slots.

The map has one row per virtual slot, so its size is a constant of the operator, whatever the data hold; it may be
broadcast and folded in one expression. Which shard a record gets follows the byte law: shards come out nearly equal.

Defined results. A null text has 0 bytes, and every record 16 more. A record is hashed by ``doc_id`` and the CRC-32 of
its text, so neither a null ``doc_id`` nor a group of copies lies in one slot. Rows that agree in both lie in one slot
and differ in position. Empty slots are in the map too. An empty table gives an empty result and an evenly dealt map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.common import table
from rankloom.runtime import materialize

VIRTUAL_SLOTS = 8192
SHARDS = 40
OVERHEAD = 16


def records(docs: DataFrame, virtual_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """One narrow row per document: doc_id, size, text_crc32 and its virtual slot."""
    text = F.col("text").cast("string")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), crc), F.lit(virtual_slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(rows: DataFrame, virtual_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Bytes and records of every virtual slot, empty ones too."""
    spark = rows.sparkSession
    filled = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    every = spark.range(virtual_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(filled), "virtual_slot", "left").na.fill(0, ["bytes", "n"])


def first_map(spark: SparkSession, shards: int = SHARDS, virtual_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    slot = F.col("id").cast("int")
    return spark.range(virtual_slots).select(
        F.lit(1).alias("version"), slot.alias("virtual_slot"), (slot % shards).cast("int").alias("shard")
    )


def _argmin(values: Column) -> Column:
    return F.array_position(values, F.array_min(values)).cast("int") - 1


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of ``slot_map`` (all versions, latest edited) for the measured loads.

    Slots come largest first. Each stays in its shard if that does not lift the shard over the mean, and else goes to
    the shard with the fewest bytes so far. ``shards`` may differ from the map's: slots of shards that are gone move.
    """
    latest = slot_map.withColumn("_last", F.max("version").over(W.partitionBy(F.lit(0)))).where("version = _last")
    by_size = F.array_sort(
        F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard"))
    )
    one = latest.join(F.broadcast(loads), "virtual_slot").groupBy("version").agg(
        by_size.alias("slots"), (F.sum("bytes") / shards).alias("mean")
    )

    def place(state: Column, slot: Column) -> Column:
        own = F.try_element_at(state["loads"], slot["shard"] + 1)
        fits = (slot["shard"] < shards) & (own - slot["less"] <= F.col("mean"))
        to = F.when(F.coalesce(fits, F.lit(False)), slot["shard"]).otherwise(_argmin(state["loads"]))
        return F.struct(
            F.transform(state["loads"], lambda x, i: F.when(i == to, x - slot["less"]).otherwise(x)).alias("loads"),
            F.concat(state["placed"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), to.alias("shard")))).alias("placed"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("placed"),
    )
    edited = one.select(
        (F.col("version") + 1).alias("version"),
        F.explode(F.aggregate("slots", start, place, lambda s: s["placed"])).alias("_p"),
    ).select("version", "_p.virtual_slot", "_p.shard")
    return slot_map.select("version", "virtual_slot", "shard").unionByName(edited)


def assign(rows: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Add ``shard`` by the latest version and ``slot``, the gapless position of a record in its shard.

    Positions are counted within each virtual slot; the slots of a shard follow one another, so no shard is ever
    numbered in one task.
    """
    in_slot = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32")
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    latest = slot_map.withColumn("_last", F.max("version").over(W.partitionBy(F.lit(0)))).where("version = _last")
    places = latest.join(F.broadcast(loads), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("_before")
    )
    return (
        rows.withColumn("_at", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(places), "virtual_slot")
        .withColumn("slot", (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_before", "_at")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, virtual_slots: int = VIRTUAL_SLOTS) -> tuple[DataFrame, DataFrame]:
    """The sharded records and the stored map with both versions."""
    rows = materialize(records(docs, virtual_slots), "slot-records")
    loads = materialize(slot_loads(rows, virtual_slots).coalesce(1), "slot-loads")
    slot_map = materialize(
        rebalance(first_map(docs.sparkSession, shards, virtual_slots), loads, shards).coalesce(1), "slot-map"
    )
    return assign(rows, slot_map, loads), slot_map


def op6_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded, _ = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


QUERIES = {"op6_virtual_slot_sharding": (op6_virtual_slot_sharding, None)}
