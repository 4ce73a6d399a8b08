"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, with DataFrame functions only.

Every source's documents are permuted by a seeded hash and cut into disjoint blocks of about ``block_words`` words. A
source whose target is r times its size is drawn floor(r) times in full and once more up to the rest, block by block in
a permuted order; of the last block, those documents are taken that fit. The exact block quotas of all sources are then split down a
binary tree: a node hands half of its draws to its left child, and how many of each source those are is drawn from the
multivariate hypergeometric distribution. The leaves are the output shards. Shard by shard, the sources' draws are
dealt out as disjoint runs of the permuted blocks, and a shard's documents are ordered by a hash.

Only the table of sources meets in one row (one entry per source); the block table is joined by source and block, and is
broadcast only after its rows were counted. All draws come from hashes of the seed, so reruns agree.

Defined results. A null text has size 0. The null source is a source, ordered last. Sources of size 0 have target 0.
Rows that agree in doc_id, source and text are drawn together. Empty documents go where their block goes. An empty
table gives an empty result. Other columns are carried, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.common import WORD, table, text_or_empty
from rankloom.runtime import attach, is_small, materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 100_000
LEVELS = 5
SEED = 20


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Every row whole in ``_row``, with its source as a key that is never null, its size and its place in the permutation."""
    source = F.col("source").cast("string")
    text = text_or_empty()
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        source.alias("_source"),
        F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), source, F.crc32(text.cast("binary"))).alias("_place"),
    )


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row per source (``_source``, ``_key``, ``source_size``).

    Weighted shares that stop at ``most`` times the size end up as min(cap, level * weight): the sources in order of
    cap / weight, and the level is what is left over the weights left at the first source below its cap.
    """
    everything = W.partitionBy(F.lit(0))
    by_source = everything.orderBy(F.col("_source").asc_nulls_last())
    by_cap = everything.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_source) - 1) % len(weights) + 1)
    with_caps = sizes.select("*", weight.alias("_weight"), (F.col("source_size") * float(most)).alias("_cap"))
    total = F.sum("source_size").over(everything) * share
    before = F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_weight").over(by_cap.rowsBetween(0, W.unboundedFollowing))
    levelled = with_caps.select(
        "*", ((total - before) / left).alias("_level"), F.row_number().over(by_cap).alias("_nth")
    ).withColumn("_below", F.col("_cap") > F.col("_level") * F.col("_weight"))
    level = F.min_by(F.col("_level"), F.when(F.col("_below"), F.col("_nth"))).over(everything)
    first_below = F.min(F.when(F.col("_below"), F.col("_nth"))).over(everything)
    target = F.when(first_below.isNull() | (F.col("_nth") < first_below), F.col("_cap")).otherwise(level * F.col("_weight"))
    return levelled.select(*sizes.columns, target.alias("target"))


def _uniform(*parts) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _let(then, **values: Column) -> Column:
    """``then`` of a struct of ``values``, each computed once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), then)[0]


def _hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """A hypergeometric variate by inversion, walking the probabilities up and then down from the mode.

    Ten standard deviations hold all but 1e-22 of the mass, far less than the last bit of ``u``.
    """

    def bounds(v: Column) -> Column:
        n, k, m = v["n"], v["k"], v["m"]
        lowest, highest = F.greatest(F.lit(0.0), m - (n - k)), F.least(m, k)
        mode = F.least(highest, F.greatest(lowest, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
        spread = F.sqrt(F.greatest(F.lit(0.0), m * k / n * (1 - k / n) * (n - m) / F.greatest(F.lit(1.0), n - 1)))
        more = {"lowest": lowest, "highest": highest, "mode": mode, "reach": F.ceil(10 * spread + 10).cast("double")}
        return _let(invert, **{c: v[c] for c in ("n", "k", "m", "u")}, **more)

    def invert(v: Column) -> Column:
        up, down = F.least(v["highest"] - v["mode"], v["reach"]).cast("int"), F.least(v["mode"] - v["lowest"], v["reach"]).cast("int")
        return _let(walk, **{c: v[c] for c in ("n", "k", "m", "u", "mode")}, up=up, steps=F.sequence(F.lit(0), up + down))

    def walk(v: Column) -> Column:
        n, k, m, mode, up = (v[c] for c in ("n", "k", "m", "mode", "up"))

        def following(w: Column, t: Column) -> Column:
            """The weight after that of step t, the mode's being 1: up to the top, then down from the mode."""
            high, low = mode + t, mode - (t - up)
            risen = w * (k - high) * (m - high) / ((high + 1) * (n - k - m + high + 1))
            fallen = F.when(t == up, F.lit(1.0)).otherwise(w) * low * (n - k - m + low) / ((k - low + 1) * (m - low + 1))
            return F.when(t < up, risen).otherwise(fallen)

        def add(s: Column, t: Column) -> Column:
            return F.struct(following(s["w"], t).alias("w"), (s["sum"] + s["w"]).alias("sum"))

        def pick(s: Column, t: Column) -> Column:
            here = F.when(t <= up, mode + t).otherwise(mode - (t - up))
            hit = s["x"].isNull() & (s["rest"] <= s["w"])
            return F.struct(
                following(s["w"], t).alias("w"), (s["rest"] - s["w"]).alias("rest"), F.when(hit, here).otherwise(s["x"]).alias("x")
            )

        total = F.aggregate(v["steps"], F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), add, lambda s: s["sum"])
        begin = F.struct(F.lit(1.0).alias("w"), (v["u"] * total).alias("rest"), F.lit(None).cast("double").alias("x"))
        # Rounding can leave a rest beyond the last weight; the mode is then as good a value as any.
        return F.coalesce(F.aggregate(v["steps"], begin, pick, lambda s: s["x"]), mode)

    n, k, m = (c.cast("double") for c in (population, marked, draws))
    drawn = _let(bounds, n=n, k=k, m=m, u=u)
    return F.when((n <= 0) | (k <= 0) | (m <= 0), F.lit(0)).when(m >= n, k).otherwise(drawn).cast("long")


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """One row per source (``_key``, ``quota``) becomes one row per source with ``ends``: for each of the 2**levels
    output shards, the end of its run among the source's draws."""
    together = F.array_sort(F.collect_list(F.struct("_key", "quota")))
    nodes = quotas.groupBy().agg(together.alias("all")).where(F.size("all") > 0).select(
        F.lit(0).cast("long").alias("node"), F.col("all._key").alias("keys"), F.col("all.quota").alias("counts")
    )
    for level in range(levels):
        whole = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
        start = F.struct(
            whole.alias("n"), F.floor(whole / 2).cast("long").alias("m"), F.expr("cast(array() as array<bigint>)").alias("left")
        )

        def child(s: Column, c: Column) -> Column:
            u = _uniform(F.lit(seed), F.lit(level), F.col("node"), F.size(s["left"]))

            def after(y: Column) -> Column:
                left = F.concat(s["left"], F.array(y["x"]))
                return F.struct((s["n"] - c).alias("n"), (s["m"] - y["x"]).alias("m"), left.alias("left"))

            return _let(after, x=_hypergeometric(s["n"], c, s["m"], u))

        halves = nodes.repartition(1 << level, "node").select("node", "keys", "counts", F.aggregate("counts", start, child, lambda s: s["left"]).alias("left"))
        right = F.zip_with("counts", "left", lambda c, x: c - x)
        nodes = materialize(
            halves.select(
                "keys",
                F.explode(
                    F.array(
                        F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
                        F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("counts")),
                    )
                ).alias("_half"),
            ).select("_half.node", "keys", "_half.counts"),
            "mix-nodes",
        )
    pairs = nodes.select("node", F.explode(F.arrays_zip("keys", "counts")).alias("_c")).select(
        "node", F.col("_c.keys").alias("_key"), F.col("_c.counts").alias("draws")
    )
    upto = F.sum("draws").over(W.partitionBy("_key").orderBy("node"))
    return pairs.select("_key", F.struct("node", upto.alias("end")).alias("_e")).groupBy("_key").agg(
        F.array_sort(F.collect_list("_e"))["end"].alias("ends")
    )


def _plan(keyed: DataFrame, block_words: int, levels: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the draws of every block: epoch, output shard, and the places taken if not all."""
    rows = materialize(keyed.select("_key", "_source", "_size", "_place"), "mix-rows")
    sizes = rows.groupBy("_key", "_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long")
    sources = materialize(
        targets(sizes)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil((F.col("source_size") + 64 * F.col("_n")) / block_words)).cast("long"))
        .coalesce(1),
        "mix-sources",
    )
    small = is_small(sources)
    placed = _with_block(rows, sources, small)
    words = placed.groupBy("_key", "_block").agg(F.sum("_size").alias("words"))
    epochs = words.join(sources.select("_key", "whole", "rest", "blocks"), "_key").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))
    )
    permuted = W.partitionBy("_key", "epoch").orderBy(F.xxhash64(F.lit(seed), "_key", "epoch", "_block"), "_block")
    before = F.coalesce(F.sum("words").over(permuted.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    draws = materialize(
        epochs.withColumn("before", before)
        .withColumn("nth", (F.row_number().over(permuted) - 1 + F.col("epoch") * F.col("blocks")).cast("long"))
        .withColumn("_room", F.when(F.col("epoch") == F.col("whole"), F.col("rest") - F.col("before")))
        .where("_room is null or _room > 0.5")
        .select("_key", "_block", "epoch", "nth", F.when(F.col("_room") < F.col("words"), F.col("_room")).alias("room")),
        "mix-draws",
    )
    # Of the block that is cut, documents go if they fit in what room is left, large ones first.
    cut = placed.where("_size > 0").join(draws.where("room is not null").select("_key", "_block", "room"), ["_key", "_block"])

    def fit(state: Column, d: Column) -> Column:
        fits = d["_size"] <= state["room"]
        return F.struct(
            F.when(fits, state["room"] - d["_size"]).otherwise(state["room"]).alias("room"),
            F.when(fits, F.concat(state["in"], F.array(d["_place"]))).otherwise(state["in"]).alias("in"),
        )

    fitted = F.aggregate(
        "_docs", F.struct(F.col("room").alias("room"), F.expr("cast(array() as array<bigint>)").alias("in")), fit, lambda s: s["in"]
    )
    some = (
        cut.groupBy("_key", "_block", "room")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_size")).alias("_less"), "_place", "_size"))).alias("_docs"))
        .select("_key", "_block", fitted.alias("some"))
    )
    ends = split_quotas(draws.groupBy("_key").agg(F.count(F.lit(1)).alias("quota")), levels, seed)
    shard = F.size(F.filter("ends", lambda e: e <= F.col("nth")))
    dealt = (
        draws.join(ends, "_key")
        .join(some, ["_key", "_block"], "left")
        .select(
            "_key", "_block",
            F.struct("epoch", shard.alias("shard"), F.when(F.col("room").isNotNull(), F.coalesce("some", F.expr("cast(array() as array<bigint>)"))).alias("some")).alias("_draw"),
        )
        .groupBy("_key", "_block")
        .agg(F.array_sort(F.collect_list("_draw")).alias("_draws"))
    )
    return sources, materialize(dealt, "mix-dealt")


def _with_block(rows: DataFrame, sources: DataFrame, small: bool, *more: str) -> DataFrame:
    with_blocks = attach(rows, sources.select("_key", "blocks", *more), "_key", F.col("_place"), small)
    block = F.pmod(F.shiftrightunsigned("_place", 8), F.col("blocks"))
    return with_blocks.withColumn("_block", block).drop("blocks")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """One row per document: ``_row`` (all its columns), ``_size``, ``source_size``, ``target`` and ``_taken``, its draws
    as an array of epoch and output shard."""
    keyed = _keyed(docs, seed)
    sources, dealt = _plan(keyed, block_words, levels, seed)
    placed = _with_block(keyed, sources, is_small(sources), "source_size", "target")
    joined = placed.join(F.broadcast(dealt) if is_small(dealt) else dealt, ["_key", "_block"], "left")
    taken = F.filter(
        F.coalesce("_draws", F.expr("cast(array() as array<struct<epoch:bigint,shard:int,some:array<bigint>>>)")),
        lambda d: d["some"].isNull() | F.array_contains(d["some"], F.col("_place")),
    )
    return joined.select("_row", "_place", "_size", "source_size", "target", taken.alias("_taken"))


def mixed_documents(docs: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """The drawn documents, repeated as often as drawn, shard by shard in shuffled order, with the columns of ``docs``."""
    drawn = mix(docs, levels=levels, seed=seed).select("_row", "_place", F.explode("_taken").alias("_d"))
    order = F.xxhash64(F.lit(seed), F.col("_d.shard"), F.col("_d.epoch"), F.col("_place"))
    return drawn.repartition(1 << levels, "_d.shard").sortWithinPartitions("_d.shard", order).select("_row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.size("_taken")).alias("taken"),
        F.col("_taken.shard").alias("shards"),
    )


QUERIES = {"op8_mixing": (op8_mixing, None)}
