"""Approximate nearest neighbours on robust-pruned directed graphs.

Distinct vectors are dealt into shards by a hash. In each shard a graph is grown: points are inserted in batches, a
greedy search on the graph so far proposes neighbours, and pruning keeps a proposal only if no kept neighbour is nearer to
it by the relaxation factor, so that edges stay diverse; reverse edges are added and pruned alike. Every query walks
every shard's graph with a beam, and the shards' nearest are merged.

Nearness is the largest inner product. The graph is grown on directions, so that short vectors are met from long ones that
point the same way; then every point, taken as a query, gets edges to the largest inner products found for it. Searches
enter at the longest vectors and at the middle. Candidates found are scored anew in double precision on the original vectors.
Points are put in order before a graph is grown: the order in which rows arrive changes nothing.

Equal vectors are one point that carries its smallest ids: a query returns ``k`` rows, so ``k`` + 1 ids are enough for an
exact result, and a vector that a third of all rows share is still one point. Queries come in blocks, so that a
task holds one shard and one block, both of bounded size; the graphs are a stored table.

Defined results. Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows
without an id. Vectors meet only vectors of their own length. Repeated rows count once; rows with one id and different
vectors are asked as one query, nearest to any of them, and are never candidates of each other. Ties go to the smaller id. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.common import table
from rankloom.runtime import materialize

K = 20
DEGREE, STRONG, ENTRIES = 32, 16, 32
BUILD_BEAM, BEAM = 64, 160
RELAX = 1.2
LEAST_SHARDS, SHARD_POINTS = 8, 100_000
QUERY_BLOCK = 50_000
MOST_CELLS = 1 << 25


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors in single precision, all divided by their largest component: the order of inner products stays."""
    return (x / np.abs(x).max()).astype(np.float32)


def directions(x: np.ndarray) -> np.ndarray:
    """Each vector at length 1, in single precision."""
    x = x / np.abs(x).max(1, keepdims=True)
    return (x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ids (-1: none) and negated inner products of the ``width`` best points met, best first."""
    n, b, e = len(x), len(q), len(entries)
    width = max(width, e)
    ids, far = np.full((b, width), -1, np.int64), np.full((b, width), np.inf, np.float32)
    done = np.zeros((b, width), bool)
    met = np.zeros((b, n), bool)
    ids[:, :e], far[:, :e], met[:, entries] = entries, -(q @ x[entries].T), True
    live = np.arange(b)
    while len(live):
        open_ = np.where(done[live], np.inf, far[live])
        pick = open_.argmin(1)
        more = np.isfinite(open_[np.arange(len(live)), pick])
        live, pick = live[more], pick[more]
        if not len(live):
            break
        done[live, pick] = True
        near = graph[ids[live, pick]]
        fresh = (near >= 0) & ~met[live[:, None], near]
        met[live[:, None], np.where(fresh, near, entries[0])] = True
        d = -np.einsum("brd,bd->br", x[near], q[live])
        d[~fresh] = np.inf
        all_far = np.concatenate([far[live], d], axis=1)
        keep = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        far[live] = np.take_along_axis(all_far, keep, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), keep, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(d.shape, bool)], axis=1), keep, 1)
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(x: np.ndarray, points: np.ndarray, proposed: np.ndarray, degree: int = DEGREE, relax: float = RELAX) -> np.ndarray:
    """At most ``degree`` of the proposed neighbours (-1: none) of each point.

    The nearest goes in; whatever is nearer to it, times the relaxation factor, than to the point goes out.
    """
    length = float(x[0] @ x[0])
    c = np.where((proposed == points[:, None]) | (proposed < 0), points[:, None], proposed)
    to_point = 2 * (length - np.einsum("bcd,bd->bc", x[c], x[points]))
    order = np.argsort(to_point, axis=1, kind="stable")
    c, to_point = np.take_along_axis(c, order, 1), np.take_along_axis(to_point, order, 1)
    # Repeated proposals: all but the first go out, as a point at distance 0 from a kept one; the point itself too.
    alive = c != points[:, None]
    vectors = x[c]
    between = 2 * (length - np.matmul(vectors, vectors.transpose(0, 2, 1)))
    out = np.full((len(points), degree), -1, np.int64)
    row = np.arange(len(points))
    for k in range(degree):
        pick = alive.argmax(1)
        some = alive[row, pick]
        if not some.any():
            break
        out[some, k] = c[row[some], pick[some]]
        alive &= ~(relax * relax * between[row, pick] <= to_point) & (c != c[row, pick][:, None])
        alive[row, pick] = False
    return out


def grow(x: np.ndarray, seed: int = 3) -> tuple[np.ndarray, int]:
    """The graph over vectors of one length (-1: no edge) and the point in the middle, where searches enter."""
    n = len(x)
    graph = np.full((n, DEGREE), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    entry = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        batch = order[at : at + min(at, 1024, max(1, MOST_CELLS // n))]
        at += len(batch)
        proposed, _ = beam_search(x, graph, np.array([entry]), x[batch], BUILD_BEAM)
        # Points of one batch do not meet in the graph yet: the nearest of them are proposed to each other.
        near = -(x[batch] @ x[batch].T)
        np.fill_diagonal(near, np.inf)
        mates = batch[np.argpartition(near, min(DEGREE, len(batch)) - 1, axis=1)[:, :DEGREE]]
        graph[batch] = robust_prune(x, batch, np.concatenate([proposed, mates], axis=1))
        source = np.repeat(batch, DEGREE)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by_target = np.argsort(target, kind="stable")
        source, target = source[by_target], target[by_target]
        while len(target):
            # Of each target's new reverse edges, up to DEGREE at a time.
            first = np.searchsorted(target, target)
            nth = np.arange(len(target)) - first
            now = nth < DEGREE
            points, row = np.unique(target[now], return_inverse=True)
            proposals = np.full((len(points), 2 * DEGREE), -1, np.int64)
            proposals[:, :DEGREE] = graph[points]
            proposals[row, DEGREE + nth[now]] = source[now]
            room = (proposals >= 0).sum(1) <= DEGREE
            packed = np.take_along_axis(proposals[room], np.argsort(proposals[room] < 0, axis=1, kind="stable"), 1)
            graph[points[room]] = packed[:, :DEGREE]
            if (~room).any():
                graph[points[~room]] = robust_prune(x, points[~room], proposals[~room])
            source, target = source[~now], target[~now]
    return graph, entry


def product_graph(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The graph for inner products (-1: no edge) over the vectors, and the points where searches enter."""
    x = scaled(points)
    graph, middle = grow(directions(points))
    longest_first = np.argsort(-np.einsum("nd,nd->n", x, x), kind="stable")
    entries = np.unique(np.append(longest_first[:ENTRIES], middle))
    graph = np.concatenate([graph, np.full((len(x), STRONG), -1, np.int64)], axis=1)
    step = max(1, min(512, MOST_CELLS // len(x)))
    for at in range(0, len(x), step):
        batch = longest_first[at : at + step]
        found, _ = beam_search(x, graph, entries, x[batch], BUILD_BEAM)
        known = (found[:, :, None] == graph[batch][:, None, :DEGREE]).any(2) | (found == batch[:, None])
        found = np.where(known, -1, found)
        graph[batch, DEGREE:] = np.take_along_axis(found, np.argsort(found < 0, axis=1, kind="stable")[:, :STRONG], 1)
    return graph, entries


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: embedding, dims and its k + 1 smallest ids."""
    nth = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    return (
        rows.distinct().withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("dims", F.size("embedding"))
    )


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad
        & F.exists("embedding", lambda v: v != 0)
    )


def build_index(rows: DataFrame, k: int = K) -> tuple[DataFrame, int]:
    """The stored graphs and the number of shards. ``rows`` are those of ``usable``."""
    points = materialize(distinct_vectors(rows, k), "points")
    shards = max(LEAST_SHARDS, -(-points.count() // SHARD_POINTS))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("embedding"), group.column("dims")[0].as_py())
        first_id = pc.list_element(group.column("ids"), 0).to_numpy()
        order = np.lexsort([*vectors.T[::-1], first_id])
        group = group.take(order)
        graph, entries = product_graph(vectors[order])
        edges = pa.ListArray.from_arrays(
            np.arange(len(graph) + 1, dtype=np.int32) * graph.shape[1], pa.array(graph.ravel().astype(np.int32))
        )
        place = pa.array(np.arange(len(graph), dtype=np.int32))
        return pa.table(
            [group.column(c) for c in ("shard", "dims", "embedding", "ids")] + [place, edges, pa.array(np.isin(np.arange(len(graph)), entries))],
            names=["shard", "dims", "embedding", "ids", "place", "edges", "entry"],
        )

    kinds = "shard int, dims int, embedding array<double>, ids array<long>, place int, edges array<int>, entry boolean"
    return materialize(dealt.groupBy("shard", "dims").applyInArrow(build, kinds), "graphs"), shards


def nearest(index: DataFrame, shards: int, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score. ``queries`` are rows of ``usable``."""
    asked = queries.distinct().withColumn("dims", F.size("embedding"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    left = index.select("shard", "dims", every_block.alias("block"), "embedding", "ids", "place", "edges", "entry")
    right = asked.select(
        "dims", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", F.col("embedding").alias("vector")
    ).select(every_shard.alias("shard"), "dims", "block", "vec_id", "vector")
    found = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def walk(points: pa.Table, asked: pa.Table) -> pa.Table:
        if not points.num_rows or not asked.num_rows:
            return found.empty_table()
        dims = points.column("dims")[0].as_py()
        points = points.take(np.argsort(points.column("place").to_numpy(), kind="stable"))
        asked = asked.sort_by("vec_id")
        original, wanted = _matrix(points.column("embedding"), dims), _matrix(asked.column("vector"), dims)
        x = scaled(original)
        graph = points.column("edges").combine_chunks().flatten().to_numpy().reshape(len(x), -1).astype(np.int64)
        entries = np.flatnonzero(points.column("entry").to_numpy(zero_copy_only=False))
        q = directions(wanted)
        members, own = points.column("ids").to_pylist(), asked.column("vec_id").to_pylist()
        rows: list[tuple] = []
        step = max(1, min(512, MOST_CELLS // len(x)))
        for at in range(0, len(q), step):
            met, _ = beam_search(x, graph, entries, q[at : at + step], max(BEAM, k + 1))
            scores = np.einsum("bcd,bd->bc", original[met], wanted[at : at + step])
            for i in range(len(met)):
                scored = sorted(((-s, m) for s, m in zip(scores[i].tolist(), met[i].tolist()) if m >= 0))
                best: list = []
                for s, m in scored:
                    if len(best) > k and -s < best[k - 1][0]:
                        break
                    best += [(-s, v) for v in members[m] if v != own[at + i]]
                best.sort(key=lambda e: (-e[0], e[1]))
                rows += [(own[at + i], v, s) for s, v in best[:k]]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), found)] if rows else found.empty_table().columns, schema=found)

    kinds = "query_id long, vec_id long, score double"
    per_shard = (
        right.groupBy("shard", "dims", "block").cogroup(left.groupBy("shard", "dims", "block")).applyInArrow(lambda a, b: walk(b, a), kinds)
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        per_shard.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op4_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    index, shards = build_index(rows)
    return nearest(index, shards, rows.where("vec_id % 20 = 0"))


QUERIES = {"op4_graph_search": (op4_graph_search, None)}
