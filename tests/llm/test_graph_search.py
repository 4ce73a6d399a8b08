import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm.graph_search import BEAM, beam_search, build_index, directions, grow, nearest, op4_graph_search, robust_prune, usable
from rankloom.llm import graph_search as gs
from tests.conftest import SF


def brute(rows, queries, k=20):
    out = {}
    for q, v in queries:
        scored = sorted(((-float(np.dot(np.array(v), np.array(x))), i) for i, x in rows if i != q and len(x) == len(v)))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_scores_and_order(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    got = {}
    for r in op4_graph_search(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys()
    vectors = dict(rows)
    hits = 0
    for q, found in got.items():
        assert len(found) == 20 and q not in [i for i, _ in found]
        assert found == sorted(found, key=lambda e: (-e[1], e[0]))
        for i, s in found:
            assert s == pytest.approx(np.dot(vectors[q], vectors[i]), abs=1e-12)
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_awkward_vectors(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(60)] + [
        (100, None), (101, []), (102, [0.0, 0.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]), (105, [float("inf"), 1.0]),
        (None, [3.0, 3.0]), (106, [1.0, 2.0, 3.0]), (107, [5.0, -1.0]), (107, [5.0, -1.0]), (120, [-2.0, 0.5]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, ids string, shard int")
    good = usable(df)
    assert {r.vec_id for r in good.collect()} == {*range(60), 106, 107, 120}
    index, shards = build_index(good)
    found = {}
    for r in nearest(index, shards, good.where("vec_id % 20 = 0 or vec_id = 106")).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found[0] == list(range(1, 21))
    assert found[20] == list(range(20))
    assert found[120][:20] == list(range(20))
    assert 106 not in found
    empty, n = build_index(good.limit(0))
    assert nearest(empty, n, good.limit(0)).count() == 0


def test_lengths_differ_inner_product_counts(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.1, 3, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("embedding", F.col("embedding").cast("array<float>"))
    good = usable(df)
    index, shards = build_index(good)
    asked = good.where("vec_id % 20 = 0")
    want = brute([(r.vec_id, list(r.embedding)) for r in good.collect()], [(r.vec_id, list(r.embedding)) for r in asked.collect()])
    got = {}
    for r in nearest(index, shards, asked).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.95 * 20 * len(want)


def test_pruning_keeps_diverse_edges():
    angles = np.array([0.0, 0.5, 0.55, -0.5, 2.0])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    kept = robust_prune(x, np.array([0]), np.array([[2, 1, 1, 0, 3, -1]]), degree=3, relax=1.0)[0]
    assert kept.tolist()[0] == 1 and 2 not in kept and 0 not in kept and list(kept).count(1) == 1


def test_every_point_is_met_from_the_entry():
    x = directions(np.random.default_rng(1).normal(size=(700, 8)))
    graph, entry = grow(x)
    seen, front = {entry}, [entry]
    while front:
        front = [j for i in front for j in graph[i] if j >= 0 and j not in seen and not seen.add(j)]
    assert len(seen) > 0.99 * len(x)
    ids, _ = beam_search(x, graph, np.array([entry]), x[:50], BEAM)
    assert (ids[:, 0] == np.arange(50)).mean() > 0.95


@pytest.mark.parametrize("seed, skew", [(11, 0.0), (12, 0.5), (13, 1.0), (14, 1.5)])
def test_recall_in_one_shard_of_many_points(seed, skew):
    """Clustered vectors of skewed norms, many more of them than the beam is wide; queries are and are not points."""
    n, asked = 4000, 200
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(200, 64))
    points = centres[rng.integers(0, 200, n)] + 0.5 * rng.normal(size=(n, 64))
    points *= rng.lognormal(0, skew, n)[:, None]
    graph, entries = gs.product_graph(points)
    wanted = np.concatenate([points[rng.choice(n, asked, replace=False)], rng.normal(size=(asked, 64))])
    truth = np.argsort(-(wanted @ points.T), axis=1, kind="stable")[:, : gs.K]
    met, _ = beam_search(gs.scaled(points), graph, entries, directions(wanted), BEAM)
    for some in (slice(0, asked), slice(asked, 2 * asked)):
        hits = sum(len(set(m[: gs.K].tolist()) & set(t.tolist())) for m, t in zip(met[some], truth[some]))
        assert hits >= 0.95 * asked * gs.K


def test_order_of_rows_changes_nothing(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 12)) * rng.lognormal(0, 1.0, 3000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    answers = []
    for order in (range(3000), rng.permutation(3000).tolist()):
        good = usable(spark.createDataFrame([rows[i] for i in order], "vec_id long, embedding array<double>"))
        index, shards = build_index(good)
        found = nearest(index, shards, good.where("vec_id % 20 = 0")).collect()
        answers.append(sorted((r.query_id, r["rank"], r.vec_id) for r in found))
    assert answers[0] == answers[1]


def test_very_long_and_very_short_vectors(spark):
    rows = [(i, [s * 10.0 ** e, 10.0 ** e]) for i, (s, e) in enumerate([(1, 150), (-1, 150), (1, -150), (1, 0), (-1, 0), (2, 140)])]
    good = usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    index, shards = build_index(good)
    found = nearest(index, shards, good.where("vec_id = 3")).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [0, 5, 2, 1, 4] and [r["rank"] for r in found] == [1, 2, 3, 4, 5]
