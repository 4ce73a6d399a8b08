from math import comb

import pytest
from pyspark.sql import functions as F

from rankloom.llm.mixing import _hypergeometric, mix, mixed_documents, op8_mixing, split_quotas, targets
from tests.conftest import SF, plan_of


def water(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares by weight; what is above the cap is shared again among the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    got = {s: 0.0 for s in names}
    left, open_ = share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            got[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 40, None: 70}, {"a": 0, "b": 0}, {"x": 7}, {"é": 10, "z": 10, "Z": 500}])
def test_targets(spark, sizes):
    rows = [(s, f"k{i}", n) for i, (s, n) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "_source string, _key string, source_size long")
    got = {r._source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_hypergeometric_draws_follow_the_distribution(spark):
    n, k, m, draws = 20, 8, 7, 4000
    u = (F.col("id") + 0.5) / draws
    x = _hypergeometric(F.lit(n), F.lit(k), F.lit(m), u)
    got = {r.x: r["count"] for r in spark.range(draws).select(x.alias("x")).groupBy("x").count().collect()}
    for i in range(m + 1):
        assert abs(got.get(i, 0) / draws - comb(k, i) * comb(n - k, m - i) / comb(n, m)) < 2 / draws


def test_quotas_are_split_exactly(spark):
    quotas = {"a": 1000, "b": 37, "c": 1, "d": 0}
    df = spark.createDataFrame(list(quotas.items()), "_key string, quota long")
    ends = {r._key: r.ends for r in split_quotas(df, levels=3).collect()}
    draws = {k: [b - a for a, b in zip([0, *e], e)] for k, e in ends.items()}
    assert all(len(d) == 8 and sum(d) == quotas[k] and min(d) >= 0 for k, d in draws.items())
    per_shard = [sum(draws[k][i] for k in quotas) for i in range(8)]
    assert max(per_shard) - min(per_shard) <= 3


def test_query_takes_what_is_wanted(spark):
    df = op8_mixing(spark, SF)
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)
    rows = df.collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    sizes, taken, target = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken <= 2 * r["size"] and r.taken == r["size"] * len(r.shards)
    assert len(rows) == len(source)
    assert target == pytest.approx(water(sizes))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(60, 0.02 * target[s])
    assert sorted(map(str, rows)) == sorted(map(str, op8_mixing(spark, SF).collect()))


def test_awkward_rows(documents, nothing):
    rows = mix(documents, levels=1).collect()
    assert len(rows) == documents.count()
    assert all(r.target == 0 and r.source_size == 0 for r in rows if r._row.source is None)
    out = mixed_documents(documents, levels=1)
    assert out.columns == documents.columns
    assert out.count() == sum(len(r._taken) for r in rows)
    assert mix(nothing, levels=1).count() == 0 and mixed_documents(nothing, levels=1).count() == 0
