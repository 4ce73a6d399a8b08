import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm.toxicity import (
    STATES, STRIDE, WINDOW, Network, Scorer, _windows, fit, grams, held_out, keep_clean, op10_toxicity, score, train, words_of,
)
from tests.conftest import SF


def small(seed=0):
    net = Network(["good", "bad"], seed)
    rng = np.random.default_rng(seed)
    net.p["word"] = rng.normal(size=net.p["word"].shape).astype(np.float32)
    return net


def test_gradients_agree_with_differences():
    net = small()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(1)
    gates = np.concatenate([np.zeros((1, 2, 3 * STATES)), rng.normal(size=(9, 2, 3 * STATES))])
    codes = rng.integers(1, 10, (6, 5))
    codes[2, 3:] = 0
    wanted = np.array([0, 1, 1, 0, 1, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-net.forward(gates, codes).astype(np.float64)))
        return -np.mean(np.where(wanted > 0, np.log(p), np.log(1 - p)))

    g, d_gates, _ = net.gradients(gates, codes, wanted)
    for name in ("state", "look", "pick", "out", "shift"):
        flat, grad = net.p[name].reshape(-1), g[name].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert grad[i] == pytest.approx((up - down) / 2e-2, abs=2e-4, rel=3e-2)
    by_word = np.zeros_like(gates)
    np.add.at(by_word, codes, d_gates)
    for at in [(3, 0, 1), (4, 1, 10), (5, 0, 20)]:
        old = gates[at]
        gates[at] = old + 1e-2
        up = loss()
        gates[at] = old - 1e-2
        down = loss()
        gates[at] = old
        assert by_word[at] == pytest.approx((up - down) / 2e-2, abs=2e-4, rel=3e-2)


def test_a_score_is_that_of_the_worst_window():
    net = small(3)
    net.p["out"] *= 4
    words = [f"w{i}" if i % 7 else "bad" for i in range(WINDOW + 5 * STRIDE + 9)]
    alone = [Scorer(net)([" ".join(words[s : s + WINDOW])])[0] for s in range(0, len(words) - WINDOW + STRIDE, STRIDE)]
    whole = Scorer(net)([" ".join(words), "", " \n", "good", None or "!!!"])
    assert whole[0] == pytest.approx(max(alone), abs=1e-6)
    assert whole[1] == whole[2] == whole[4] == 0 and 0 < whole[3] < 1


def test_grams_of_each_word():
    bins, begin = grams(["abc", "a", "ü"])
    size = np.diff(np.append(begin, len(bins)))
    assert size.tolist() == [3 + 2, 1, 2 + 1]
    assert grams(["a"])[0].tolist() == bins[5:6].tolist()


def test_windows_cover_every_word():
    for n in (1, WINDOW, WINDOW + 1, 3 * WINDOW):
        words = [str(i) for i in range(n)]
        assert {w for ws in _windows(words) for w in ws} == set(words)
    assert _windows([]) == []
    assert words_of("A, (b)!  'C'") == ["a", "b", "c"]


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = op10_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    caught = np.mean([r.predicted for r in rows if r.toxic])
    # Some 300 toxic documents to learn from, half of them in languages with endings never met before.
    assert right >= 0.95 and caught >= 0.75


def test_awkward_rows_and_no_labels(spark, documents, nothing):
    assert [r.h for r in documents.select(held_out().alias("h"), "doc_id").where("doc_id is null").collect()] == [False, False]
    labels = spark.createDataFrame([(10, 1), (1, 0), (8, 0), (3, None), (None, 1), (14, 0), (10, 0)], "doc_id long, toxic int")
    net = fit(documents, labels, steps=30)
    rows = score(documents, net, "doc_id", "node").collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in rows if r.doc_id in (5, 6, 7)] == [0, 0, 0]
    assert score(nothing, net, "doc_id").count() == 0
    assert fit(documents, labels.where("toxic = 0")) is None and fit(nothing, labels) is None
    assert {r.score for r in score(documents, None, "doc_id").collect()} == {0.0}
    assert keep_clean(documents, documents, labels.limit(0)).count() == documents.count()
    left = keep_clean(documents, documents, labels)
    assert left.columns == documents.columns and {5, 6, 7} <= {r.doc_id for r in left.collect()}


def test_training_is_the_same_each_time():
    windows = [f"you idiot {i}" for i in range(30)] + [f"nice day {i}" for i in range(60)]
    toxic, owner = np.array([1] * 30 + [0] * 60), np.arange(90)
    one, two = (train(windows, toxic, owner, steps=60) for _ in range(2))
    assert all((one.p[k] == two.p[k]).all() for k in one.p)
    got = Scorer(one)(["you idiot 7", "nice day 7"])
    assert got[0] > 0.5 > got[1]
    assert train([], np.array([]), np.array([])) is None


def test_query_covers_every_row(spark):
    assert op10_toxicity(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
