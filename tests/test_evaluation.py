import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators import evaluation as E


def evaluate(spark, scores, labels, **options):
    rows = [(1, i + 1, str(i), float(s) if s is not None else None) for i, s in enumerate(scores)]
    ranked = spark.createDataFrame(rows, "jd_id int, rank int, id string, final_score double")
    tags = spark.createDataFrame([(str(i), x) for i, x in enumerate(labels)], "id string, label int")
    (row,) = E.evaluate_rankings(ranked, tags, digits=9, **options).collect()
    return row


def dcg(labels, k):
    return sum(x / math.log2(i + 2) for i, x in enumerate(labels[:k]))


def ndcg_over_all_tie_orders(scores, labels, k):
    """Mean gain over every order that the scores allow."""
    groups = [[labels[i] for i in range(len(scores)) if scores[i] == s] for s in sorted(set(scores), reverse=True)]
    orders = [list(itertools.chain(*p)) for p in itertools.product(*(itertools.permutations(g) for g in groups))]
    best = dcg(sorted(labels, reverse=True), k)
    return sum(dcg(o, k) for o in orders) / len(orders) / best if best else 0.0


def average_ranks(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]


def pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    da, db = [x - ma for x in a], [x - mb for x in b]
    return sum(x * y for x, y in zip(da, db)) / math.sqrt(sum(x * x for x in da) * sum(y * y for y in db))


@pytest.mark.parametrize("seed", range(2))
def test_metrics_equal_their_definitions(spark, seed):
    rng = random.Random(seed)
    scores = [rng.choice([0.1, 0.5, 0.5, 0.9, seed / 10]) for _ in range(8)]
    labels = [rng.choice([0, 1, 2]) for _ in range(8)]
    labels[0], labels[1], scores[0], scores[1] = 0, 2, 0.1, 0.9
    row = evaluate(spark, scores, labels)
    order = sorted(range(8), key=lambda i: (-scores[i], i))
    for k in (3, 5, 10):
        first = [labels[i] >= 2 for i in order][:k]
        assert row[f"p_at_{k}"] == pytest.approx(sum(first) / len(first))
        assert row[f"ndcg_at_{k}"] == pytest.approx(ndcg_over_all_tie_orders(scores, labels, k))
    assert row.spearman == pytest.approx(pearson(average_ranks(scores), average_ranks(labels)))


def test_ties_by_hand(spark):
    row = evaluate(spark, [1, 1, 0], [0, 2, 1], ks=(1, 3), relevant=1)
    assert row.p_at_1 == 0.0 and row.p_at_3 == pytest.approx(2 / 3)
    assert row.ndcg_at_1 == pytest.approx(0.5)


def test_constant_labels_and_no_gain(spark):
    row = evaluate(spark, [3, 2, 1], [0, 0, 0])
    assert row.spearman is None and row.ndcg_at_3 == 0.0 and row.p_at_3 == 0.0
    assert evaluate(spark, [1, 1], [0, 2]).spearman is None


def test_single_document_has_no_ndcg(spark):
    row = evaluate(spark, [1], [2])
    assert row.ndcg_at_3 is None and row.p_at_3 == 1.0


def test_missing_scores_count_as_zero(spark):
    assert evaluate(spark, [None, 1.0, 2.0], [2, 1, 0]).spearman == pytest.approx(-1.0)


def test_methods_without_scores_are_left_out(spark):
    ranked = spark.createDataFrame(
        [(1, 1, "a", 2.0, None, 1.0), (1, 2, "b", 1.0, None, 0.0)],
        "jd_id int, rank int, id string, final_score double, semantic_score double, tfidf_score double",
    )
    labels = spark.createDataFrame([("a", 2), ("b", 0)], "id string, label int")
    assert {r.method for r in E.evaluate_rankings(ranked, labels).collect()} == {"final", "tfidf"}


def test_no_overlap_and_negative_labels_raise(spark):
    ranked = spark.createDataFrame([(1, 1, "a", 2.0)], "jd_id int, rank int, id string, final_score double")
    with pytest.raises(ValueError, match="no ranked id"):
        E.evaluate_rankings(ranked, spark.createDataFrame([("z", 1)], "id string, label int"))
    with pytest.raises(ValueError, match="negative"):
        E.evaluate_rankings(ranked, spark.createDataFrame([("a", -1)], "id string, label int"))


def test_repeated_ids_fan_out(spark):
    ranked = spark.createDataFrame([(1, 1, "a"), (1, 2, "a")], "jd_id int, rank int, id string")
    labels = spark.createDataFrame([("a", 1), ("a", 2)], "id string, label int")
    assert E.join_labels(ranked, labels).count() == 4


def test_rounding(spark):
    ranked = spark.createDataFrame([(1, i, str(i), -float(i)) for i in range(1, 4)], "jd_id int, rank int, id string, final_score double")
    labels = spark.createDataFrame([("1", 2), ("2", 0), ("3", 0)], "id string, label int")
    (row,) = E.evaluate_rankings(ranked, labels).collect()
    assert row.p_at_3 == 0.333


def test_labels_of_one_id_count_in_the_order_of_their_store(spark):
    ranked = spark.createDataFrame([("j", 1, "a", 5.0), ("j", 2, "b", 4.0)], "jd_id string, rank int, id string, final_score double")
    for labels, want in (([("a", 0), ("a", 2), ("b", 0)], 0.0), ([("a", 2), ("a", 0), ("b", 0)], 1.0)):
        tags = spark.createDataFrame(labels, "id string, label int")
        result = E.evaluate_rankings(ranked, tags, ks=(1, 3)).first()
        assert result.p_at_1 == want
        with_pos = tags.withColumn("pos", -F.monotonically_increasing_id())
        assert E.evaluate_rankings(ranked, with_pos, ks=(1, 3)).first().p_at_1 == 1.0 - want


def test_missing_labels_are_an_error(spark):
    ranked = spark.createDataFrame([("j", 1, "a", 5.0)], "jd_id string, rank int, id string, final_score double")
    with pytest.raises(ValueError, match="missing"):
        E.evaluate_rankings(ranked, spark.createDataFrame([("a", None)], "id string, label int"))


def test_three_digits_unless_told_otherwise(spark):
    rows = [("j", i, str(i), 1.0 / i) for i in range(1, 8)]
    ranked = spark.createDataFrame(rows, "jd_id string, rank int, id string, final_score double")
    labels = spark.createDataFrame([(str(i), i % 3) for i in range(1, 8)], "id string, label int")
    figures = E.evaluate_rankings(ranked, labels).first()
    exact = E.evaluate_rankings(ranked, labels, digits=9).first()
    assert figures.ndcg_at_5 == round(exact.ndcg_at_5, 3) != exact.ndcg_at_5
