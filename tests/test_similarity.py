import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from rankloom import runtime
from rankloom.operators import similarity as S
from rankloom.operators import term_columns


def brute_force(jobs, candidates, stop=()):
    """Cosines straight from the definition, one pool after the other."""

    def grams(text):
        words, run = [], ""
        for c in text.lower() + " ":
            if c.isalnum() or c == "_":
                run += c
            else:
                if len(run) > 1 and run not in stop:
                    words.append(run)
                run = ""
        return Counter(words + [a + " " + b for a, b in zip(words, words[1:])])

    result = {}
    for jd, job_text in jobs:
        corpus = {-1: grams(job_text), **{pos: grams(text) for j, pos, text in candidates if j == jd}}
        df = Counter(term for g in corpus.values() for term in g)
        idf = {t: math.log((1 + len(corpus)) / (1 + n)) + 1 for t, n in df.items()}
        vectors = {p: {t: (1 + math.log(c)) * idf[t] for t, c in g.items()} for p, g in corpus.items()}
        norm = {p: math.sqrt(sum(x * x for x in v.values())) for p, v in vectors.items()}
        for pos, v in vectors.items():
            if pos != -1:
                dot = sum(x * vectors[-1].get(t, 0.0) for t, x in v.items())
                result[jd, pos] = dot / (norm[pos] * norm[-1]) if norm[pos] * norm[-1] else 0.0
    return result


JOBS = [(1, "green tea and black tea, green tea"), (2, "Paper boats"), (3, "the")]
CANDIDATES = [
    (1, 10, "green tea"), (1, 11, "black coffee black coffee"), (1, 12, ""), (1, 13, "the and"),
    (1, 14, "Green tea, black tea; green tea!"), (2, 20, "paper boats on paper"), (2, 21, "tea"), (3, 30, "the tea"),
]


def frames(spark, jobs, candidates):
    return spark.createDataFrame(candidates, "jd_id long, pos long, text string"), spark.createDataFrame(
        jobs, "jd_id long, text string"
    )


def similarities(spark, jobs, candidates, stop):
    rows = S.tfidf_similarity(*frames(spark, jobs, candidates), stop).collect()
    return {(r.jd_id, r.pos): r.similarity for r in rows}


def assert_close(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


@pytest.mark.parametrize("stop", [(), ("the", "and", "on")])
def test_tfidf_equals_brute_force(spark, stop):
    assert_close(similarities(spark, JOBS, CANDIDATES, stop), brute_force(JOBS, CANDIDATES, stop))


def skewed_corpus():
    """One term in every text, some in many, most in one; one pool with nearly all candidates."""
    rows = []
    for i in range(300):
        many = " ".join(f"many{i % k}" for k in (2, 3, 5, 7))
        rows.append((1 if i % 20 else 2, i, f"always {many} only{i} always rare{i // 3}"))
    return [(1, "always many1 only7 rare2 unseen"), (2, "many0 always always")], rows


def test_frequent_and_rare_terms_take_two_ways_to_one_result(spark, monkeypatch):
    jobs, candidates = skewed_corpus()
    want = brute_force(jobs, candidates)
    # All rare, some frequent, nearly all frequent.
    for share in (10.0, 1 / 50, 1 / 1_000_000):
        monkeypatch.setattr(S, "FREQUENT_SHARE", share)
        assert_close(similarities(spark, jobs, candidates, ()), want)
    # Frequent terms found in a small part of the documents.
    monkeypatch.setattr(S, "FREQUENT_SHARE", 1 / 50)
    monkeypatch.setattr(S, "SAMPLED_DOCUMENTS", 20)
    assert_close(similarities(spark, jobs, candidates, ()), want)


def test_many_jobs_are_joined_by_salt(spark, monkeypatch):
    jobs, candidates = skewed_corpus()
    monkeypatch.setattr(S, "is_small", lambda df: False)
    assert_close(similarities(spark, jobs, candidates, ()), brute_force(jobs, candidates))


def test_size_check(spark):
    assert runtime.is_small(spark.range(5), 5) and not runtime.is_small(spark.range(6), 5)


def test_both_ways_to_attach_agree(spark):
    facts = spark.range(1_000).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    for how in ("inner", "left"):
        small, large = (
            sorted(map(tuple, runtime.attach(facts, dim, "k", F.col("id"), flag, how).collect()), key=repr)
            for flag in (True, False)
        )
        assert small == large and len(small) == (667 if how == "inner" else 1_000)


def test_semantic_takes_the_best_three(spark):
    chunks = spark.createDataFrame(
        [(1, 1, [x, 0.0]) for x in (0.1, 0.9, 0.5, 0.7)] + [(1, 2, [0.2, 5.0])], "jd_id long, pos long, vector array<float>"
    )
    query = spark.createDataFrame([(1, [1.0, 0.0])], "jd_id long, vector array<float>")
    got = {r.pos: r.similarity for r in S.semantic_similarity(chunks, query).collect()}
    assert got[1] == pytest.approx(0.7) and got[2] == pytest.approx(0.2)


def test_minmax(spark):
    rows = [(1, 1, 2.0), (1, 2, 4.0), (1, 3, 3.0), (2, 1, 5.0), (3, 1, -1.0), (3, 2, -1.0), (4, 1, 0.4)]
    df = spark.createDataFrame(rows, "jd_id long, pos long, x double")
    got = {(r.jd_id, r.pos): r.y for r in S.minmax(df, "x", "y", True).collect()}
    assert got == {(1, 1): 0.0, (1, 2): 1.0, (1, 3): 0.5, (2, 1): 1.0, (3, 1): 0.0, (3, 2): 0.0, (4, 1): 0.4}


def test_pools_without_a_job_are_an_error(spark):
    rows = spark.range(20_000).select(F.col("id").alias("jd_id"), F.col("id").alias("pos"), F.lit("python").alias("text"))
    with pytest.raises(ValueError, match="pools without a job: .* and others"):
        S.tfidf_similarity(rows, spark.createDataFrame([(1, "python")], "jd_id long, text string"))


def test_several_jobs_on_one_collection(spark):
    """Jobs that share terms with the collection, with each other, with nothing, or are empty."""
    _, rows = skewed_corpus()
    texts = [(pos, text) for _, pos, text in rows] + [(900, ""), (901, None)]
    jobs = [(1, "always many1 only7 rare2 unseen"), (2, "many0 always always"), (3, "nothing shared"), (4, ""), (5, None), (6, "rare2 only7 only7")]
    counted = runtime.materialize(
        S.add_term_counts(spark.createDataFrame(texts, "pos long, text string"), ()).select("pos", "terms", "counts"), "counted"
    )
    asked = spark.createDataFrame(jobs, "jd_id long, text string")
    want = brute_force([(j, t or "") for j, t in jobs], [(j, pos, text or "") for j, _ in jobs for pos, text in texts])
    shared = {k: v for k, v in want.items() if v}
    for norms in (None, S.collection_norms(counted)):
        got = {(r.jd_id, r.pos): r.similarity for r in S.cosine_with_jobs(counted, asked, (), norms).collect()}
        assert_close({k: v for k, v in got.items() if v}, shared)


def test_many_terms_of_jobs_are_joined_by_salt(spark, monkeypatch):
    monkeypatch.setattr(S, "ASKED_TERMS", 1)
    test_several_jobs_on_one_collection(spark)


def test_several_jobs_by_vectors_equal_one_after_the_other(spark):
    chunks = spark.createDataFrame([(p, [p / 9, c / 7]) for p in range(9) for c in range(6)] + [(90, None)], "pos long, vector array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, -0.8])], "jd_id long, vector array<float>")
    together = S.semantic_for_jobs(chunks, queries)
    for job in (1, 2):
        alone = S.semantic_similarity(chunks.where("pos < 90").withColumn("jd_id", F.lit(job)), queries)
        of_job = together.where(F.col("jd_id") == job)
        assert sorted(map(tuple, of_job.select("pos", "similarity").collect())) == sorted(map(tuple, alone.select("pos", "similarity").collect()))
    assert plan_of(together).count("parquet") <= 1 and "Cartesian" not in plan_of(together) and "NestedLoop" not in plan_of(together)


def test_terms_of_a_text_are_counted_once(spark):
    """No filter inferred from the list of terms may repeat the counting, once per term, below it."""
    candidates, jobs = frames(spark, JOBS, CANDIDATES)
    tf = S.term_frequencies(S.with_job_texts(candidates, jobs), ["the"])
    for rows in (tf, tf.groupBy("jd_id", "pos").count(), S.document_frequencies(tf)):
        # Once for candidates and once for jobs.
        assert plan_of(rows).split("Initial Plan")[0].count("regexp_extract_all(") == 2
    got = {(r.pos, r.term): r.tf for r in tf.where("jd_id = 1").collect()}
    assert got[11, "coffee"] == 2 and got[11, "coffee black"] == 1 and got[13, "and"] == 1
    assert not [key for key in got if key[0] == 12]


def test_rare_terms_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    """Every task gets few terms, each of them whole, whether documents are stored as words or as counted terms."""
    jobs, candidates = skewed_corpus()
    want = brute_force(jobs, candidates)
    monkeypatch.setattr(S, "FREQUENT_SHARE", 1 / 50)
    monkeypatch.setattr(S, "TASK_TERMS", 100)
    assert_close(similarities(spark, jobs, candidates, ()), want)
    people, _ = frames(spark, jobs, candidates)
    words = runtime.materialize(S.add_words(people, ()).drop("text"), "words")
    terms = runtime.materialize(S.count_terms(words), "terms")
    sizes = S.corpus_sizes(words)
    as_words, as_terms = (
        {(r.jd_id, r.pos): r.norm2 for r in S.term_products(d, sizes, S.frequent_terms(d), True).collect()} for d in (words, terms)
    )
    assert len(as_words) == len(candidates)
    assert_close(as_words, as_terms)


def test_terms_without_position_or_pool(spark):
    """A row without position counts for the terms it has and has no sum; one without pool counts for nothing."""
    rows = [("x", 1, ["tea", "cup"]), ("x", None, ["tea"]), ("x", 2, []), (None, 3, ["tea", "pot"])]
    words = runtime.materialize(spark.createDataFrame(rows, "jd_id string, pos long, words array<string>"), "words")
    sizes = spark.createDataFrame([("x", 3)], "jd_id string, n long")
    got = {(r.jd_id, r.pos): r.norm2 for r in S.term_products(words, sizes, S.frequent_terms(words), True).collect()}
    rare, tea = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    assert got["x", 1] == pytest.approx(tea**2 + 2 * rare**2) and got["x", 2] == 0.0
    assert set(got) == {("x", 1), ("x", 2), (None, 3)} and got[None, 3] == 0.0


def test_words_that_share_a_number_get_others(spark, monkeypatch):
    """Terms are compared by numbers of their words, so a key under which two words have one number is not used."""
    jobs, candidates = skewed_corpus()
    real, keys = term_columns.listed_counts, []

    def all_alike_at_first(listed, job_pos, key):
        body, colliding = real(listed, job_pos, key), key < 2
        keys.append(key)

        def count(batches):
            for b in body(batches):
                same = [None if w is None else 7 for w in b.column("word").to_pylist()]
                yield b.set_column(b.schema.get_field_index("number"), "number", pa.array(same, pa.int64())) if colliding else b

        return count

    monkeypatch.setattr(term_columns, "listed_counts", all_alike_at_first)
    assert_close(similarities(spark, jobs, candidates, ()), brute_force(jobs, candidates))
    assert keys == [0, 1, 2]


def test_terms_are_told_apart_where_mixed_numbers_meet(monkeypatch):
    rng = np.random.default_rng(3)
    pool, first, last = (rng.integers(0, 4, 500) for _ in range(3))
    want = len({*zip(pool, first, last)})
    for mixed in (term_columns._mixed, lambda a, b: np.zeros(len(a), np.uint64)):
        monkeypatch.setattr(term_columns, "_mixed", mixed)
        group = term_columns._groups(pool, first, last)
        assert len({*zip(pool, first, last, group)}) == len({*group}) == group.max() + 1 == want


def test_sums_of_documents_move_together():
    """A task hands on one row per pool and next task, not one per document, and sums come out as they are defined."""
    texts = {i: f"always many{i % 3} only{i} rare{i // 2}" for i in range(60)}
    batch = pa.RecordBatch.from_pydict(
        {"jd_id": pa.array(["x"] * 60), "pos": pa.array(list(texts)), "n": pa.array([60] * 60), "words": pa.array(list(texts.values()))}
    )
    few = term_columns.TermList(pa.table({"jd_id": ["x"], "term": ["always"]}), True, 0)
    packed = {c: pa.binary() for c in ("pos", "first", "last", "tf", "dot", "norm2")}
    apart = pa.schema({"task": pa.int32(), "jd_id": pa.string(), "n": pa.int64(), "known": pa.bool_(), **packed})
    parts = pa.schema([apart.field(c) for c in ("task", "jd_id", "pos", "dot", "norm2")])
    summed = pa.schema({"jd_id": pa.string(), "pos": pa.int64(), "dot": pa.float64(), "norm2": pa.float64()})

    def dealt(rows, tasks):
        return [[b.filter(pc.equal(b.column("task"), t)) for b in rows] for t in range(tasks)]

    split = list(term_columns.listed_sums(few, np.array([60]), np.array([0]), 3, 0, apart)([batch]))
    gathered = [list(term_columns.gathered_sums(-1, 2, parts)(bs)) for bs in dealt(split, 3)]
    assert all(sum(b.num_rows for b in bs) <= 2 for bs in gathered)
    found = [b for bs in dealt([b for bs in gathered for b in bs], 2) for b in term_columns.document_sums(summed)(bs)]
    got = {r["pos"]: r["norm2"] for b in found for r in b.to_pylist()}
    terms = {i: words + [f"{a} {b}" for a, b in zip(words, words[1:])] for i, words in ((i, t.split()) for i, t in texts.items())}
    df = Counter(t for ts in terms.values() for t in ts)
    assert_close(got, {i: sum((math.log(61 / (1 + df[t])) + 1) ** 2 for t in ts) for i, ts in terms.items()})
