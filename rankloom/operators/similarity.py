"""TF-IDF and vector similarity between candidates and the job of their pool.

A pool is the set of candidates screened for one job, named by ``jd_id``; ``pos`` is a row's unique
position. Ranking a whole table against one job is the case of a single pool.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.terms import add_joined_words, add_term_counts, add_words, count_terms, default_stop_words
from ..runtime import attach, is_light, is_small, materialize, spread
from . import term_columns
from .ordering import first_rows

# A term is frequent if it takes more than this share of all (document, term) rows. Shares add up to
# one, so there are fewer than 1/share frequent terms: a table of them is safe to broadcast.
FREQUENT_SHARE = 1 / 20_000
# Documents looked at to find the frequent terms, and files they are taken from.
SAMPLED_DOCUMENTS = 1_000
SAMPLED_FILES = 256

# Rows of rare terms that one task gets, some 28 bytes each; below the second number a task is not worth its start.
TASK_TERMS, FEWEST_TERMS = 2_000_000, 50_000

# Sums over shuffled rows differ in the last bits from run to run. Equal texts must get equal
# scores, so similarities are cut to this many digits.
STABLE_DIGITS = 10

BEST_CHUNKS = 3

# Terms of all jobs together that are broadcast.
ASKED_TERMS = 200_000

# The job's own text is part of its corpus, under this position.
JOB_POS = -1


def sublinear_tf(tf: Column) -> Column:
    return 1 + F.log(tf.cast("double"))


def smooth_idf(df: Column, n: Column) -> Column:
    """Inverse document frequency as if one more document held every term."""
    return F.log((1 + n).cast("double") / (1 + df)) + 1


def with_job_texts(candidates: DataFrame, jobs: DataFrame) -> DataFrame:
    """``(jd_id, pos, text)`` of the candidates and, as position -1, of the jobs."""
    members = candidates.select("jd_id", F.col("pos").cast("bigint").alias("pos"), "text")
    return members.unionByName(jobs.select("jd_id", F.lit(JOB_POS).cast("bigint").alias("pos"), "text"))


def check_pools(candidates: DataFrame, jobs: DataFrame) -> None:
    """Every pool needs a job: its candidates would otherwise vanish from the ranking."""
    lost = candidates.select("jd_id").distinct().join(jobs.select("jd_id"), "jd_id", "left_anti").limit(4).collect()
    if lost:
        names = ", ".join(str(r.jd_id) for r in lost[:3]) + (" and others" if len(lost) > 3 else "")
        raise ValueError(f"pools without a job: {names}")


def corpus_sizes(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("jd_id").agg(F.count(F.lit(1)).alias("n"))


def term_rows(counted: DataFrame) -> DataFrame:
    """One row ``(jd_id, pos, term, tf)`` per document and term.

    The outer form, without its rows for empty lists: from the plain one Spark infers a filter on the size of the list and
    pushes it down to the texts, where the whole counting of a text is repeated for every term of it.
    """
    each = counted.select("jd_id", "pos", "counts", F.posexplode_outer("terms").alias("_k", "term")).where(F.col("_k").isNotNull())
    return each.select("jd_id", "pos", "term", F.get("counts", F.col("_k")).alias("tf"))


def term_frequencies(documents: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """``(jd_id, pos, term, tf)``: how often each token and token pair occurs in each text."""
    return term_rows(add_term_counts(spread(documents.select("jd_id", "pos", "text"), "pos"), stop_words).drop("text"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """``(jd_id, term, df, job_tf)``; ``job_tf`` is NULL for terms the job's text does not have."""
    return tf.groupBy("jd_id", "term").agg(F.count(F.lit(1)).alias("df"), F.max(_job_tf()).alias("job_tf"))


def _job_tf() -> Column:
    return F.when(F.col("pos") == JOB_POS, F.col("tf"))


def _with_terms(documents: DataFrame) -> DataFrame:
    """Documents with ``terms, counts``, be they stored so or as ``words``."""
    return count_terms(documents) if "words" in documents.columns else documents


def _known_terms(documents: DataFrame) -> list[str]:
    return ["words"] if "words" in documents.columns else ["terms", "counts"]


def frequent_terms(counted: DataFrame) -> DataFrame:
    """``(jd_id, term)`` that would weigh down a task, found in some documents of some files.

    This only decides which way a term takes below; either way is exact.
    """
    # Only the number of files comes to Python; the scan leaves out the files that the filter rejects.
    files = len(counted._jdf.inputFiles())
    of_file = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(max(files // SAMPLED_FILES, 1)))
    some = counted.where(of_file == 0) if files > SAMPLED_FILES else counted
    every = max(some.count() // SAMPLED_DOCUMENTS, 1)
    # Stored, as finding it reads the terms of all those files.
    sample = some.where(F.pmod(F.xxhash64("pos"), F.lit(every)) == 0)
    sample = materialize(_with_terms(sample).select("jd_id", "pos", "terms", "counts"), "sampled-documents")
    rows = sample.agg(F.sum(F.size("terms"))).first()[0] or 0
    counts = term_rows(sample).groupBy("jd_id", "term").agg(F.count(F.lit(1)).alias("c"))
    return materialize(counts.where(F.col("c") > max(rows * FREQUENT_SHARE, 1)).select("jd_id", "term"), "frequent-terms")


def term_products(counted: DataFrame, sizes: DataFrame, frequent: DataFrame, small: bool) -> DataFrame:
    """A stored table of one row per document: ``(jd_id, pos, dot, norm2)``.

    ``norm2`` is the squared length of its weights, ``dot`` the product with the row of the job in ``counted``, 0 where that
    has none. ``counted`` is a parquet table with ``jd_id, pos`` and either ``words`` or ``terms, counts``, read twice here; ``sizes`` has the
    documents per pool, ``frequent`` the few terms to be counted without a shuffle.

    A weight needs the number of documents that share the term, and the few terms that most documents share cannot be
    brought together in one task each. So frequent terms are counted first, in every task on its own, and their counts
    are sent to all tasks; what a document has of those terms is one row of sums. All other terms are shuffled once, as
    packed numbers, and counted where those of a term meet: a small share of all, as the term is not frequent. A task gets about
    TASK_TERMS of them, whatever the table, as it holds them in columns (``term_columns``). The sums that it has for each
    document are shuffled like that too, and added where those of a document meet.
    """
    spark = counted.sparkSession
    # Fewer than 1/FREQUENT_SHARE rows, so they may pass through the driver.
    few = frequent.toArrow()
    paired = "words" in counted.columns
    listed, found, key = _numbered_terms(counted, few, paired)
    counts = found.where(F.col("place").isNotNull() | F.col("rows").isNotNull()).groupBy("place").agg(
        F.sum("df").alias("df"), F.max("job_tf").alias("job_tf"), F.sum("rows").alias("rows")
    )
    df, job_tf, rows = np.zeros(few.num_rows, np.int64), np.zeros(few.num_rows, np.int32), 0
    for r in counts.toArrow().to_pylist():
        if r["place"] is None:
            rows = r["rows"]
        else:
            df[r["place"]], job_tf[r["place"]] = r["df"], r["job_tf"] or 0

    sized = attach(counted, sizes, "jd_id", F.col("pos"), small, "left").select("jd_id", "pos", "n", *_known_terms(counted))
    summed = StructType([*(counted.schema[c] for c in ("jd_id", "pos")), *(StructField(c, DoubleType()) for c in ("dot", "norm2"))])
    fields = {"task": StructField("task", IntegerType()), "jd_id": summed["jd_id"], "n": StructField("n", LongType()), "known": StructField("known", BooleanType())}
    fields |= {c: StructField(c, BinaryType()) for c in ("pos", "first", "last", "tf", "dot", "norm2")}
    apart, parts = StructType(list(fields.values())), StructType([fields[c] for c in ("task", "jd_id", "pos", "dot", "norm2")])
    tasks = max(-(-rows // TASK_TERMS), min(spark.sparkContext.defaultParallelism, -(-rows // FEWEST_TERMS)), 1)
    # No task hands on more sums than it has terms, and most hand on fewer.
    adding = max(tasks // 2, min(spark.sparkContext.defaultParallelism, tasks))
    split = sized.mapInArrow(term_columns.listed_sums(listed, df, job_tf, tasks, key, to_arrow_schema(apart)), apart)
    met = split.repartitionById(tasks, F.col("task"))
    partial = met.mapInArrow(term_columns.gathered_sums(JOB_POS, adding, to_arrow_schema(parts)), parts)
    added = partial.repartitionById(adding, F.col("task")).mapInArrow(term_columns.document_sums(to_arrow_schema(summed)), summed)
    return materialize(added, "term-products")


def _numbered_terms(counted: DataFrame, few: pa.Table, paired: bool) -> tuple[term_columns.TermList, DataFrame, int]:
    """The frequent terms, what every task counted of them, and the key under which no two words of the table have one number.

    The words and their numbers are compared wherever they stand in the table, once per task and word.
    """
    kinds = "place int, df long, job_tf int, rows long, number long, word string"
    for key in count():
        listed = term_columns.TermList(few, paired, key)
        body = term_columns.listed_counts(listed, JOB_POS, key)
        found = materialize(counted.select("jd_id", "pos", *_known_terms(counted)).mapInArrow(body, kinds), "listed-counts")
        # Dealt by number once, for both steps.
        words = found.where(F.col("word").isNotNull()).select("number", "word").repartition("number").distinct()
        if words.groupBy("number").count().where("count > 1").isEmpty():
            return listed, found, key


def _cosine() -> Column:
    """Cut to digits that do not change from run to run."""
    length = F.sqrt(F.col("norm2") * F.col("job_norm2"))
    return F.round(F.when(length > 0, F.col("dot") / length).otherwise(F.lit(0.0)), STABLE_DIGITS)


def cosine_with_job(members: DataFrame, jobs: DataFrame, stop_words: Sequence[str], small: bool) -> DataFrame:
    """TF-IDF cosine of every document with the job of its pool: ``(jd_id, pos, similarity)``.

    ``members`` is a parquet table with ``jd_id, pos, words``, read several times here;
    ``jobs`` has ``jd_id, text``, one for every pool (:func:`check_pools`), and ``small`` says that they are few.
    The result is a light step over a stored table.
    """
    columns = ["jd_id", "pos", "words"]
    own = add_joined_words(jobs.select("jd_id", F.lit(JOB_POS).cast("bigint").alias("pos"), "text"), stop_words)
    own = materialize(own.select(columns), "job-words")
    counted = members.select(columns).unionByName(own)
    sums = term_products(counted, corpus_sizes(counted), frequent_terms(members.select(columns)), small)
    norms = sums.where(F.col("pos") == JOB_POS).select("jd_id", F.col("norm2").alias("job_norm2"))
    together = attach(sums.where(F.col("pos") != JOB_POS), norms, "jd_id", F.col("pos"), small)
    return together.select("jd_id", "pos", _cosine().alias("similarity"))


def collection_norms(members: DataFrame) -> DataFrame:
    """``(pos, norm2)`` of a collection for which some job will be added: one more document, which changes no term yet.

    The dear part of TF-IDF: done once, it serves any number of jobs (:func:`cosine_with_jobs`).
    """
    counted = members.select(F.when(F.col("pos").isNotNull(), F.lit(0)).alias("jd_id"), "pos", *_known_terms(members))
    sizes = corpus_sizes(counted).withColumn("n", F.col("n") + 1)
    return term_products(counted, sizes, frequent_terms(counted), True).select("pos", "norm2")


def cosine_with_jobs(
    members: DataFrame, jobs: DataFrame, stop_words: Sequence[str], norms: DataFrame | None = None
) -> DataFrame:
    """TF-IDF cosine of every document of one collection with each of several jobs: ``(jd_id, pos, similarity)``.

    A job's text is part of its corpus, so it adds one to the document frequency of its own terms and leaves all others
    alone. ``norms`` (:func:`collection_norms`) are those without any job; per job they are put right by its terms only,
    ``tf'^2 (idf(df + 1)^2 - idf(df)^2)`` each, and the dot product needs no other terms either. The terms of all jobs are
    found in the rows of ``members`` (``pos`` and ``words`` or ``terms, counts``, a parquet table) by one join, which shuffles nothing while
    they are light enough to broadcast. A document without any of a job's terms has no row here.
    """
    norms = collection_norms(members) if norms is None else norms
    own = add_term_counts(jobs.select("jd_id", F.lit(JOB_POS).cast("bigint").alias("pos"), "text"), stop_words)
    asked = materialize(term_rows(own).select("jd_id", "term", F.col("tf").alias("job_tf")), "asked-terms")
    light = is_light(asked, ASKED_TERMS)
    n = F.lit(members.count() + 1)

    pairs = _with_terms(members).select("pos", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    rows = pairs.select("pos", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))
    hits = materialize(attach(rows, asked.select("term").distinct(), "term", F.col("pos"), light), "asked-rows")
    # One row per term of a job, at most.
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    before, after = smooth_idf(F.coalesce("df", F.lit(0)), n), smooth_idf(F.coalesce("df", F.lit(0)) + 1, n)
    weighted = asked.join(df, "term", "left").select(
        "jd_id", "term", (sublinear_tf(F.col("job_tf")) * after).alias("job_weight"), after.alias("idf"), (after * after - before * before).alias("gain")
    )
    weighted = materialize(weighted, "job-weights")
    lengths = weighted.groupBy("jd_id").agg(F.sum(F.col("job_weight") * F.col("job_weight")).alias("job_norm2"))
    tf = sublinear_tf(F.col("tf"))
    products = (
        attach(hits, weighted, "term", F.col("pos"), light)
        .groupBy("jd_id", "pos")
        .agg(F.sum(tf * F.col("idf") * F.col("job_weight")).alias("dot"), F.sum(tf * tf * F.col("gain")).alias("gain"))
    )
    # One row per job, of which there are few.
    met = products.join(norms, "pos").join(F.broadcast(lengths), "jd_id").withColumn("norm2", F.col("norm2") + F.col("gain"))
    return materialize(met.select("jd_id", "pos", _cosine().alias("similarity")), "job-cosines")


def tfidf_similarity(candidates: DataFrame, jobs: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Cosine of every candidate with its job: ``(jd_id, pos, similarity)``.

    ``candidates`` has ``jd_id, pos, text`` and ``jobs`` has ``jd_id, text``. A text that shares
    nothing with the job, or is empty, scores 0.
    """
    check_pools(candidates, jobs)
    stop_words = default_stop_words() if stop_words is None else stop_words
    texts = spread(candidates.select("jd_id", F.col("pos").cast("bigint").alias("pos"), "text"), "pos")
    members = materialize(add_joined_words(texts, stop_words).drop("text"), "words")
    return cosine_with_job(members, jobs, stop_words, is_small(jobs))


def dot_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def semantic_similarity(chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Mean of the best three chunks of every candidate: ``(jd_id, pos, similarity)``.

    ``chunks`` has ``jd_id, pos, vector`` with one row per chunk and ``queries`` has ``jd_id, vector``;
    the vectors are unit length and come from a model outside this library.
    """
    asked = queries.select("jd_id", F.col("vector").alias("_query"))
    met = attach(chunks.select("jd_id", "pos", "vector"), asked, "jd_id", F.col("pos"), is_small(asked))
    scored = met.select("jd_id", "pos", dot_product(F.col("vector"), F.col("_query")).alias("similarity"))
    best = first_rows(scored, ["jd_id", "pos"], [F.col("similarity").desc()], BEST_CHUNKS)
    return best.groupBy("jd_id", "pos").agg(F.round(F.avg("similarity"), STABLE_DIGITS).alias("similarity"))


def semantic_for_jobs(chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """:func:`semantic_similarity` of one collection with each of a handful of jobs; the chunks are read once.

    ``chunks`` has ``pos, vector`` and ``queries`` has ``jd_id, vector``. The jobs' vectors go to every chunk as one array and
    are scored inside the row; each task keeps the best three of a document and job before anything moves.
    """
    # One row; the caller sees to it that there are few jobs.
    one = queries.groupBy(F.when(F.col("vector").isNotNull(), F.lit(0)).alias("_all")).agg(
        F.collect_list(F.struct("jd_id", "vector")).alias("_asked")
    )
    rows = chunks.select("pos", "vector", F.when(F.col("vector").isNotNull(), F.lit(0)).alias("_all"))
    each = F.transform("_asked", lambda q: F.struct(q["jd_id"].alias("jd_id"), dot_product(F.col("vector"), q["vector"]).alias("similarity")))
    scored = rows.join(F.broadcast(one), "_all").select("pos", F.explode(each).alias("s")).select("s.jd_id", "pos", "s.similarity")
    best = first_rows(scored, ["jd_id", "pos"], [F.col("similarity").desc()], BEST_CHUNKS)
    return best.groupBy("jd_id", "pos").agg(F.round(F.avg("similarity"), STABLE_DIGITS).alias("similarity"))


def minmax(scores: DataFrame, column: str, name: str, small: bool) -> DataFrame:
    """Scale ``column`` to 0..1 within every pool; a pool without spread is clipped instead.

    Reads ``scores`` twice, for the bounds and for the rows, so they should be cheap to read. Similarities come cut
    to STABLE_DIGITS digits, so a pool whose spread is below that counts as one without spread.
    """
    bounds = scores.groupBy("jd_id").agg(
        F.min(column).alias("_low"), F.max(column).alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    x, low, high = F.col(column), F.col("_low"), F.col("_high")
    flat = (F.col("_n") < 2) | (high - low < 1e-12)
    scaled = F.when(flat, F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))).otherwise((x - low) / (high - low))
    return attach(scores, bounds, "jd_id", F.col("pos"), small).withColumn(name, scaled).drop("_low", "_high", "_n")
