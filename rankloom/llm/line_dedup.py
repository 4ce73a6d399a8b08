"""Removal of lines that many documents share.

A line's key is the line without white space at both ends, A-Z in lower case. Lines are exploded and hashed, documents
are counted per hash, and lines whose key is long enough and occurs in enough documents go, except in the largest
``doc_id`` that holds it. What is left of a document is put together again by position.

Only hashes and positions are shuffled for this; every task counts its own rows first. Hashes with over a thousandth of
all such rows number fewer than a thousand by arithmetic and are broadcast; the lines of all others meet their hash in a
shuffled join of small groups. The texts move once, to the positions of the lines that they lose.

Defined results. A null text counts as empty, and an empty text is one empty line. Every row is a document: rows that
repeat a text each count, lines that a document repeats count once, and rows that share the largest ``doc_id`` of a key
all keep it. A null ``doc_id`` comes before all others. A document that loses all its lines is empty. An empty table gives
an empty result. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import SPACES, table, text_or_empty
from rankloom.runtime import materialize

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
# A hash with more rows than this share of all, and than this number, is broadcast.
HEAVY_SHARE = 1 / 1000
HEAVY_ROWS = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Stands for a null doc_id; no other one is smaller.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, UPPER.lower()))


def _hash(line: Column, least_chars: int) -> Column:
    """128 bits of the line's key, far from any collision at 10^12 lines; null for short ones."""
    key = line_key(line)
    # A key is never longer than its line: most short lines are told without it.
    long_enough = (F.octet_length(line) >= least_chars) & (F.char_length(key) >= least_chars)
    return F.when(long_enough, F.unhex(F.md5(key.cast("binary"))))


def _owner(docs: DataFrame) -> list[Column]:
    """What tells documents apart: rows that agree in both lose the same lines."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long"))
    return [doc.alias("_doc"), F.unhex(F.md5(text_or_empty().cast("binary"))).alias("_digest")]


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(_doc, _digest, hashes)``: per document the hashes of its lines in order, null for short lines."""
    hashes = F.transform(F.split(text_or_empty(), "\n"), lambda line: _hash(line, least_chars))
    return docs.select(*_owner(docs), hashes.alias("hashes")).where(F.exists("hashes", lambda h: h.isNotNull()))


def shared_lines(hashed: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(hash, keeper, documents)`` of the lines that at least ``least_documents`` documents hold."""
    held = F.array_distinct(F.filter("hashes", lambda h: h.isNotNull()))
    counts = hashed.select("_doc", F.explode(held).alias("hash")).groupBy("hash")
    counted = counts.agg(F.max("_doc").alias("keeper"), F.count(F.lit(1)).alias("documents"))
    return counted.where(F.col("documents") >= least_documents)


def dropped_lines(hashed: DataFrame, shared: DataFrame) -> DataFrame:
    """``(_doc, _digest, gone)``: the positions, from 0, of the lines that each document loses. Both tables are stored ones."""
    rows = shared.agg(F.sum("documents")).first()[0] or 0
    is_heavy = F.col("documents") > max(HEAVY_ROWS, int(rows * HEAVY_SHARE))
    heavy = F.broadcast(shared.where(is_heavy).select("hash", "keeper"))
    lines = hashed.select("_doc", "_digest", F.posexplode("hashes").alias("pos", "hash")).where(F.col("hash").isNotNull())
    many = lines.join(heavy, "hash")
    few = lines.join(heavy, "hash", "left_anti").join(shared.where(~is_heavy).select("hash", "keeper"), "hash")
    lost = many.unionByName(few).where(F.col("_doc") != F.col("keeper"))
    return lost.groupBy("_doc", "_digest").agg(F.collect_set("pos").alias("gone"))


def split_documents(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(row, lines, gone)``: every row of ``docs`` with its lines and the positions that it loses (null: none)."""
    hashed = materialize(hashed_lines(docs, least_chars), "line-hashes")
    shared = materialize(shared_lines(hashed, least_documents), "shared-lines")
    gone = dropped_lines(hashed, shared)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_owner(docs))
    return rows.join(gone, ["_doc", "_digest"], "left").select(
        "row", F.split(text_or_empty("row.text"), "\n").alias("lines"), "gone"
    )


def _kept() -> Column:
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(places, F.col("gone")), lambda p: F.get("lines", p))
    return F.when(F.col("gone").isNull(), text_or_empty("row.text")).otherwise(F.array_join(left, "\n"))


def drop_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with the lines that stay as ``text``; all other columns as they are."""
    split = split_documents(docs, least_chars, least_documents)
    return split.select(*[_kept().alias(c) if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_documents(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept().cast("binary"), 256).alias("kept_sha256"),
    )


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
QUERIES = {"op12_line_dedup": (op12_line_dedup, SQL)}
