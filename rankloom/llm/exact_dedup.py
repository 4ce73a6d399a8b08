"""Exact deduplication with a cuckoo-filter index of live digests.

Texts are equal when they are identical without the characters of ``[\\x20\\x09-\\x0D]``; a null text counts as empty.
The index is split by a prefix of the SHA-256 digest. Each part is a cuckoo filter in front of bucketed content: a
filter miss proves that a digest is new, a hit is verified against the keys stored for that filter bucket. Insertions
that find no place after a number of evictions overflow: the filter doubles and is filled again from the stored keys.
Deleting the last live row of a digest takes its fingerprint out of the filter.

Defined results. Null and empty texts are one group. Of equal texts the row with the most code points in the original
text stays, then the smallest ``doc_id``; a null ``doc_id`` comes last. Rows that agree in text and ``doc_id`` all count
in ``group_size``. An empty table gives an empty result. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import SPACES, shuffle_partitions, table, text_or_empty
from rankloom.runtime import materialize

SLOTS = 4
MAX_KICKS = 200
NO_ID = np.iinfo(np.int64).max
GROUP = "digest binary, n_chars int, keep_id long, group_size long"


class CuckooIndex:
    """A cuckoo filter over digests plus the live keys that verify its hits.

    ``insert`` and ``delete`` count live rows per digest; ``find`` answers exactly.
    """

    def __init__(self, buckets: int = 1024):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.content: dict[int, dict[bytes, list]] = {}
        self.live = 0
        self.resizes = 0

    @staticmethod
    def _fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "big") or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[10:18], "big") & (self.buckets - 1)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 >> 5 & (self.buckets - 1))

    def _maybe(self, digest: bytes) -> bool:
        f = self._fingerprint(digest)
        one = self._home(digest)
        return f in self.table[one] or f in self.table[self._other(one, f)]

    def find(self, digest: bytes) -> list | None:
        """The entry of a live digest, else None. The stored keys are read only after a filter hit."""
        if not self._maybe(digest):
            return None
        return self.content.get(self._home(digest), {}).get(digest)

    def insert(self, digest: bytes, entry: list) -> None:
        """Add a digest that ``find`` did not find."""
        self.content.setdefault(self._home(digest), {})[digest] = entry
        self.live += 1
        if self.live > self.buckets * SLOTS * 0.9 or not self._place(self._home(digest), self._fingerprint(digest)):
            self._resize()

    def _place(self, bucket: int, fingerprint: int) -> bool:
        for b in (bucket, self._other(bucket, fingerprint)):
            for slot in range(SLOTS):
                if not self.table[b, slot]:
                    self.table[b, slot] = fingerprint
                    return True
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            fingerprint, self.table[b, slot] = int(self.table[b, slot]), fingerprint
            b = self._other(b, fingerprint)
            for free in range(SLOTS):
                if not self.table[b, free]:
                    self.table[b, free] = fingerprint
                    return True
        return False

    def _resize(self) -> None:
        """Double the filter and fill it again from the stored keys, until every one has a place."""
        keys = [item for bucket in self.content.values() for item in bucket.items()]
        while True:
            self.buckets *= 2
            self.resizes += 1
            self.table = np.zeros((self.buckets, SLOTS), np.uint16)
            if all(self._place(self._home(d), self._fingerprint(d)) for d, _ in keys):
                break
        self.content = {}
        for digest, entry in keys:
            self.content.setdefault(self._home(digest), {})[digest] = entry

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out of the filter and the stored keys."""
        if self.find(digest) is None:
            return False
        home, f = self._home(digest), self._fingerprint(digest)
        del self.content[home][digest]
        self.live -= 1
        for b in (home, self._other(home, f)):
            found = np.flatnonzero(self.table[b] == f)
            if len(found):
                self.table[b, found[0]] = 0
                return True
        raise AssertionError("a stored key has no fingerprint")

    def entries(self) -> Iterator[tuple[bytes, list]]:
        for bucket in self.content.values():
            yield from bucket.items()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold groups of equal digest through an index; one row per digest comes out."""
    index = CuckooIndex()
    for batch in batches:
        for digest, chars, keep, size in zip(*(c.to_pylist() for c in batch.columns)):
            keep = NO_ID if keep is None else keep
            entry = index.find(digest)
            if entry is None:
                index.insert(digest, [-chars, keep, size])
            else:
                if (-chars, keep) < (entry[0], entry[1]):
                    entry[0], entry[1] = -chars, keep
                entry[2] += size
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64()]
    rows = [(digest, -e[0], None if e[1] == NO_ID else e[1], e[2]) for digest, e in index.entries()]
    for at in range(0, len(rows), 10_000):
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows[at : at + 10_000]), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["digest", "n_chars", "keep_id", "group_size"])


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id, digest of the text without white space, code points of the text."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("digest"),
        F.char_length(text).alias("n_chars"),
    )


def groups(rows: DataFrame, parts: int) -> DataFrame:
    """The index content: one row per live digest with the row that stays and the number of rows.

    Every task first folds its own rows, so a digest reaches its index part at most once per task, however
    many copies there are.
    """
    ones = rows.select("digest", "n_chars", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    partial = ones.mapInArrow(_fold, GROUP)
    return partial.repartition(parts, F.substring("digest", 1, 4)).mapInArrow(_fold, GROUP)


def _ordered(docs: DataFrame) -> DataFrame:
    return groups(docs, shuffle_partitions(docs.sparkSession))


def delete_rows(index: DataFrame, live: DataFrame, gone: DataFrame) -> DataFrame:
    """The index after rows leave: digests without a live row go, others are folded again from the rows left.

    ``live`` and ``gone`` have the columns of ``digests``; rows are told apart by ``doc_id``.
    """
    touched = gone.select("digest").distinct()
    left = live.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").join(touched, "digest", "left_semi")
    return index.join(touched, "digest", "left_anti").unionByName(_ordered(left))


def mark_copies(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256.

    Groups with over a thousandth of all rows number under a thousand by arithmetic; only these are broadcast,
    the others meet their rows in a shuffled join whose keys are all small.
    """
    rows = materialize(digests(docs), "digests")
    index = materialize(_ordered(rows), "digest-groups")
    heavy_from = max(1000, rows.count() // 1000)
    heavy = F.broadcast(index.where(F.col("group_size") > heavy_from).select("digest", "n_chars", "keep_id", "group_size"))
    light = index.where(F.col("group_size") <= heavy_from)
    many = rows.select("doc_id", "digest", F.col("n_chars").alias("own_chars")).join(heavy, "digest")
    few = (
        rows.select("doc_id", "digest", F.col("n_chars").alias("own_chars"))
        .join(heavy.select("digest"), "digest", "left_anti")
        .join(light, "digest")
    )
    return many.unionByName(few).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("own_chars") == F.col("n_chars"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Rows equal in text and doc_id stay once.

    The texts move once: the join and the removal of repeated rows share one partitioning.
    """
    index = materialize(_ordered(digests(docs)), "digest-groups")
    no_id = F.lit(NO_ID).cast("long")
    keys = ["_keep", "_digest", "_chars"]
    keep = index.select(
        F.coalesce("keep_id", no_id).alias("_keep"), F.col("digest").alias("_digest"), F.col("n_chars").alias("_chars")
    )
    text = text_or_empty()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias("_keep"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("_digest"),
        F.char_length(text).alias("_chars"),
    )
    return marked.join(keep, keys, "left_semi").dropDuplicates(keys).select("_row.*")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""
QUERIES = {"op7_exact_dedup": (op7_exact_dedup, SQL)}
