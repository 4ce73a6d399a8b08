"""Spelling variants: words one letter apart, each led to the most frequent form.

The vocabulary is counted over all texts. Two words are near if exactly one code point is inserted, deleted or replaced.
An error lies in the left or in the right half of a word, so one half of it is matched as it is:

1. Every word is filed under the halves that a near word could ask for: two prefixes and two suffixes. It asks under its own
   left and right half. Files are dealt into shards by the hash of the half; a half that very many words share is cut into
   blocks of words and blocks of askers, each pair of blocks a shard of its own, so shards are bounded at every size.
2. A shard joins its words with delimiters and builds a bidirectional FM-index: suffix ranks of that text and of its reverse,
   whose intervals are kept in step, so that a match can grow at either end. All words that ask are searched at once: one
   half with its delimiter is matched from the middle outwards, then the match grows across the other half up to its
   delimiter with one error. An interval of suffix ranks over a whole delimited word is a near word.
3. Near words are counted, the most frequent one is the form, and forms of forms are followed by doubling the steps.

Defined results. A null text has no words, a null ``doc_id`` counts as an empty one where it is written into a checksum. Rows
that repeat a text or a ``doc_id`` each count. Very long texts are read in pieces that end between runs, and words have no
greatest length. An empty table gives an empty result. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import CRC_TABLE_SQL, crc32_sql, shuffle_partitions, table
from rankloom.runtime import materialize

LEAST_CHARS = 6
LEAST_COUNT = 5
# A form is at least so many times as frequent.
FORM_RATIO = 5
# Runs whose checksum this divides are written with one code point less.
SLIP_EVERY = 199
# A run of this many letters or fewer cannot become a word, slip or not.
RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_CHARS},}}")
LETTER = re.compile("[A-Za-zÀ-ÿ]")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

PIECE_CHARS = 1 << 20
# Counts are passed on when a task holds so many words, or so many characters of them.
HELD_WORDS, HELD_CHARS = 200_000, 8 << 20

# Words and askers of a shard, on average; a half that more words share is cut into blocks of this size.
SHARD_ROWS = 20_000
# Halves above the block size number fewer than this: rows / block size.
MOST_HOT = 20_000
# Askers searched at once in a shard.
ASKED_AT_ONCE = 4096
# Ranks between two rows of an index' table of counts.
STEP = 16

SENTINEL, DELIMITER = "\x00", "\x01"


# --- the vocabulary ---


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that do not cut a run."""
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        while end < len(text) and LETTER.match(text[end]):
            end += 1
        yield text[at:end] if at or end < len(text) else text
        at = end


def count_words(doc_id: int | None, text: str, into: Counter) -> int:
    """Add the words of a text to ``into``; returns how many characters of them there are."""
    head = "" if doc_id is None else str(doc_id)
    chars = 0
    for piece in _pieces(text):
        lower = piece.lower() if piece.isascii() else piece.translate(LOWER)
        for run, n in Counter(RUN.findall(lower)).items():
            h = zlib.crc32(f"{head}:{run}".encode())
            if h % SLIP_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < LEAST_CHARS:
                    continue
            into[run] += n
            chars += len(run)
    return chars


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, chars = Counter(), 0

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if text.is_valid:
                chars += count_words(doc_id.as_py(), text.as_py(), held)
            if len(held) > HELD_WORDS or chars > HELD_CHARS:
                yield passed_on()
                held, chars = Counter(), 0
    if held:
        yield passed_on()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words that occur often enough."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = rows.mapInArrow(_count_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


# --- the index ---


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """The suffix array, by sorting pairs of ranks twice as far apart in every round."""
    n = len(codes)
    rank, ahead = codes.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-ahead] = rank[ahead:] + 1
        key = rank * (max(n, int(rank.max()) + 1) + 2) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        ahead *= 2


class Ranks:
    """Suffix ranks of a text: intervals of suffixes that begin with a string grow by the letter before it."""

    def __init__(self, codes: np.ndarray, letters: int):
        n = len(codes)
        self.order = suffix_order(codes)
        width = letters + 2
        bwt = codes[self.order - 1]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=letters + 1))])
        # below[b, c]: how many of the first b * STEP letters of bwt are smaller than c.
        cells = (np.arange(n) // STEP + 1) * width + bwt + 1
        counts = np.bincount(cells, minlength=(n // STEP + 2) * width).reshape(-1, width)
        self.below = counts.cumsum(0).cumsum(1).astype(np.int32)
        self.bwt = np.concatenate([bwt, np.full(STEP, letters + 1)]).astype(np.int32)

    def _nearby(self, p: np.ndarray) -> np.ndarray:
        """The letters between the table's row and the rank ``p``; larger than all letters where there are none."""
        at = (p // STEP * STEP)[:, None] + np.arange(STEP)
        return np.where(at < p[:, None], self.bwt[at], self.start.size)

    def count(self, p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Among the first ``p`` letters, those smaller than ``c`` and those equal to it."""
        row, near = p // STEP, self._nearby(p)
        smaller = self.below[row, c]
        equal = self.below[row, c + 1] - smaller
        return smaller + (near < c[:, None]).sum(1), equal + (near == c[:, None]).sum(1)

    def count_all(self, p: np.ndarray) -> np.ndarray:
        """Among the first ``p`` letters, those smaller than each letter."""
        near, letters = self._nearby(p), np.arange(self.below.shape[1])
        total = self.below[p // STEP].astype(np.int64)
        for k in range(STEP):
            total += near[:, k : k + 1] < letters
        return total

    def grow(self, lo, other, size, c):
        """The intervals grown by the letter ``c``, and their start among the ranks of the reverse."""
        smaller, equal = self.count(lo, c)
        smaller_end, equal_end = self.count(lo + size, c)
        return self.start[c] + equal, other + smaller_end - smaller, equal_end - equal

    def grow_by_all(self, lo, other, size):
        """The same for every letter: one column each."""
        before, end = self.count_all(lo), self.count_all(lo + size)
        equal = np.diff(before, axis=1)
        return self.start[: equal.shape[1]] + equal, other[:, None] + (end - before)[:, :-1], np.diff(end, axis=1) - equal


class VariantIndex:
    """A bidirectional FM-index over delimited words that finds those one error away."""

    def __init__(self, words: list[str]):
        text = DELIMITER + DELIMITER.join(words) + DELIMITER
        points = np.frombuffer((text + SENTINEL).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.letters = len(self.alphabet)
        self.size = len(codes)
        self.left = Ranks(codes, self.letters)
        self.right = Ranks(np.concatenate([codes[-2::-1], codes[-1:]]), self.letters)
        # The word after the delimiter at each place.
        self.word_at = np.cumsum(codes == 1) - 1
        self.words = words

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Delimited patterns one after the other, where each begins, and the length of its word."""
        points = np.frombuffer("".join(f"{DELIMITER}{w}{DELIMITER}" for w in words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), self.letters - 1)
        # Letters that no word of the index has get a code of their own, which never matches.
        codes = np.where(self.alphabet[at] == points, at, self.letters)
        length = np.array([len(w) for w in words])
        return codes, np.concatenate([[0], np.cumsum(length + 2)[:-1]]), length

    def near(self, words: list[str], right_half_exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, number of an indexed word) one error apart, the error in the other half."""
        pattern, begin, length = self._encode(words)
        number = {w: i for i, w in enumerate(self.words)}
        own = np.array([number.get(w, -1) for w in words])
        half = length // 2
        # The half is matched from the middle outwards, at ``exact``; then the match grows at the other end, at ``open_end``.
        exact, open_end = (self.right, self.left) if right_half_exact else (self.left, self.right)
        outwards = 1 if right_half_exact else -1
        first, steps = (half + 1, length - half + 1) if right_half_exact else (half, half + 1)
        lo, other = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size = np.full(len(words), self.size)
        for k in range(int(steps.max(initial=0))):
            q = np.flatnonzero((steps > k) & (size > 0))
            c = pattern[begin[q] + first[q] + outwards * k]
            lo[q], other[q], size[q] = exact.grow(lo[q], other[q], size[q], c)

        inwards = -outwards
        last = np.zeros_like(length) if right_half_exact else length + 1
        q = np.arange(len(words))
        clean = self._others(np.stack([q, first - outwards, other, lo, size]), own, right_half_exact)
        wrong = np.zeros((5, 0), np.int64)
        found = []
        while clean.shape[1] or wrong.shape[1]:
            q, at, lo, other, size = wrong
            lo, other, size = open_end.grow(lo, other, size, pattern[begin[q] + at])
            whole = (at == last[q]) & (size > 0)
            start = lo if right_half_exact else other
            found.append(np.stack([q[whole], self.word_at[self.left.order[start[whole]]]]))
            on = (at != last[q]) & (size > 0)
            wrong = np.stack([q, at + inwards, lo, other, size])[:, on]

            q, at, lo, other, size = clean
            lows, others, sizes = open_end.grow_by_all(lo, other, size)
            c = pattern[begin[q] + at]
            letter = np.arange(sizes.shape[1])
            there = (sizes > 0) & (letter > 1)
            inside = at != last[q]
            replaced = there & (letter != c[:, None]) & inside[:, None]
            grown = [wrong, np.stack([q, at + inwards, lo, other, size])[:, inside]]
            for cells, step in ((there, 0), (replaced, inwards)):
                k, letters = np.nonzero(cells)
                grown.append(np.stack([q[k], at[k] + step, lows[k, letters], others[k, letters], sizes[k, letters]]))
            wrong = np.concatenate(grown, 1)
            k = np.flatnonzero(inside)
            same = c[k]
            clean = np.stack([q[k], at[k] + inwards, lows[k, same], others[k, same], sizes[k, same]])
            clean = self._others(clean, own, right_half_exact)
        pairs = np.unique(np.concatenate(found, 1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]

    def _others(self, states: np.ndarray, own: np.ndarray, right_half_exact: bool) -> np.ndarray:
        """States whose interval holds another word than the one that asks."""
        q, _, lo, other, size = states
        start = lo if right_half_exact else other
        place = self.left.order[np.minimum(start, self.size - 1)]
        # With the left half matched the string begins at the delimiter; with the right half, somewhere within the word.
        alone = (size == 1) & (self.word_at[place] == own[q])
        return states[:, (size > 0) & ~alone]


def _near_words(rows: pa.Table) -> pa.Table:
    """The pairs of a shard: (word, n, near, near_n)."""
    filed = rows.filter(pc.invert(rows.column("asks")))
    counts = dict(zip(filed.column("word").to_pylist(), filed.column("n").to_pylist()))
    names = ["word", "n", "near", "near_n"]
    out = []
    index = VariantIndex(sorted(counts)) if counts else None
    for right in (False, True) if counts else ():
        asking = rows.filter(pc.and_(rows.column("asks"), pc.equal(rows.column("right"), right)))
        words, n = asking.column("word").to_pylist(), asking.column("n").to_numpy()
        for k in range(0, len(words), ASKED_AT_ONCE):
            some = words[k : k + ASKED_AT_ONCE]
            q, found = index.near(some, right)
            near = [index.words[i] for i in found]
            columns = [[some[i] for i in q], n[k + q], near, [counts[w] for w in near]]
            out.append(pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, KINDS)], names=names))
    return pa.concat_tables(out) if out else pa.table([pa.array([], k) for k in KINDS], names=names)


KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64()]


# --- near words, forms and roots ---


def _filed(words: DataFrame) -> DataFrame:
    """``(right, half, asks, word, n)``: each word under the halves that near words have, and as one that asks under its own."""
    length = F.char_length("word")

    def under(right: bool, chars, asks: bool):
        half = F.right("word", chars) if right else F.left("word", chars)
        return F.struct(F.lit(right).alias("right"), half.alias("half"), F.lit(asks).alias("asks"))

    # Near words are one shorter, as long, or one longer; of three halves two have the same length.
    lower, upper = F.floor((length - 1) / 2).cast("int"), F.floor((length + 1) / 2).cast("int")
    lengths = {False: [lower, upper], True: [F.ceil((length - 1) / 2).cast("int"), F.ceil((length + 1) / 2).cast("int")]}
    own = {False: F.floor(length / 2).cast("int"), True: F.ceil(length / 2).cast("int")}
    places = [under(right, n, False) for right in (False, True) for n in lengths[right]]
    places += [under(right, own[right], True) for right in (False, True)]
    return words.select(F.explode(F.array(*places)).alias("at"), "word", "n").select("at.*", "word", "n")


def _sharded(filed: DataFrame) -> tuple[DataFrame, int]:
    """``filed`` with its shard, and the number of shards that hold the halves that few words share."""
    total = filed.count()
    block = max(SHARD_ROWS, total // MOST_HOT)
    shards = max(1, -(-total // SHARD_ROWS))
    asking = F.count(F.when(F.col("asks"), F.lit(1)))
    sizes = filed.groupBy("right", "half").agg(F.count(F.lit(1)).alias("rows"), asking.alias("askers"))
    blocks = [F.ceil(c / block).cast("int").alias(name) for c, name in ((F.col("rows") - F.col("askers"), "word_blocks"), (F.col("askers"), "asker_blocks"))]
    hot = materialize(sizes.where(F.col("rows") > block).select("right", "half", *blocks), "hot-halves")
    known = filed.join(F.broadcast(hot), ["right", "half"], "left")
    # A block of words meets every block of askers of its half, and the other way round.
    own = F.pmod(F.xxhash64("word"), F.when(F.col("asks"), F.col("asker_blocks")).otherwise(F.col("word_blocks")))
    met = F.when(F.col("asks"), F.col("word_blocks")).otherwise(F.col("asker_blocks"))
    each = known.withColumns({"own": own, "met": F.explode(F.when(met > 0, F.sequence(F.lit(0), met - 1)).otherwise(F.array(F.lit(0))))})
    pair = [F.when(F.col("asks"), F.col(a)).otherwise(F.col(b)).cast("long") for a, b in (("own", "met"), ("met", "own"))]
    hot_shard = shards + F.pmod(F.xxhash64("right", "half", *pair), F.lit(1 << 40))
    shard = F.when(F.col("word_blocks").isNull(), F.pmod(F.xxhash64("right", "half"), F.lit(shards))).otherwise(hot_shard)
    return each.select(shard.alias("shard"), "right", "asks", "word", "n"), shards


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: every pair of near words of a stored vocabulary ``(word, n)``, both ways round."""
    rows, shards = _sharded(_filed(words))
    # The number of tasks is given: adaptive execution would merge these small but dear groups by their bytes.
    tasks = min(shards, max(shuffle_partitions(words.sparkSession), words.sparkSession.sparkContext.defaultParallelism))
    dealt = rows.repartition(tasks, "shard")
    return dealt.groupBy("shard").applyInArrow(_near_words, "word string, n long, near string, near_n long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form (word, root): the last form of the chain. Counts grow along a chain, so it ends."""
    while True:
        nxt = forms.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = materialize(forms.join(nxt, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        forms = after.select("word", "root")


def group_variants(docs: DataFrame) -> DataFrame:
    """Per word of the vocabulary: ``word, form, root, n, n_near, form_n``."""
    words = materialize(vocabulary(docs), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    good = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = materialize(
        near.select("word", "n_near", F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return words.join(formed, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


# Words are near if they agree when each, or one of them, loses one code point.
SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{6,}}')) AS run FROM documents)
  GROUP BY ALL),
summed AS (SELECT run, n, {crc32_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs, crc),
written AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
         CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chains AS (
  SELECT word, form AS last FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.last FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.last, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends e USING (word)
"""
QUERIES = {"op11_spelling_variants": (op11_spelling_variants, SQL)}
