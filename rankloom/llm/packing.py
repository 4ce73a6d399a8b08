"""Order-preserving packing of documents into training sequences by dynamic programming.

Documents are tokenized, each followed by an end id, and kept in order of ``doc_id``. Window cuts are chosen so that
padding plus cut penalties are least: a cut is free at the end of a document, cheap at the end of a sentence and dear
elsewhere; a window that is not full is padded unless its length is a power of two. With best(j) the least cost of the
ids before cut j, the cost of a padded window from i is best(i) + place(i) plus terms of j alone, so the best i among the
windows that fit is the head of a monotone queue; the few starts at a distance of a power of two are tried one by one.

The table is dealt into ranges of ``doc_id`` (ties by a hash of the text, so that rows without an id or with equal ids
split too). Every range is packed as a stream in blocks of bounded size: all windows of a block but the last are final,
and the last is packed again with the next block. Sequence numbers are made gapless at the end from one count per range.

Defined results. A null text counts as empty and is its end id alone. Documents without ``doc_id`` come first. Repeated
rows are packed each on their own. A document longer than a sequence is cut. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.common import grown, shuffle_partitions, table, text_or_empty
from rankloom.runtime import materialize

LENGTH = 4096
END_ID = 2
SENTENCE_CUT = 8
OTHER_CUT = 64
# Where no sentence ends for this many ids, cuts are possible at this distance.
OTHER_EVERY = 64
PER_SEQUENCE = 1
BLOCK_IDS = 1 << 19
RUN_BYTES = 1 << 22
# Beyond MOST_WORDS, and at the end of a task, all but the KEPT_WORDS met first are forgotten: those are the common ones.
MOST_WORDS, KEPT_WORDS = 400_000, 100_000
# A character that the vocabulary keeps apart and gives one id.
FENCE = "\x01"

KINDS = {
    **{c: pa.int64() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")},
    "range": pa.int32(),
    **{c: pa.int64() for c in ("local_sequence", "offset")},
    "ids": pa.binary(),
}
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, range int, local_sequence long, offset long, ids binary"


class _Lists:
    """Lists of small ids, one after the other, added in bulk."""

    def __init__(self):
        self.flat, self.begin, self.count = np.zeros(1 << 16, np.uint16), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.n = self.used = 0

    def add(self, ids: np.ndarray, count: np.ndarray) -> None:
        self.flat = grown(self.flat, self.used, self.used + len(ids))
        self.begin, self.count = (grown(x, self.n, self.n + len(count)) for x in (self.begin, self.count))
        new = slice(self.n, self.n + len(count))
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[new] = self.used + np.cumsum(count) - count
        self.count[new] = count
        self.n, self.used = self.n + len(count), self.used + len(ids)

    def keep(self, n: int) -> None:
        """Forget all but the first ``n`` lists."""
        if n < self.n:
            self.n, self.used = n, int(self.begin[n])
            self.flat, self.begin, self.count = self.flat[: self.used].copy(), self.begin[:n].copy(), self.count[:n].copy()

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chosen lists in a row, and the place behind each."""
        n = self.count[which].astype(np.int64)
        behind = np.cumsum(n)
        return self.flat[np.repeat(self.begin[which] - behind + n, n) + np.arange(behind[-1] if len(behind) else 0)], behind


class WordIds:
    """Ids of texts, word by word: the vocabulary drops white space, so a text's ids are those of its words in turn.

    Words are cut at blanks and line feeds only. A word of letters and one mark behind them is the letters' ids (its stem)
    and the mark's, as the vocabulary splits letters from other characters; it lower-cases letters, and so does this.
    Arrow splits texts and finds their distinct words; only distinct stems become Python strings. Ids of stems are kept
    until there are too many; then those met early, the common ones, stay.
    """

    MARKS = ".,;:!?"
    # All letters below U+0250; beyond, tables of what a letter is can differ.
    LETTERS = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        # Byte-level vocabularies write bytes that are no visible characters as those from 256 on, in order.
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
        self.alphabet = {b: 256 + i for i, b in enumerate(hidden)}
        (self.fence,) = self._encode(FENCE)
        self.code: dict = {}
        self.stems = _Lists()
        # Codes of these: 0 for nothing, then the marks in turn.
        self._learn(["", *self.MARKS])

    def _encode(self, text: str) -> list[int]:
        # Without the offsets into the text, which take a third of the time.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _add(self, stems: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        self.code.update(zip(stems, range(self.stems.n, self.stems.n + len(stems))))
        self.stems.add(ids, count)

    def _learn(self, stems: list[str]) -> None:
        # Lower-case letters come to the merges as they are but for the alphabet that stands for their bytes; the rest of
        # the tokenizer has nothing to do.
        tokenize, alphabet = self.merges.tokenize, self.alphabet
        letters, merged, others = [], [], []
        for s in stems:
            if s.isalpha() and s.islower():
                if s.isascii():
                    letters.append(s)
                    merged.append([t.id for t in tokenize(s)])
                    continue
                if max(s) < "\u0250":
                    letters.append(s)
                    merged.append([t.id for t in tokenize(s.encode().decode("latin-1").translate(alphabet))])
                    continue
            others.append(s)
        if letters:
            count = np.fromiter(map(len, merged), np.int64, len(merged))
            self._add(letters, np.fromiter(chain.from_iterable(merged), np.uint16, int(count.sum())), count)
        plain = [s for s in others if "<|" not in s and FENCE not in s]
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids = np.array(self._encode(f" {FENCE} ".join(some)), np.uint16)
            fences = ids == self.fence
            self._add(some, ids[~fences], np.diff(np.concatenate([[-1], np.flatnonzero(fences), [len(ids)]])) - 1)
        for s in others:
            if "<|" in s or FENCE in s:
                ids = np.array(self._encode(s), np.uint16)
                self._add([s], ids, np.array([len(ids)]))

    def trim(self) -> None:
        """Forget all but the stems met first."""
        if len(self.code) > KEPT_WORDS:
            self.code = {s: i for s, i in self.code.items() if i < KEPT_WORDS}
            self.stems.keep(KEPT_WORDS)

    def _codes(self, stems: list[str]) -> np.ndarray:
        if len(self.code) > MOST_WORDS:
            self.trim()
        known = np.fromiter(map(self.code.get, stems, repeat(-1)), np.int64, len(stems))
        new = np.flatnonzero(known < 0)
        if len(new):
            missed = [stems[i] for i in new.tolist()]
            self._learn(missed)
            known[new] = np.fromiter(map(self.code.__getitem__, missed), np.int64, len(missed))
        return known

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words the codes of their stems and of the marks behind them."""
        last = pc.utf8_slice_codeunits(words, -1)
        but_last = pc.utf8_slice_codeunits(words, 0, -1)
        mark = pc.index_in(last, pa.array(list(self.MARKS))).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        marked = (mark > 0) & pc.match_substring_regex(but_last, self.LETTERS).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(marked), but_last, words)
        # Markers are found in the text as it is, everything else in lower case.
        lowered = pc.and_(pc.string_is_ascii(stems), pc.invert(pc.match_substring(stems, "<|")))
        stems = pc.if_else(lowered, pc.ascii_lower(stems), stems)
        capital = pc.and_(pc.invert(pc.string_is_ascii(stems)), pc.match_substring_regex(stems, self.LETTERS))
        at = np.flatnonzero(capital.to_numpy(zero_copy_only=False))
        if len(at):
            small = [s.lower() for s in stems.take(pa.array(at)).to_numpy(zero_copy_only=False)]
            stems = pc.replace_with_mask(stems, capital, pa.array(small, stems.type))
        distinct = stems.dictionary_encode()
        codes = self._codes(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        return codes[distinct.indices.to_numpy()], np.where(marked, mark, 0)

    def __call__(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, the place behind each text's end id, and the places behind ends of sentences."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        stems, marks = self._words(coded.dictionary)
        # The ids of each distinct word, and of the end of a text behind them.
        parts = np.stack([stems, marks], axis=1)
        ids, _ = self.stems.take(parts.ravel())
        table = _Lists()
        table.add(ids, self.stems.count[parts].sum(1))
        table.add(np.array([END_ID], np.uint16), np.array([1]))
        ends = np.append(pc.is_in(pc.utf8_slice_codeunits(coded.dictionary, -1), pa.array([".", "!", "?"])).to_numpy(zero_copy_only=False), False)
        end = len(stems)
        behind_text = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        code = np.insert(coded.indices.to_numpy().astype(np.int32), behind_text, end)
        ids, behind = table.take(code)
        return ids, behind[code == end], behind[ends[code]]


def choose_cuts(ends: np.ndarray, sentences: np.ndarray, total: int, length: int = LENGTH) -> tuple[np.ndarray, int]:
    """The cuts of least cost through ``total`` ids: window ends in order, and the cost.

    ``ends`` are the places behind documents, ``sentences`` those behind sentences.
    """
    penalty = np.full(total + 1, -1, np.int16)
    fixed = np.unique(np.concatenate([[0], sentences, ends, [total]]))
    gaps = np.flatnonzero(np.diff(fixed) > OTHER_EVERY)
    for g in gaps:
        penalty[fixed[g] : fixed[g + 1] : OTHER_EVERY] = OTHER_CUT
    penalty[sentences] = SENTENCE_CUT
    penalty[ends] = 0
    penalty[0] = penalty[total] = 0
    places = np.flatnonzero(penalty >= 0)
    number = np.full(total + 1, -1, np.int32)
    number[places] = np.arange(len(places))
    whole = []
    power = 1
    while power <= length:
        late = places[places >= power]
        at = number[late - power]
        hit = at >= 0
        whole.append(np.stack([number[late[hit]], at[hit]]))
        power *= 2
    pairs = np.concatenate(whole, axis=1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    first = np.searchsorted(pairs[0], np.arange(len(places) + 1)).tolist()
    from_ = pairs[1].tolist()
    place, cost = places.tolist(), penalty[places].tolist()
    best, back = [0] * len(place), [0] * len(place)
    queue: deque = deque([0])
    for j in range(1, len(place)):
        p = place[j]
        while place[queue[0]] < p - length:
            queue.popleft()
        i = queue[0]
        least, prior = best[i] + place[i] + length - p, i
        for k in range(first[j], first[j + 1]):
            if best[from_[k]] < least:
                least, prior = best[from_[k]], from_[k]
        best[j], back[j] = least + cost[j] + PER_SEQUENCE, prior
        key = best[j] + p
        while queue and best[queue[-1]] + place[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts = []
    j = len(place) - 1
    while j:
        cuts.append(place[j])
        j = back[j]
    return np.array(cuts[::-1], np.int64), best[-1] if len(place) > 1 else 0


class Packer:
    """Packs a stream of documents; holds the ids that have no final window yet."""

    def __init__(self, length: int, with_ids: bool):
        self.length, self.with_ids, self.sequence = length, with_ids, 0
        self.ids, self.docs = np.zeros(0, np.uint16), []
        self.sentences = np.zeros(0, np.int64)

    def add(self, doc_ids: list, ids: np.ndarray, ends: np.ndarray, sentences: np.ndarray) -> None:
        shift = len(self.ids)
        begin = 0
        for doc_id, end in zip(doc_ids, ends.tolist()):
            # doc_id, place of its first id (before this block if negative), place behind its last
            self.docs.append([doc_id, shift + begin, shift + end])
            begin = end
        self.ids = np.concatenate([self.ids, ids])
        self.sentences = np.concatenate([self.sentences, sentences + shift])

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of all windows that are final."""
        if not len(self.ids):
            return []
        cuts, _ = choose_cuts(np.array([d[2] for d in self.docs]), self.sentences, len(self.ids), self.length)
        if not last:
            cuts = cuts[:-1]
            if not len(cuts):
                return []
        rows, d = [], 0
        begin = 0
        wide = self.ids.astype("<u4")
        for end in cuts.tolist():
            at = begin
            while at < end:
                doc_id, first, behind = self.docs[d]
                stop = min(end, behind)
                raw = wide[at:stop].tobytes()
                rows.append(
                    (doc_id, at - first, stop - at, zlib.crc32(raw), behind - first, self.sequence, at - begin, raw if self.with_ids else None)
                )
                at = stop
                d += stop == behind
            begin = end
            self.sequence += 1
        self.ids = self.ids[begin:]
        self.sentences = self.sentences[self.sentences > begin] - begin
        self.docs = [[i, a - begin, b - begin] for i, a, b in self.docs[d:]]
        return rows


_WORDS: dict[str, WordIds] = {}


def pack_ranges(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """Pack ``docs`` (doc_id, text): one row per piece with its range and the number of its sequence in there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer not in _WORDS:
            _WORDS[tokenizer] = WordIds(tokenizer)
        words = _WORDS[tokenizer]
        packer, part = Packer(length, with_ids), TaskContext.get().partitionId()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(KINDS)
            columns.insert(5, [part] * len(rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS.values())], names=list(KINDS))

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
            # Some megabytes of texts at a time, or one longer text.
            begins = np.flatnonzero(np.diff(size // RUN_BYTES, prepend=-1)).tolist()
            for at, behind in zip(begins, [*begins[1:], len(texts)]):
                packer.add(ids[at:behind], *words(texts.slice(at, behind - at)))
                if len(packer.ids) >= BLOCK_IDS:
                    yield out(packer.flush(last=False))
        yield out(packer.flush(last=True))
        # The worker lives on, for tasks of other kinds too.
        words.trim()

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_tie"))
    parts = shuffle_partitions(docs.sparkSession)
    dealt = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    return dealt.mapInArrow(run, PIECE)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """``pack_ranges`` with ``sequence_id`` gapless from 0 over all ranges, in order of the documents."""
    pieces = materialize(pack_ranges(docs, tokenizer, length, with_ids), "pieces")
    # One row per range, as many as there are shuffle partitions.
    counts = pieces.groupBy("range").agg((F.max("local_sequence") + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select("range", before.cast("long").alias("_shift"))
    return (
        pieces.join(F.broadcast(shifts), "range")
        .withColumn("sequence_id", F.col("local_sequence") + F.col("_shift"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
    )


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_vocabulary(), with_ids=False)


QUERIES = {"op1_packing": (op1_packing, None)}
