"""The counting of terms over columns of rows: Spark deals and moves the rows, numpy counts and sums those of a task.

Every public function makes the body of a ``mapInArrow``. Rows have ``jd_id, pos``, either ``words`` or ``terms, counts``, and ``n``, the
documents of their pool; a row without a pool has no ``n`` and takes part in nothing.

A term is two numbers, those of its first and its last word; a token has no first word and 0 in its place, and so has a term that
comes as one text. The numbers are keyed hashes of words: :func:`listed_counts` hands on which word has which, for the caller to see
that no two words share one and to take another ``key`` if they do. So terms are equal exactly if their numbers are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.terms import counted_numbers, counted_pairs
from ..functions.text_columns import Texts, codes, strings_at

# Documents that a task works on at once, rows that it hands on at once.
DOCUMENTS_AT_ONCE, ROWS_AT_ONCE = 2_000, 200_000

# Odd factors for mixing numbers.
_FACTORS = np.random.default_rng(64).integers(1 << 62, 1 << 63, 4, np.uint64) | np.uint64(1)

Batches = Iterable[pa.RecordBatch]


def _weight(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(tf)) * idf


def _idf(df: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.log((1.0 + n) / (1.0 + df)) + 1


def _job_weight(job_tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """0 where the job does not have the term."""
    return np.where(job_tf > 0, _weight(np.maximum(job_tf, 1), idf), 0.0)


def _numbers(values: pa.Array | pa.ChunkedArray, missing: int = 0) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.fill_null(missing).to_numpy(zero_copy_only=False)


def _is(values: pa.Array, number: int) -> np.ndarray:
    return pc.fill_null(pc.equal(values, number), False).to_numpy(zero_copy_only=False)


def _numbered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, key: int) -> np.ndarray:
    """A number other than 0 for every piece, mixed from its bytes, eight at a time, and its size."""
    found = np.full(len(starts), key, np.uint64) * _FACTORS[3] + sizes.astype(np.uint64) * _FACTORS[0]
    rest = np.arange(len(starts))
    for done in range(0, int(sizes.max(initial=0)), 8):
        rest = rest[sizes[rest] > done] if done else rest
        mixed = (found[rest] ^ codes(data, starts[rest] + done, sizes[rest] - done).view(np.uint64)) * _FACTORS[1]
        found[rest] = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[2]
    return (found ^ (found >> np.uint64(29)) | np.uint64(1)).view(np.int64)


def word_numbers(words: pa.Array, key: int) -> np.ndarray:
    """A number other than 0 for every word."""
    texts = Texts(words)
    return _numbered(texts.data, texts.begins, texts.ends - texts.begins, key)


def _other_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The places of words that are not the same as the word at the place ``first`` of each."""
    differ = sizes != sizes[first]
    rest = np.flatnonzero(~differ)
    for done in range(0, int(sizes.max(initial=0)), 8):
        rest = rest[sizes[rest] > done] if done else rest
        here, there = (codes(data, starts[x] + done, sizes[rest] - done) for x in (rest, first[rest]))
        differ[rest[here != there]] = True
    return np.flatnonzero(differ)


def _mixed(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One number of two, well mixed in its upper bits."""
    mixed = first.view(np.uint64) * _FACTORS[0] + last.view(np.uint64) * _FACTORS[1]
    return (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[2]


class TermList:
    """A few ``(jd_id, term)``, by their place in the table that they come from. ``paired`` terms are words and pairs of words."""

    def __init__(self, rows: pa.Table, paired: bool, key: int):
        self.size = rows.num_rows
        self.pools = pc.unique(rows.column("jd_id"))
        texts = rows.column("term").combine_chunks().cast(pa.string())
        if paired:
            parts = pc.split_pattern(texts, " ")
            ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
            numbers = word_numbers(parts.flatten(), key)
            last = numbers[ends - 1]
            single = np.diff(ends, prepend=0) == 1
            first = np.where(single, 0, numbers[np.maximum(ends - 2, 0)]) if self.size else last
        else:
            last = word_numbers(texts, key)
            first = np.zeros(len(last), np.int64)
        # The words of the list in order, 0 among them.
        self.words = np.unique(np.concatenate([[0], first, last]))
        pool = _numbers(pc.index_in(rows.column("jd_id"), value_set=self.pools), -1)
        self.keys = pd.Index(self._key(pool, *(np.searchsorted(self.words, x) for x in (first, last))))

    def _key(self, pool: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        many = len(self.words)
        return (pool.astype(np.int64) * many + first) * many + last

    def known(self, numbers: np.ndarray) -> np.ndarray:
        """The place of words among those of the list, -1 for others."""
        at = np.minimum(np.searchsorted(self.words, numbers), len(self.words) - 1)
        return np.where(self.words[at] == numbers, at, -1)

    def pool_of(self, pools: pa.Array) -> np.ndarray:
        return _numbers(pc.index_in(pools, value_set=self.pools), -1)

    def find(self, pool: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The place in the list of terms given by places of pools and words, -1 for those not in it."""
        found = np.full(len(last), -1, np.int64)
        some = np.flatnonzero((pool >= 0) & (first >= 0) & (last >= 0)) if self.size else []
        if len(some):
            found[some] = self.keys.get_indexer(self._key(pool[some], first[some], last[some]))
        return found


def _pieces(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
            yield batch.slice(start, DOCUMENTS_AT_ONCE)


class _Terms:
    """All terms of all rows: their first and last words as places in ``numbers``, those of the words with a 0 before them,
    how often each occurs, and the row of each, in order of the rows. Where ``named``, also the ``words`` of these numbers; words
    that have the number of another one follow at the end, with that number once more."""

    def __init__(self, batch: pa.RecordBatch, key: int, named: bool = False):
        if "words" in batch.schema.names and not pa.types.is_list(batch.column("words").type):
            self._of_joined(batch.column("words"), key, named)
            return
        if "words" in batch.schema.names:
            self.words, first, last, self.tf, self.row_of = counted_pairs(batch.column("words"))
            self.first, self.last = first + 1, last + 1
        else:
            terms, counts = batch.column("terms"), batch.column("counts")
            self.row_of = np.repeat(np.arange(batch.num_rows), _numbers(pc.list_value_length(terms)))
            found = terms.flatten().dictionary_encode()
            self.words, self.last = found.dictionary, found.indices.to_numpy().astype(np.int64) + 1
            self.first, self.tf = np.zeros_like(self.last), counts.flatten().to_numpy()
        self.numbers = np.append([0], word_numbers(self.words, key))

    def _of_joined(self, words: pa.Array, key: int, named: bool) -> None:
        texts = Texts(words)
        blanks = np.flatnonzero(texts.data[: texts.ends[-1] + 1 if len(words) else 1] == 32)
        sizes = np.diff(blanks) - 1
        starts, sizes = blanks[:-1][sizes > 0] + 1, sizes[sizes > 0]
        row_of = np.repeat(np.arange(len(words)), np.diff(np.searchsorted(starts, np.append(texts.begins, len(texts.data)))))
        word, numbers = pd.factorize(_numbered(texts.data, starts, sizes, key))
        first, last, self.tf, self.row_of = counted_numbers(row_of, word, len(numbers), len(words))
        self.first, self.last = first + 1, last + 1
        if named:
            at = np.empty(len(numbers), np.int64)
            at[word[::-1]] = np.arange(len(word))[::-1]
            at = np.append(at, _other_words(texts.data, starts, sizes, at[word]))
            numbers, self.words = numbers[word[at]], strings_at(texts.data, starts[at], sizes[at])
        self.numbers = np.append([0], numbers)


def listed_counts(frequent: TermList, job_pos: int, key: int) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Per task ``(place, df, job_tf)`` of the listed terms it has, ``(number, word)`` of its words, and one row with its other terms as ``rows``."""

    def row(size: int, **columns: pa.Array) -> pa.RecordBatch:
        kinds = {"place": pa.int32(), "df": pa.int64(), "job_tf": pa.int32(), "rows": pa.int64(), "number": pa.int64(), "word": pa.string()}
        return pa.RecordBatch.from_pydict({c: columns.get(c, pa.nulls(size, t)).cast(t) for c, t in kinds.items()})

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        df, job_tf = np.zeros(frequent.size, np.int64), np.zeros(frequent.size, np.int32)
        rows, seen = 0, set()
        for batch in _pieces(batches):
            found = _Terms(batch, key, named=True)
            known = frequent.known(found.numbers)
            place = frequent.find(frequent.pool_of(batch.column("jd_id"))[found.row_of], known[found.first], known[found.last])
            rows += int((place < 0).sum())
            df += np.bincount(place[place >= 0], minlength=frequent.size)
            asked = (place >= 0) & _is(batch.column("pos"), job_pos)[found.row_of]
            np.maximum.at(job_tf, place[asked], found.tf[asked])
            words = found.words.to_numpy(zero_copy_only=False).tolist()
            new = np.flatnonzero([w not in seen for w in words])
            seen.update(words)
            yield row(len(new), number=pa.array(found.numbers[1:][new]), word=found.words.take(pa.array(new)))
        here = np.flatnonzero(df)
        yield row(len(here), place=pa.array(here), df=pa.array(df[here]), job_tf=pa.array(job_tf[here]))
        yield row(1, rows=pa.array([rows]))

    return count


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Numbers as one binary value per part, which moves as a whole."""
    ends = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(batches: list[pa.RecordBatch], column: str, kind: type) -> np.ndarray:
    """All numbers of a packed column, one after the other; a null holds none."""
    found = [np.zeros(0, kind)]
    for batch in batches:
        values = batch.column(column)
        _, ends, data = values.buffers()
        if data is not None:
            first, last = np.frombuffer(ends, np.int32)[[values.offset, values.offset + len(values)]]
            found.append(np.frombuffer(data, np.uint8)[first:last].view(kind))
    return np.concatenate(found)


def _rows_of(batches: list[pa.RecordBatch]) -> np.ndarray:
    """The row of each number in the packed ``pos``."""
    sizes = np.concatenate([_numbers(pc.binary_length(b.column("pos"))) for b in batches]) // 8
    return np.repeat(np.arange(len(sizes)), sizes)


def _parts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where in it each key begins, with the end."""
    # Short numbers are sorted digit by digit.
    order = np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")
    begins = np.flatnonzero(np.diff(key[order], prepend=-1))
    return order, np.append(begins, len(key))


def _batch(out: pa.Schema, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(columns, out, strict=True)], schema=out)


def listed_sums(
    frequent: TermList, df: np.ndarray, job_tf: np.ndarray, tasks: int, key: int, out: pa.Schema
) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Rows ``(task, jd_id, n, known, pos, first, last, tf, dot, norm2)``, with packed numbers from ``pos`` on.

    For listed terms the sums ``dot`` and ``norm2`` of each document, without a term and ``tf``; for all other terms the
    document, the term and how often it occurs. All of a term go to one task. A row has what a batch has for one pool and task, and
    whether the positions are ``known``.
    """

    def split(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            pools, n = (batch.column(c) for c in ("jd_id", "n"))
            known, pos = batch.column("pos").is_valid().to_numpy(zero_copy_only=False), _numbers(batch.column("pos")).astype(np.int64)
            pool = pools.dictionary_encode()
            pool, many = _numbers(pool.indices, len(pool.dictionary)).astype(np.int64), len(pool.dictionary) + 1
            found = _Terms(batch, key)
            row_of, listed = found.row_of, frequent.known(found.numbers)
            place = frequent.find(frequent.pool_of(pools)[row_of], listed[found.first], listed[found.last])

            pooled = n.is_valid().to_numpy(zero_copy_only=False)[row_of]
            near = np.flatnonzero((place >= 0) & pooled)
            idf = _idf(df[place[near]], _numbers(n)[row_of[near]])
            w = _weight(found.tf[near], idf)
            sums = [np.bincount(row_of[near], x, batch.num_rows) for x in (w * _job_weight(job_tf[place[near]], idf), w * w)]
            # What a row without position has of listed terms is told already, and no sum is its own.
            rows = np.flatnonzero(known)
            order, starts = _parts(pool[rows])
            rows, none = rows[order], pa.nulls(len(starts) - 1, pa.binary())
            first = rows[starts[:-1]]
            yield _batch(
                out, pa.array(pos[first] % tasks), pools.take(pa.array(first)), n.take(pa.array(first)), pa.array(known[first]),
                _packed(pos[rows], starts), none, none, none, *(_packed(x[rows], starts) for x in sums),
            )

            far = np.flatnonzero((place < 0) & pooled)
            terms = [found.numbers[x[far]] for x in (found.first, found.last)]
            task = ((_mixed(*terms) >> np.uint64(33)) % np.uint64(tasks)).astype(np.int64)
            parted = (task * many + pool[row_of[far]]) * 2 + known[row_of[far]]
            order, starts = _parts(parted)
            rows, none = row_of[far[order]], pa.nulls(len(starts) - 1, pa.binary())
            first = rows[starts[:-1]]
            yield _batch(
                out, pa.array(task[order[starts[:-1]]]), pools.take(pa.array(first)), n.take(pa.array(first)), pa.array(known[first]),
                _packed(pos[rows], starts), *(_packed(x[order], starts) for x in terms), _packed(found.tf[far[order]], starts), none, none,
            )

    return split


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """A number per value, equal for equal values, and how many there are."""
    encoded = column.dictionary_encode().unify_dictionaries()
    many = len(encoded.chunk(0).dictionary)
    numbers = [c.indices.fill_null(many).to_numpy(zero_copy_only=False) for c in encoded.chunks]
    return np.concatenate(numbers).astype(np.int64), many + (column.null_count > 0)


def _groups(pool: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number per term of a pool, from 0."""
    code, _ = pd.factorize(_mixed(first, last) + pool.view(np.uint64) * _FACTORS[3])
    one = np.empty(int(code.max(initial=-1)) + 1, np.int64)
    one[code] = np.arange(len(code))
    one = one[code]
    if any((x != x[one]).any() for x in (pool, first, last)):
        # Different terms met in the mixed number: they are told apart by their own.
        code = pool
        for x in (first, last):
            other, values = pd.factorize(x)
            code = pd.factorize(code * len(values) + other)[0]
    return code


def _document_sums(pool: np.ndarray, pools: int, pos: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where every document stands first, and the sums of all its values."""
    code, _ = pd.factorize(pos if pools == 1 else pd.factorize(pos)[0] * pools + pool)
    many = int(code.max(initial=-1)) + 1
    first = np.empty(many, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return first, [np.bincount(code, x, many) for x in values]


def gathered_sums(job_pos: int, tasks: int, out: pa.Schema) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Rows ``(task, jd_id, pos, dot, norm2)``, packed from ``pos`` on, of the rows of :func:`listed_sums` that came to a task, all of a
    term to the same one. All sums of a document go to one task."""

    def gather(batches: Batches) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held, held[0].schema)
        pool, many = _codes(table.column("jd_id"))
        row_of, pos = _rows_of(held), _unpacked(held, "pos", np.int64)
        known = table.column("known").to_numpy()[row_of]
        rare = table.column("last").is_valid().to_numpy()[row_of]
        dot, norm2 = np.zeros(len(pos)), np.zeros(len(pos))
        dot[~rare], norm2[~rare] = _unpacked(held, "dot", np.float64), _unpacked(held, "norm2", np.float64)

        far = np.flatnonzero(rare)
        if len(far):
            group = _groups(pool[row_of[far]], *(_unpacked(held, c, np.int64) for c in ("first", "last")))
            df = np.bincount(group)
            tf = _unpacked(held, "tf", np.int32)
            job_tf = np.zeros(len(df), np.int32)
            asked = np.flatnonzero(known[far] & (pos[far] == job_pos))
            np.maximum.at(job_tf, group[asked], tf[asked])
            idf = _idf(df[group], table.column("n").fill_null(0).to_numpy()[row_of[far]])
            w = _weight(tf, idf)
            dot[far] = w * _job_weight(job_tf[group], idf)
            norm2[far] = w * w

        # A row without position is counted with its terms, but no sum can be told to be its own.
        kept = np.flatnonzero(known)
        first, sums = _document_sums(pool[row_of[kept]], many, pos[kept], dot[kept], norm2[kept])
        pos, row = pos[kept[first]], row_of[kept[first]]
        task = ((_mixed(np.zeros_like(pos), pos) >> np.uint64(33)) % np.uint64(tasks)).astype(np.int64)
        order, starts = _parts(task * many + pool[row])
        at = order[starts[:-1]]
        yield _batch(
            out, pa.array(task[at]), table.column("jd_id").take(pa.array(row[at])).combine_chunks(),
            *(_packed(x[order], starts) for x in (pos, *sums)),
        )

    return gather


def document_sums(out: pa.Schema) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """``(jd_id, pos, dot, norm2)`` of the rows of :func:`gathered_sums` that came to a task, all of a document to the same one."""

    def add(batches: Batches) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        pools = pa.Table.from_batches(held, held[0].schema).column("jd_id")
        pool, many = _codes(pools)
        row_of, pos = _rows_of(held), _unpacked(held, "pos", np.int64)
        first, sums = _document_sums(pool[row_of], many, pos, *(_unpacked(held, c, np.float64) for c in ("dot", "norm2")))
        found = [pools.take(pa.array(row_of[first])).combine_chunks(), pa.array(pos[first]), *map(pa.array, sums)]
        yield from pa.Table.from_arrays([a.cast(f.type) for a, f in zip(found, out, strict=True)], schema=out).to_batches(ROWS_AT_ONCE)

    return add
