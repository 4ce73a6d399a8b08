"""Words and places of terms found in columns of texts: the bytes of many rows at once, by numpy, inside of tasks.

A pattern takes some hundred nanoseconds for a character, as it is tried at every position. Here bytes are looked up in tables, which takes
a few. Nothing is judged here that a pattern judges otherwise: texts with characters whose class could hang on the edition of
Unicode are left to the pattern, and of terms only the places are found where the pattern is then tried.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

# Bytes of texts that are worked on at once, one text at the least.
BYTES_AT_ONCE = 1 << 20
# Letters that stand for what a cut left out; one that occurs in no term is taken.
_EDGES = range(0x1401, 0x1501)
_NO_WORD, _WORD, _UNSURE = range(3)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _is_word(category: str) -> bool:
    return category[0] in "LN"


@cache
def _classes() -> np.ndarray:
    """Of every character of up to three bytes whether it belongs to words; unsure if that was not the same in all editions of Unicode."""
    found = np.full(1 << 16, _UNSURE, np.uint8)
    for point in range(1 << 16):
        first, now = (u.category(chr(point)) for u in (unicodedata.ucd_3_2_0, unicodedata))
        if first != "Cn" and _is_word(first) == _is_word(now):
            found[point] = _WORD if _is_word(now) or point == ord("_") else _NO_WORD
    return found


def codes(data: np.ndarray, at: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """The bytes from a place on as a number, up to eight of them. ``data`` goes on for eight bytes behind the last place."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    return (eight[at] & _MASKS[np.minimum(sizes, 8)]).view(np.int64)


def _code(word: bytes) -> int:
    return int.from_bytes(word[:8].ljust(8, b"\0"), "little", signed=True)


class Texts:
    """Bytes of some texts, a blank before and behind each; ``begins`` and ``ends`` say where they stand."""

    def __init__(self, texts: pa.Array):
        closed = pc.binary_join_element_wise(texts.cast(pa.string()).fill_null(""), "", " ")
        _, ends, data = closed.buffers()
        ends = np.frombuffer(ends, np.int32)[closed.offset : closed.offset + len(closed) + 1].astype(np.int64)
        held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        self.data = np.concatenate([[np.uint8(32)], held, np.full(8, 32, np.uint8)])
        self.begins, self.ends = ends[:-1] - ends[0] + 1, ends[1:] - ends[0]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    done = np.append(0, np.cumsum(_numbers(pc.binary_length(texts).fill_null(0)), dtype=np.int64))
    start = 0
    while start < len(texts):
        end = max(int(np.searchsorted(done, done[start] + BYTES_AT_ONCE, "right")) - 1, start + 1)
        yield texts.slice(start, end - start)
        start = end


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _strings(data: np.ndarray, sizes: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    found = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return found if null is None or not null.any() else pc.if_else(pa.array(~null), found, pa.scalar(None, pa.string()))


def strings_at(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return _strings(_copied(data, starts, sizes), sizes)


def _copied(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of pieces, one piece after the other."""
    return data[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


_ASCII_WORD = np.array([chr(b).isalnum() or chr(b) == "_" if b < 128 else False for b in range(256)])


def _word_bytes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and which texts have a character that is unsure."""
    data = texts.data
    word, unsure = _ASCII_WORD[data], np.zeros(len(texts.begins), bool)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b, c, d = (data[lead + k].astype(np.int64) for k in range(3))
        long = b >= 0xE0
        point = np.where(long, (b & 15) << 12 | (c & 63) << 6 | d & 63, (b & 31) << 6 | c & 63)
        kind = np.where(b >= 0xF0, _UNSURE, _classes()[point])
        inside = kind == _WORD
        word[lead] = word[lead + 1] = inside
        word[lead[long] + 2] = inside[long]
        unsure[np.searchsorted(texts.ends, lead[kind == _UNSURE])] = True
    return word, unsure


def _are_listed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: Sequence[str]) -> np.ndarray:
    """Which pieces are one of ``words``."""
    known = [w.encode() for w in words]
    short = pd.Index(sorted({_code(w) for w in known if len(w) <= 8}), dtype=np.int64)
    found = (short.get_indexer(codes(data, starts, sizes)) >= 0) & (sizes <= 8)
    heads = pd.Index(sorted({_code(w) for w in known if len(w) > 8}), dtype=np.int64)
    longer = np.flatnonzero((sizes > 8) & (sizes <= max(map(len, known), default=0)))
    longer = longer[heads.get_indexer(codes(data, starts[longer], 8)) >= 0]
    if len(longer):
        texts = strings_at(data, starts[longer], sizes[longer])
        found[longer] = _numbers(pc.is_in(texts, value_set=pa.array(words, pa.string())))
    return found


def _joined(texts: Texts, stop_words: Sequence[str]) -> pa.Array:
    word, unsure = _word_bytes(texts)
    data = texts.data
    # Blanks stand at both ends, so every word begins and ends at a change.
    changes = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = changes[::2], changes[1::2]
    sizes, head = ends - starts, data[starts]
    kept = np.flatnonzero(sizes > 1 + (head >= 0xC0) + (head >= 0xE0))
    if stop_words:
        kept = kept[~_are_listed(data, starts[kept], sizes[kept], stop_words)]
    starts, ends, sizes = starts[kept], ends[kept], sizes[kept]
    # With a word goes the byte behind it, as a blank; not behind the last word of a text.
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends + 1] -= 1
    held = np.cumsum(step[:-1], dtype=np.int8).view(bool)
    first, end = np.searchsorted(starts, texts.begins), np.searchsorted(starts, texts.ends)
    some = end > first
    held[ends[end[some] - 1]] = False
    blanked = data.copy()
    blanked[ends] = 32
    done = np.append(0, np.cumsum(sizes + 1))
    return _strings(blanked[held], done[end] - done[first] - some, unsure)


def joined_words(stop_words: Sequence[str]) -> Callable:
    """``(lower-case text) -> words``, those of :func:`terms.tokens` with blanks between them; NULL where a pattern has to tell."""
    stop_words = tuple(stop_words)

    @F.arrow_udf("string")
    def words(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([_joined(Texts(t), stop_words) for t in _slices(texts)] or [pa.array([], pa.string())])

    return words


class _Heads:
    """What the terms begin with, by tables of their first bytes."""

    def __init__(self, terms: Sequence[str], not_behind: str):
        known = [t.encode() for t in terms]
        self.longest = max(map(len, known))
        self.edge = next(c for c in map(chr, _EDGES) if not any(c in t for t in terms)).encode()
        self.open = np.ones(256, bool)
        self.open[[b for b in range(128) if chr(b).isalnum() or chr(b) in not_behind]] = False
        # The first two bytes, then as many as a term has, up to eight.
        self.two = np.zeros((256, 256), bool)
        for t in known:
            self.two[t[0], t[1] if len(t) > 1 else slice(None)] = True
        sizes = {min(len(t), 8) for t in known}
        self.codes = {k: pd.Index(sorted({_code(t) for t in known if min(len(t), 8) == k}), dtype=np.int64) for k in sizes}

    def places(self, data: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.open[data[:-9]]) + 1
        at = at[self.two[data[at], data[at + 1]]]
        met = np.zeros(len(at), bool)
        for size, known in self.codes.items():
            met |= known.get_indexer(codes(data, at, size)) >= 0
        return at[met]


def _near(texts: Texts, heads: _Heads) -> pa.Array:
    data, at = texts.data, heads.places(texts.data)
    row = np.searchsorted(texts.ends, at)
    # From the character before a term to the one behind the longest, the blanks around a text among them; no character is cut.
    left = np.maximum(at - 4, texts.begins[row] - 1)
    right = np.minimum(at + heads.longest + 4, texts.ends[row] + 1)
    for _ in range(3):
        left += (data[left] & 0xC0) == 0x80
        right += (data[right] & 0xC0) == 0x80
    # Pieces that overlap become one.
    new = np.append(True, (left[1:] > right[:-1]) | (row[1:] != row[:-1]))[: len(at)]
    last = np.append(new[1:], True)[: len(at)]
    row, left, sizes = row[new], left[new], right[last] - left[new]
    edge = np.frombuffer(heads.edge, np.uint8)
    wide = sizes + 2 * len(edge)
    begins = np.cumsum(wide) - wide
    out = np.zeros(wide.sum(), np.uint8)
    inner = np.ones(len(out), bool)
    for k, b in enumerate(edge):
        for place in (begins + k, begins + wide - len(edge) + k):
            out[place], inner[place] = b, False
    out[inner] = _copied(data, left, sizes)
    return _strings(out, np.bincount(row, wide, len(texts.begins)).astype(np.int64))


def near_terms(terms: Sequence[str], not_behind: str) -> Callable:
    """``(lower-case text) -> text`` of what stands around places where one of ``terms`` may begin.

    A pattern that takes a term only where neither a letter, a digit nor one of ``not_behind`` stands before it, and that asks for one
    character behind it, finds the same terms in both. Pieces begin and end with a letter that is in no term, so no cut makes a term.
    """
    heads = _Heads(terms, not_behind)

    @F.arrow_udf("string")
    def pieces(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([_near(Texts(t), heads) for t in _slices(texts)] or [pa.array([], pa.string())])

    return pieces
