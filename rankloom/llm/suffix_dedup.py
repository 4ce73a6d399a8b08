"""Removal of repeated 50-byte strings with suffix arrays.

Texts are UTF-8 bytes. A byte goes if some 50-byte string over it also starts in a document with a smaller ``doc_id``.

Sorting every suffix of the corpus would move each byte fifty times. Instead each window of ``LENGTH`` bytes is named by
the smallest hash of its ``GRAM``-byte substrings, its minimum: equal windows have equal minima, so a window whose minimum
occurs in no second document is settled, and all windows with one minimum can be compared in one shard.

1. Documents are dealt into blocks. A block lists its minima; by ranges of their hash it is found which occur in several
   blocks. This only rules windows out.
2. A block cuts the runs of windows with a repeated minimum out of its texts and sends them to the minimum's shard. Runs
   equal to one of a smaller document of the block are settled there, so a passage leaves a block once however many
   documents share it.
3. A shard sorts its runs' suffixes: by their first eight bytes, then by Larsson-Sadakane doubling, which sorts the groups
   not yet single by the rank of the suffix that begins where they end. Kasai's common prefixes, computed for all
   runs in step, cut the order into groups with equal first 50 bytes. Each window learns the smallest document of its group.
   Text of one hash range beyond ``SHARD_BYTES`` is cut into several suffix arrays, whose distinct windows are merged by
   binary search in one another.
4. Blocks gather what was found and cut the bytes.

Blocks, shards and hash ranges have bounded sizes at every corpus size. Texts are moved once, by block; the steps use the
same exchange.

Defined results. Null and empty texts have 0 bytes. A null ``doc_id`` is larger than any other. Equal ids are not smaller
than each other, so rows with one id never remove bytes of each other. Texts shorter than 50 bytes stay whole. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import table, text_or_empty
from rankloom.runtime import materialize

LENGTH, GRAM = 50, 20
BLOCK_BYTES = 12 << 20
SLICE_BYTES = 2 << 20
SHARD_BYTES = 4 << 20
LONGEST_RUN = LENGTH + LENGTH - GRAM
NO_ID = np.iinfo(np.int64).max
HEAVY = 1000

_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_BASE, k, 1 << 64))


def window_minima(raw: np.ndarray) -> np.ndarray:
    """For the window at each place, the smallest mixed hash of its grams."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    by_size = {1: raw.astype(np.uint64) + np.uint64(1)}
    size = 1
    while size * 2 <= GRAM:
        h = by_size[size]
        by_size[size * 2] = h[:-size] * _power(size) + h[size:]
        size *= 2
    h, have = by_size[size], size
    while have < GRAM:
        more = max(s for s in by_size if s <= GRAM - have)
        tail = by_size[more][have:]
        h = h[: len(tail)] * _power(more) + tail
        have += more
    low = _mixed(h)
    span, wide = 1, LENGTH - GRAM + 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[wide - span : wide - span + n])


# --- what travels: arrays of numbers, byte plane by byte plane, compressed ---


def _squeeze(values: np.ndarray) -> bytes:
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(raw: bytes, kind) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# --- blocks of documents ---


class Block:
    """The distinct texts of a block, in order of their smallest doc_id, and which rows have them."""

    def __init__(self, rows: pa.Table):
        self.ids = [NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()]
        texts = rows.column("raw").to_pylist()
        least: dict[bytes, int] = {}
        for i, t in zip(self.ids, texts):
            least[t] = min(least.get(t, NO_ID), i)
        order = sorted(least.items(), key=lambda e: (e[1], e[0]))
        self.texts = [t for t, _ in order]
        self.owner = np.array([i for _, i in order], np.int64)
        number = {t: k for k, t in enumerate(self.texts)}
        self.text_of_row = [number[t] for t in texts]
        self.number = rows.column("block")[0].as_py()

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """A few megabytes of text at a time: bytes, and per window its place in them, its text and its place in the text.

        Long texts come in overlapping pieces.
        """
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for k, t in enumerate(self.texts):
            for base in range(0, max(0, len(t) - LENGTH + 1), SLICE_BYTES):
                piece = t[base : base + SLICE_BYTES + LENGTH - 1]
                held.append((k, base, piece))
                size += len(piece)
                if size >= SLICE_BYTES:
                    yield self._slice(held)
                    held, size = [], 0
        if held:
            yield self._slice(held)

    @staticmethod
    def _slice(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        size = np.array([len(p) for _, _, p in held])
        windows = size - LENGTH + 1
        within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.repeat(np.cumsum(size) - size, windows) + within
        text = np.repeat(np.array([k for k, _, _ in held], np.int32), windows)
        place = (np.repeat(np.array([b for _, b, _ in held]), windows) + within).astype(np.int32)
        return raw, at, text, place


def _prints(minima: np.ndarray) -> np.ndarray:
    """Evenly spread 40-bit prints of minima."""
    return _mixed(minima ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(24)


def _list_minima(ranges: int):
    schema = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("prints", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        seen = [np.zeros(0, np.uint64)]
        for raw, at, _, _ in block.slices():
            low = window_minima(raw)[at]
            seen.append(np.unique(_prints(low[np.append(True, low[1:] != low[:-1])])))
        prints = np.unique(np.concatenate(seen))
        edges = np.searchsorted(prints, [-(-(r << 40) // ranges) for r in range(1, ranges)])
        out = [(r, block.number, _squeeze(np.diff(p, prepend=np.uint64(0)))) for r, p in enumerate(np.split(prints, edges)) if len(p)]
        return pa.table([pa.array([o[i] for o in out], schema.field(i).type) for i in range(3)], schema=schema)

    return run


def _repeated(rows: pa.Table) -> pa.Table:
    """Of one range of prints: for each block those that other blocks have too."""
    lists = [np.cumsum(_unsqueeze(p, np.uint64), dtype=np.uint64) for p in rows.column("prints").to_pylist()]
    every = np.sort(np.concatenate(lists))
    twice = every[1:][every[1:] == every[:-1]]
    out = []
    for block, prints in zip(rows.column("block").to_pylist(), lists):
        found = prints[_in(prints, twice)]
        if len(found):
            out.append((block, _squeeze(np.diff(found, prepend=np.uint64(0)))))
    return pa.table([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["block", "prints"])


# Runs on their way to a shard (texts of the block, places, lengths, hash ranges, owners, bytes), or, with shard null,
# what is settled: texts, places, lengths of bytes that go.
RUNS = "shard int, block int, text binary, place binary, length binary, part binary, owner binary, raw binary"
RUNS_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32())] + [(c, pa.binary()) for c in ("text", "place", "length", "part", "owner", "raw")])


def _run_rows(raw: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each run's bytes in a row of its own, padded with zeros, its length behind them."""
    step = np.arange(LONGEST_RUN)
    out = np.zeros((len(at), LONGEST_RUN + 1), np.uint8)
    inside = step < length[:, None]
    out[:, :LONGEST_RUN] = np.where(inside, raw[np.minimum(at[:, None] + step, len(raw) - 1)], 0)
    out[:, LONGEST_RUN] = length
    return out


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct row, and for every row which one it is."""
    _, first, which = np.unique(rows.view(f"V{rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return first, which


def _cut_runs(shards: int):
    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return RUNS_SCHEMA.empty_table()
        block = Block(rows)
        lists = [np.cumsum(_unsqueeze(p, np.uint64), dtype=np.uint64) for p in replies.column("prints").to_pylist()]
        elsewhere = np.sort(np.concatenate([np.zeros(0, np.uint64), *lists]))
        kept: list[list[np.ndarray]] = []
        # Prints below 2**40 and the numbers of texts share a word.
        held_by = [np.zeros(0, np.uint64)]
        for raw, at, text, place in block.slices():
            low = window_minima(raw)[at]
            new = np.append(True, (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1))
            begin = np.flatnonzero(new)
            windows = np.diff(np.append(begin, len(low)))
            # Runs of a repeating text can be longer than any other; cut them.
            most = LONGEST_RUN - LENGTH + 1
            pieces = -(-windows // most)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin, windows = np.repeat(begin, pieces) + nth * most, np.minimum(most, np.repeat(windows, pieces) - nth * most)
            prints = _prints(low[begin])
            kept.append([raw, at[begin], text[begin], place[begin], (windows + LENGTH - 1).astype(np.uint8), prints])
            held_by.append(np.unique(prints << np.uint64(24) | text[begin].astype(np.uint64)))
        if not kept:
            return RUNS_SCHEMA.empty_table()
        print_of = np.unique(np.concatenate(held_by)) >> np.uint64(24)
        shared = np.union1d(elsewhere, print_of[1:][print_of[1:] == print_of[:-1]])
        chosen = []
        for raw, at, text, place, length, prints in kept:
            take = np.flatnonzero(_in(prints, shared))
            chosen.append([x[take] for x in (text, place, length, prints)] + [_run_rows(raw, at[take], length[take].astype(np.int64))])
        return _send(block, *(np.concatenate([c[i] for c in chosen]) for i in range(5)), shards)

    return run


def _in(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _send(block: Block, text, place, length, prints, run_rows, shards: int) -> pa.Table:
    owner = block.owner[text]
    first, which = _distinct(run_rows)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, which, owner)
    settled = owner > least[which]
    # Of the runs that are left, one for each text of bytes and owner, as equal ids settle nothing between them.
    out = []
    if settled.any():
        s = np.flatnonzero(settled)
        out.append((None, block.number, _squeeze(text[s]), _squeeze(place[s]), _squeeze(length[s]), b"", b"", b""))
    left = np.flatnonzero(~settled)
    shard = (prints[left] % np.uint64(shards)).astype(np.int32)
    left = left[np.argsort(shard, kind="stable")]
    shard = (prints[left] % np.uint64(shards)).astype(np.int32)
    import zstandard

    for s in np.unique(shard):
        x = left[shard == s]
        part = (prints[x] >> np.uint64(12)).astype(np.uint8)
        flat = run_rows[x][:, :LONGEST_RUN][np.arange(LONGEST_RUN) < length[x][:, None]]
        packed = zstandard.ZstdCompressor(level=1).compress(flat.tobytes())
        out.append((int(s), block.number, _squeeze(text[x]), _squeeze(place[x]), _squeeze(length[x]), _squeeze(part), _squeeze(owner[x]), packed))
    return pa.table([pa.array([o[i] for o in out], RUNS_SCHEMA.field(i).type) for i in range(8)], schema=RUNS_SCHEMA)


# --- shards of suffixes ---


def suffix_array(raw: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The order of all suffixes by their first ``depth`` bytes or more; zeros stand behind the end."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    first = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    rank[n] = 0
    h = 8
    while h < depth:
        single = first & np.append(first[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        sub = order[open_]
        both = rank[sub] * (n + 1) + rank[np.minimum(sub + h, n)]
        by = np.argsort(both, kind="stable")
        sub, both = sub[by], both[by]
        order[open_] = sub
        new = np.append(True, both[1:] != both[:-1])
        first[open_] = new
        rank[sub] = np.maximum.accumulate(np.where(new, open_, 0)) + 1
        h *= 2
    return order


def common_prefixes(raw: np.ndarray, order: np.ndarray, begin: np.ndarray, length: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """For each place in ``order`` the length, up to ``most``, of the prefix shared with the suffix before it.

    Kasai's rule, that a suffix shares at least one less than the one a byte earlier, holds within a run of text; all
    runs (``begin``, ``length``) are walked in step.
    """
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(most, np.uint8)])
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    by_length = np.argsort(-length, kind="stable")
    begin, length = begin[by_length], length[by_length]
    now = np.zeros(len(begin), np.int64)
    for t in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -t, "left"))
        i = begin[:live] + t
        j = before[i]
        now = np.maximum(now[:live] - 1, 0)
        go = np.flatnonzero((j >= 0) & (now < most))
        while len(go):
            same = padded[i[go] + now[go]] == padded[j[go] + now[go]]
            go = go[same]
            now[go] += 1
            go = go[now[go] < most]
        now[j < 0] = 0
        shared[i] = now
    return shared[order]


def _least_owners(rows: np.ndarray, length: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One suffix array over distinct runs: for the window at each place of each run (a matrix, filled as far as the run
    has windows) its group, and per group the smallest owner and the place of one of its windows in the bytes."""
    size = length.astype(np.int64)
    begin = np.cumsum(size) - size
    raw = rows[:, :LONGEST_RUN][np.arange(LONGEST_RUN) < size[:, None]]
    order = suffix_array(raw)
    group = np.cumsum(common_prefixes(raw, order, begin, size) < LENGTH) - 1
    run = np.repeat(np.arange(len(size)), size)
    whole = np.arange(len(raw)) - begin[run] <= size[run] - LENGTH
    owners = np.where(whole, owner[run], NO_ID)[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.minimum.reduceat(owners, starts)
    group_at = np.empty(len(raw), np.int64)
    group_at[order] = group
    some = np.full(len(starts), -1)
    some[group[whole[order]]] = order[whole[order]]
    place = begin[:, None] + np.arange(LONGEST_RUN - LENGTH + 1)
    groups = np.where(np.arange(LONGEST_RUN - LENGTH + 1) <= (size - LENGTH)[:, None], group_at[np.minimum(place, len(raw) - 1)], -1)
    return groups, least, some, raw


def _merge(arrays: list[list[np.ndarray]]) -> None:
    """Carry the smallest owner of equal windows across several suffix arrays, by binary search in each other."""
    keys = []
    for _, least, some, raw in arrays:
        has = np.flatnonzero(some >= 0)
        text = np.ascontiguousarray(raw[some[has][:, None] + np.arange(LENGTH)])
        keys.append((has, text.view(f"V{LENGTH}").ravel()))
    for a in range(len(arrays)):
        for b in range(a + 1, len(arrays)):
            (has_a, key_a), (has_b, key_b) = keys[a], keys[b]
            at = np.minimum(np.searchsorted(key_b, key_a), len(key_b) - 1)
            same = key_b[at] == key_a
            ga, gb = has_a[same], has_b[at[same]]
            both = np.minimum(arrays[a][1][ga], arrays[b][1][gb])
            arrays[a][1][ga] = arrays[b][1][gb] = both


def settle(rows: np.ndarray, length: np.ndarray, owner: np.ndarray, shard_bytes: int = 2 * SHARD_BYTES) -> np.ndarray:
    """For every window of every run, whether its string starts in a smaller document. A matrix, runs x windows."""
    first, which = _distinct(rows)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, which, owner)
    bytes_before = np.cumsum(length[first].astype(np.int64))
    cuts = np.searchsorted(bytes_before, np.arange(shard_bytes, bytes_before[-1], shard_bytes))
    arrays = [
        list(_least_owners(rows[f], length[f], l)) for f, l in zip(np.split(first, cuts), np.split(least, cuts)) if len(f)
    ]
    if len(arrays) > 1:
        _merge(arrays)
    smallest = np.concatenate([np.where(groups >= 0, own[groups], NO_ID) for groups, own, _, _ in arrays])
    return smallest[which] < owner[:, None]


def _sort_shard(rows: pa.Table) -> pa.Table:
    import zstandard

    out = []
    parts = {c: [] for c in ("text", "place", "length", "part", "owner", "block")}
    flat = []
    for row in rows.to_pylist():
        if row["shard"] < 0:
            out.append((row["block"], row["text"], row["place"], row["length"]))
            continue
        for c, kind in (("text", np.int32), ("place", np.int32), ("length", np.uint8), ("part", np.uint8), ("owner", np.int64)):
            parts[c].append(_unsqueeze(row[c], kind))
        parts["block"].append(np.full(len(parts["text"][-1]), row["block"], np.int32))
        flat.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(row["raw"]), np.uint8))
    if flat:
        text, place, length, part, owner, block = (np.concatenate(parts[c]) for c in ("text", "place", "length", "part", "owner", "block"))
        raw = np.concatenate(flat)
        at = np.cumsum(length, dtype=np.int64) - length
        by_part = np.argsort(part, kind="stable")
        held: list[np.ndarray] = []
        size = 0
        for x in np.split(by_part, np.flatnonzero(np.diff(part[by_part])) + 1):
            held.append(x)
            size += int(length[x].sum())
            if size >= SHARD_BYTES:
                out += _found(np.concatenate(held), raw, at, text, place, length, owner, block)
                held, size = [], 0
        if held:
            out += _found(np.concatenate(held), raw, at, text, place, length, owner, block)
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["block", "text", "place", "length"])


def _found(x, raw, at, text, place, length, owner, block) -> list[tuple]:
    """Per block, the bytes that go: runs of windows that start in a smaller document."""
    gone = settle(_run_rows(raw, at[x], length[x].astype(np.int64)), length[x], owner[x])
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    run, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    out = []
    where = block[x[run]]
    for b in np.unique(where):
        k = where == b
        src = x[run[k]]
        bytes_gone = (end[k] - begin[k] + LENGTH - 1).astype(np.uint8)
        out.append((int(b), _squeeze(text[src]), _squeeze((place[src] + begin[k]).astype(np.int32)), _squeeze(bytes_gone)))
    return out


def _cut_bytes(rows: pa.Table, marks: pa.Table) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    if not rows.num_rows:
        return schema.empty_table()
    block = Block(rows)
    empty = np.zeros(0, np.int64)
    text, place, length = [empty], [empty], [empty]
    for row in marks.to_pylist():
        text.append(_unsqueeze(row["text"], np.int32))
        place.append(_unsqueeze(row["place"], np.int32))
        length.append(_unsqueeze(row["length"], np.uint8))
    text, place, length = (np.concatenate(c).astype(np.int64) for c in (text, place, length))
    order = np.argsort(text, kind="stable")
    text, place, length = text[order], place[order], length[order]
    of_text = np.searchsorted(text, np.arange(len(block.texts) + 1))
    results = []
    for k, t in enumerate(block.texts):
        change = np.zeros(len(t) + 1, np.int32)
        mine = slice(of_text[k], of_text[k + 1])
        np.add.at(change, place[mine], 1)
        np.add.at(change, place[mine] + length[mine], -1)
        gone = np.cumsum(change[:-1]) > 0
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        results.append((int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    out = []
    for row_id, k in zip(block.ids, block.text_of_row):
        n = len(block.texts[k])
        # A text that a smaller document of the block has whole goes whole.
        whole = row_id > block.owner[k] and n >= LENGTH
        removed, spans, kept = (n, 1, b"") if whole else results[k]
        out.append((None if row_id == NO_ID else row_id, n, removed, spans, kept))
    return pa.table([pa.array([o[i] for o in out], schema.field(i).type) for i in range(5)], schema=schema)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes left."""
    raw = text_or_empty().cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"))
    narrow = materialize(rows.select(F.xxhash64("raw").alias("same"), F.octet_length("raw").cast("long").alias("n")), "texts")
    total = narrow.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    blocks = shards = max(1, -(-total["bytes"] // BLOCK_BYTES))
    # Copies of a text share a block, where only one of them is worked on. Texts with over a thousandth of all rows, of
    # which there are under a thousand, are spread over all blocks.
    heavy_from = max(HEAVY, total["n"] // 1000)
    heavy = narrow.groupBy("same").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_from).select("same", F.lit(True).alias("_heavy"))
    keyed = rows.withColumn("same", F.xxhash64("raw")).join(F.broadcast(materialize(heavy, "heavy-texts")), "same", "left")
    salt = F.when(F.col("_heavy"), F.xxhash64("doc_id")).otherwise(F.lit(0))
    block = F.pmod(F.xxhash64("same", salt), F.lit(blocks)).cast("int")
    texts = keyed.select(block.alias("block"), "doc_id", "raw")

    listed = texts.groupBy("block").applyInArrow(_list_minima(shards), "range int, block int, prints binary")
    replies = listed.groupBy("range").applyInArrow(_repeated, "block int, prints binary")
    runs = texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_cut_runs(shards), RUNS)
    # What is settled passes through the shards untouched, dealt by block.
    dealt = runs.withColumn("at", F.coalesce("shard", F.col("block"))).withColumn("shard", F.coalesce("shard", F.lit(-1)))
    marks = dealt.groupBy("at").applyInArrow(_sort_shard, "block int, text binary, place binary, length binary")
    cut = texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        _cut_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return cut


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op9_suffix_array_dedup": (op9_suffix_array_dedup, None)}
