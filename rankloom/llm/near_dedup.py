"""Near-duplicate groups by MinHash and a multi-index Hamming join.

A document's set are the hashes of its distinct word shingles. Its signature are the minima of ``VALUES`` hash functions
over the set, cut to 16 bits each. Two documents are candidates when their signatures differ in at most ``DISTANCE``
values. The signature is split into ``CHUNKS`` chunks, and as DISTANCE < 2 * CHUNKS, some chunk of a candidate pair
differs in at most one value (pigeonhole). So every chunk is entered once for each of its values with that value left
out: any two signatures within the distance share an entry, which is the join's guarantee. Links are confirmed on the
full sets.

How many links a group has grows with its square, so they are never listed:

1. Documents with the same set are one node.
2. Of every entry the smallest node is taken (a combinable minimum); each node is compared with the smallest of those.
   Confirmed links join nodes into components. A group of near copies comes together here, in stars.
   Pairs that meet in entries of their own are first compared by four bits of each value.
3. Entries that still hold several components are the open cases. Components with nodes in one open entry whose sketches
   are within the distance form a cluster, and no others: that an entry is shared by chance joins none. In a cluster all
   pairs of nodes of different components within the distance are compared, in blocks of bounded size. Nodes of one
   component are not compared again, so a large group costs one pass for each block of open nodes.
4. Components are taken again over the links of both steps.

Entries are made from the signatures where they are needed, and most are nobody else's. So tasks first exchange 32 bits of
each, packed, and get back a bit that says whether another node may have it; only entries that may be shared are moved in
full. What sets are needed for is worked out on numbers of nodes, and the sets are joined last.

Words are runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased. Sets hold 48 bits of a 64-bit hash; nodes are named by 64
bits of a hash of the set.

Defined results. Null and empty texts have an empty set, no links and are their own group. A text with fewer words than a
shingle has one shingle, the whole sequence. A group's ``component_id`` is its smallest ``doc_id``; rows without an id
join groups, but name one only if nobody else does, and then stay. Rows with one doc_id and different texts can be in
different groups. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import free_name, table, text_or_empty
from rankloom.llm.components import connected
from rankloom.runtime import materialize

VALUES, CHUNKS, DISTANCE = 56, 12, 23
PERCENT = 80
WORDS = 5
BLOCK = 512
MAP_BITS = 26
SPLIT = 400
# Nodes packed into one row of the index, and about how many entries a task compares at once.
PACKED, ENTRIES = 10_000, 1 << 20
# Rows of an open entry that one task compares, and rows of many open entries that make a group.
OPEN, ROWS = 1 << 14, 1 << 14
# So many products of two numbers take the time of comparing two sets.
PRODUCTS = 300_000

_rng = np.random.default_rng(1234)
_FACTORS = _rng.integers(1 << 31, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)
_PARTS = np.array_split(np.arange(VALUES), CHUNKS)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    # Lower-casing and splitting bytes touches exactly A-Z and the characters 0x20 and 0x09-0x0D.
    words = text.encode().lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted, 48 bits each."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
    return np.unique(out >> np.uint64(16))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of VALUES 16-bit values per set; sets must not be empty."""
    size = np.array([len(s) for s in sets])
    begin = np.cumsum(size) - size
    base = (_mixed(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(base * _FACTORS[k] + _SHIFTS[k], begin)
    return (_mixed(out.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def entries(signature: np.ndarray) -> np.ndarray:
    """The index entries of each signature: every chunk with each of its values left out."""
    wide = signature.astype(np.uint64)
    out = np.empty(signature.shape, np.uint64)
    at = 0
    for c, part in enumerate(_PARTS):
        for left_out in range(len(part)):
            key = np.full(len(wide), c * 64 + left_out + 1, np.uint64)
            for i, value in enumerate(part):
                if i != left_out:
                    key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, value])
            out[:, at] = key
            at += 1
    return out.view(np.int64)


def _pack(s: np.ndarray) -> bytes:
    return s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _node(s: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(_pack(s)) - (1 << 63)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _in_slices(texts: list[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a million characters, to bound what is held beside them."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def features(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, place (hash of the text), n_shingles, node (null for an empty set), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, end in _in_slices(texts):
                sets = [shingle_set(t, words) for t in texts[begin:end]]
                full = [i for i, s in enumerate(sets) if len(s)]
                # Sets of three or fewer can only be similar to equal ones, which are the same node: the nearest other set
                # has one more shingle, or one less.
                some = [i for i in full if 100 * len(sets[i]) >= PERCENT * (len(sets[i]) + 1)]
                signed: list = [None] * len(sets)
                if some:
                    for i, row in zip(some, signatures([sets[i] for i in some])):
                        signed[i] = row.astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array(signed, pa.binary()),
                    ],
                    names=["doc_id", "place", "n_shingles", "node", "signature"],
                )

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, place long, n_shingles long, node long, signature binary")


def _signed(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2").reshape(-1, VALUES).astype(np.uint16)


def _index(found: DataFrame) -> DataFrame:
    """The signatures of all nodes, some thousand to a row: chunk (the first node), n, nodes, signatures. A node is in one row."""
    nodes = found.where("signature is not null").groupBy("node").agg(F.min("signature").alias("signature"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PACKED):
                node, signature = (batch.column(c).slice(begin, PACKED).to_pylist() for c in (0, 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array(node[:1], pa.int64()), "n": pa.array([len(node)], pa.int64()),
                        "nodes": pa.array([np.array(node, "<i8").tobytes()], pa.binary()),
                        "signatures": pa.array([b"".join(signature)], pa.binary()),
                    }
                )

    return nodes.select("node", "signature").mapInArrow(pack, "chunk long, n long, nodes binary, signatures binary")


def _keys(raw: bytes, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a row's signatures: the entries; their distinct keys, sorted; which key each entry has; which keys come more than
    once; where the keys of each part begin and end. A key is the entry's part, and 32 bits of the entry."""
    entry = entries(_signed(raw)).ravel()
    plain = entry.view(np.uint64)
    key = (plain >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | plain & np.uint64(0xFFFFFFFF)
    keys, at, times = np.unique(key, return_inverse=True, return_counts=True)
    return entry, keys, at, times > 1, np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))


def _entered(index: DataFrame) -> DataFrame:
    """(entry, node) for every entry that another node has too, and for some that only share a key with another entry.

    The number of parts follows the number of entries, so how many keys coincide by chance does not grow: one in 4,000.
    A key that many nodes have comes once from each row of the index.
    """
    parts = max(1, -(-VALUES * (index.agg(F.sum("n")).first()[0] or 0) // ENTRIES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(*(batch.column(c).to_pylist() for c in (0, 1))):
                _, keys, _, again, cuts = _keys(raw, parts)
                low = keys.astype("<u4")
                some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(some, pa.int64()), "chunk": pa.array([chunk] * len(some), pa.int64()),
                        "keys": pa.array([low[cuts[p] : cuts[p + 1]].tobytes() for p in some], pa.binary()),
                        "again": pa.array([np.packbits(again[cuts[p] : cuts[p + 1]]).tobytes() for p in some], pa.binary()),
                    }
                )

    def meet(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u4") for k in group.column("keys").to_pylist()]
        again = [np.unpackbits(np.frombuffer(a, np.uint8), count=len(k)) for a, k in zip(group.column("again").to_pylist(), keys)]
        every, shared = np.concatenate(keys), np.concatenate(again).astype(bool)
        order = np.argsort(every, kind="stable")
        same = every[order[1:]] == every[order[:-1]]
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        ends = np.cumsum([len(k) for k in keys])
        bits = [np.packbits(shared[e - len(k) : e]).tobytes() for e, k in zip(ends, keys)]
        return pa.table({"chunk": group.column("chunk"), "part": group.column("part"), "shared": pa.array(bits, pa.binary())})

    def take(rows: pa.Table, bits: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for nodes, raw in zip(rows.column("nodes").to_pylist(), rows.column("signatures").to_pylist()):
            entry, keys, at, _, cuts = _keys(raw, parts)
            shared = np.zeros(len(keys), bool)
            for p, b in zip(bits.column("part").to_pylist(), bits.column("shared").to_pylist()):
                shared[cuts[p] : cuts[p + 1]] = np.unpackbits(np.frombuffer(b, np.uint8), count=int(cuts[p + 1] - cuts[p]))
            kept = shared[at]
            found.append((entry[kept], np.repeat(np.frombuffer(nodes, "<i8"), VALUES)[kept]))
        return pa.table({name: pa.array(np.concatenate([f[i] for f in found]), pa.int64()) for i, name in enumerate(("entry", "node"))})

    sent = index.select("chunk", "signatures").mapInArrow(send, "part long, chunk long, keys binary, again binary")
    told = sent.groupBy("part").applyInArrow(meet, "chunk long, part long, shared binary")
    return index.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(take, "entry long, node long")


def _sketches(signature: np.ndarray) -> np.ndarray:
    """Four bits of each value, two values to a byte."""
    low = (signature & 15).astype(np.uint8)
    return low[:, ::2] << 4 | low[:, 1::2]


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """In how many values sketches differ."""
    differ = one ^ two
    return ((differ & 15) > 0).sum(1) + (differ > 15).sum(1)


def _node_sketches(index: DataFrame) -> DataFrame:
    """node, sketch."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nodes, raw in zip(*(batch.column(c).to_pylist() for c in (0, 1))):
                sketch = [s.tobytes() for s in _sketches(_signed(raw))]
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(np.frombuffer(nodes, "<i8"), pa.int64()), "sketch": pa.array(sketch, pa.binary())}
                )

    return index.select("nodes", "signatures").mapInArrow(unpack, "node long, sketch binary")


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (first, last) of nodes whose sketches differ in at most DISTANCE values. Signatures within the distance
    always do, so no candidate is lost."""
    both = pairs.join(sketches.select(F.col("node").alias("first"), F.col("sketch").alias("one")), "first").join(
        sketches.select(F.col("node").alias("last"), F.col("sketch").alias("two")), "last"
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, VALUES // 2) for c in ("one", "two"))
            yield batch.select(["first", "last"]).filter(pa.array(_apart(one, two) <= DISTANCE))

    return both.select("first", "last", "one", "two").mapInArrow(keep, "first long, last long")


def _may_be_in(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose hash in ``column`` may be in ``wanted``, found without moving them.

    The hashes wanted mark bits in a map of 2**MAP_BITS bits, kept as at most 2**(MAP_BITS - 6) words of 64, which are
    broadcast: some 20 MB however many hashes there are. Other hashes can hit a marked bit, so a join must follow; it
    then moves a small part of the rows.
    """
    place = F.pmod(F.col(column), F.lit(1 << MAP_BITS))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    marked = wanted.select(word.alias("_word"), F.expr("1L").alias("_one"), bit.alias("_bit"))
    marks = marked.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, _bit)")).alias("_marks"))
    met = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(materialize(marks, "near-marks")), "_word")
    return met.where(F.expr("shiftright(_marks, _bit) & 1L = 1L")).drop("_word", "_bit", "_marks")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The packed sets of the nodes in ``wanted`` (node, place of one of its texts, further columns that are kept)."""
    text = text_or_empty()
    more = [c for c in wanted.columns if c != "place"]
    placed = _may_be_in(docs.select(F.xxhash64(text).alias("place"), text.alias("text")), wanted, "place")
    texts = placed.join(wanted, "place").dropDuplicates(["place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(more)).to_pylist()
            for begin, end in _in_slices(texts):
                sets = [_pack(shingle_set(t, words)) for t in texts[begin:end]]
                kept = [c.slice(begin, end - begin) for c in batch.columns[: len(more)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.binary())], names=[*more, "members"])

    kinds = ", ".join(f"{c} {dict(wanted.dtypes)[c]}" for c in more)
    return texts.select(*more, "text").mapInArrow(run, f"{kinds}, members binary")


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=LINK)


def _stars(firsts: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between nodes and the first node of their star. ``firsts``: node, first; ``sets``: node, members.

    A star of more than SPLIT nodes is dealt over several groups, each with a copy of its first node.
    """
    outer = firsts.where("node <> first")
    size = outer.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("_parts"))
    around = outer.join(size, "first").select("first", F.pmod("node", F.col("_parts")).cast("int").alias("part"), "node")
    inside = size.select("first", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), F.col("first").alias("node"))
    dealt = around.unionByName(inside).join(sets, "node").select("first", "part", "node", "members")

    def confirm(group: pa.Table) -> pa.Table:
        first = group.column("first")[0].as_py()
        nodes, members = group.column("node").to_pylist(), group.column("members").to_pylist()
        if first not in nodes:
            return _links([])
        centre = _unpack(members[nodes.index(first)])
        return _links([(first, n) for n, m in zip(nodes, members) if n != first and similar(centre, _unpack(m))])

    return dealt.groupBy("first", "part").applyInArrow(confirm, "a long, b long")


def _reached(comps: np.ndarray, close: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Pairs of close rows of different components, enough to join all components that close rows join: one for each
    component that a row reaches for the first time, or again. ``close`` tells which of some rows are close to a row."""
    left = np.arange(len(comps))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            same = comps[left] == comps[i]
            other = left[~same]
            met = other[close(i, other)]
            for k in np.unique(comps[met], return_index=True)[1]:
                yield i, int(met[k])
            queue += left[same].tolist() + met.tolist()
            left = np.setdiff1d(other, met, assume_unique=True)


def _near(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Links (a, b) between components that have plausible nodes in one open entry, enough to join all those that are
    joined so. ``rows``: entry, node, comp, n (rows of the entry).

    Rows of an entry with more than OPEN are cut into parts, and every two parts compared. Entries are compared many at a time.
    """
    parts = rows.withColumn("_parts", F.ceil(F.col("n") / OPEN).cast("long")).withColumn("_part", F.pmod("node", F.col("_parts")))
    dealt = parts.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).select(
        "entry", F.least("_part", "_other").alias("one"), F.greatest("_part", "_other").alias("two"), "node", "comp"
    )
    groups = max(1, rows.count() // ROWS)
    put = dealt.withColumn("_group", F.pmod(F.xxhash64("entry", "one", "two"), F.lit(groups)))

    def join(group: pa.Table) -> pa.Table:
        entry, one, two, comps = (group.column(c).to_numpy() for c in ("entry", "one", "two", "comp"))
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, VALUES // 2)
        order = np.lexsort((two, one, entry))
        new = np.any([x[order[1:]] != x[order[:-1]] for x in (entry, one, two)], axis=0)
        begin = np.r_[0, np.flatnonzero(new) + 1]
        size = np.diff(np.r_[begin, len(order)])
        i, j = order[begin[size == 2]], order[begin[size == 2] + 1]
        close = (comps[i] != comps[j]) & (_apart(sketch[i], sketch[j]) <= DISTANCE)
        i, j = comps[i[close]], comps[j[close]]
        found = set(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist()))
        for b, n in zip(begin[size > 2], size[size > 2]):
            at = order[b : b + n]
            some, drawn = comps[at], sketch[at]
            for i, j in _reached(some, lambda i, others: _apart(drawn[i], drawn[others]) <= DISTANCE):
                found.add((int(min(some[i], some[j])), int(max(some[i], some[j]))))
        return _links(list(found))

    return put.join(sketches, "node").groupBy("_group").applyInArrow(join, "a long, b long").distinct()


def _columns(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Members that two sets or more have: their columns, sorted, whose they are, and how many columns there are."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = np.flatnonzero((times > 1)[at])
    column = (np.cumsum(times > 1) - 1)[at[held]]
    order = np.argsort(column, kind="stable")
    return column[order], owner[held][order], int((times > 1).sum())


def _common(n: int, column: np.ndarray, owner: np.ndarray, columns: int, width: int = 4096) -> np.ndarray:
    """How many members each two of ``n`` sets have in common, as products of some columns at a time."""
    both = np.zeros((n, n), np.int64)
    for begin in range(0, columns, width):
        first, last = np.searchsorted(column, (begin, begin + width))
        part = np.zeros((n, width), np.float32)
        part[owner[first:last], column[first:last] - begin] = 1
        both += (part @ part.T).astype(np.int64)
    return both


def _blocks(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between components of a cluster. ``nodes``: cluster, comp, node; ``sets``: node, members.

    Components of more than BLOCK nodes are cut into blocks that are not compared with one another; all others of the
    cluster are pooled, and cut into blocks that are. Every pair of blocks that may hold a link is one group.
    """
    sizes = nodes.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("_n"))
    placed = nodes.join(sizes, ["cluster", "comp"]).withColumn("own", F.when(F.col("_n") > BLOCK, F.col("comp"))).drop("_n")
    parts = placed.groupBy("cluster", "own").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_parts"))
    cells = parts.select(
        "cluster", F.coalesce(F.col("own").cast("string"), F.lit("pool")).alias("own"), "_parts",
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"),
    )
    left = cells.select("cluster", F.struct("own", "part").alias("one"))
    right = cells.select("cluster", F.struct("own", "part").alias("two"))
    pairs = left.join(right, "cluster").where(
        (F.col("one") <= F.col("two")) & ((F.col("one.own") != F.col("two.own")) | (F.col("one.own") == "pool"))
    )
    # Each block goes to the pairs that it is in; a block paired with itself goes once.
    ways = pairs.select("cluster", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("at")).select(
        "cluster", "one", "two", F.col("at.own").alias("own"), F.col("at.part").alias("part")
    )
    dealt = (
        placed.withColumn("own", F.coalesce(F.col("own").cast("string"), F.lit("pool")))
        .join(cells.select("cluster", "own", "_parts").distinct(), ["cluster", "own"])
        .withColumn("part", F.pmod("node", F.col("_parts")).cast("int"))
        .join(ways, ["cluster", "own", "part"])
        .select("cluster", "one", "two", "comp", "node")
    )
    dealt = materialize(dealt, "near-dealt")

    def compare(group: pa.Table) -> pa.Table:
        nodes, comps = (np.array(group.column(c).to_pylist(), np.int64) for c in ("node", "comp"))
        sets = [_unpack(m) for m in group.column("members").to_pylist()]
        n = np.array([len(s) for s in sets])
        signature = signatures(sets)
        apart = np.zeros((len(n), len(n)), np.uint8)
        for k in range(VALUES):
            apart += signature[:, k, None] != signature[None, :, k]
        open_ = (apart <= DISTANCE) & (comps[:, None] != comps[None])
        open_ &= 100 * np.minimum(n[:, None], n[None]) >= PERCENT * np.maximum(n[:, None], n[None])
        # Many pairs are confirmed by one product, few pairs of long sets one by one.
        column, owner, columns = _columns(sets)
        if open_.sum() * PRODUCTS > len(n) ** 2 * columns:
            both = _common(len(n), column, owner, columns)
            open_ &= 100 * both >= PERCENT * (n[:, None] + n[None] - both)
            sure = lambda i, others: open_[i, others]
        else:
            sure = lambda i, others: np.array([bool(open_[i, j]) and similar(sets[i], sets[j]) for j in others], bool)
        return _links([(int(nodes[i]), int(nodes[j])) for i, j in _reached(comps, sure)])

    held = _may_be_in(sets, dealt, "node").join(dealt, "node").select("cluster", "one", "two", "comp", "node", "members")
    return held.groupBy("cluster", "one", "two").applyInArrow(compare, "a long, b long")


def _components(docs: DataFrame, words: int) -> DataFrame:
    """Per document: doc_id, place (hash of the text), n_shingles, comp (null for an empty set)."""
    found = materialize(features(docs, words), "near-features")
    index = materialize(_index(found), "near-index")
    entered = materialize(_entered(index), "near-entered")
    sketches = _node_sketches(index)
    shared = entered.groupBy("entry").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    met = materialize(entered.join(shared, "entry"), "near-met")
    # Most entries that two nodes alone share are chance: such pairs are looked at once, in a short form of the signatures.
    many = met.where("node <> first and node <> last").select("entry").distinct()
    two = met.where("node = first").select("entry", "first", "last").join(many, "entry", "left_anti")
    pairs = two.join(_plausible(two.select("first", "last").distinct(), sketches), ["first", "last"])
    held = materialize(
        met.join(many, "entry", "left_semi").select("entry", "node", "first").unionByName(
            pairs.select("entry", F.explode(F.array("first", "last")).alias("node"), "first")
        ),
        "near-entries",
    )
    first = held.groupBy("node").agg(F.min("first").alias("first"))
    place = found.where("node is not null").groupBy("node").agg(F.min("place").alias("place"))
    wanted = materialize(first.join(place, "node"), "near-wanted")
    sets = materialize(_sets(docs, wanted.select("node", "place"), words), "near-sets")
    stars = materialize(_stars(wanted.select("node", "first"), sets), "near-stars")
    comps = connected(stars)
    # A node without a confirmed link is a component of its own.
    named = held.select("entry", "node").join(comps, "node", "left").select("entry", "node", F.coalesce("label", "node").alias("comp"))
    open_ = named.groupBy("entry").agg(F.min("comp").alias("_a"), F.max("comp").alias("_z"), F.count(F.lit(1)).alias("n"))
    rows = materialize(named.join(open_.where("_a < _z").select("entry", "n"), "entry"), "near-open")
    clusters = connected(materialize(_near(rows, sketches), "near-plausible")).select(F.col("node").alias("comp"), F.col("label").alias("cluster"))
    nodes = rows.select("node", "comp").distinct().join(clusters, "comp")
    more = materialize(_blocks(nodes, sets), "near-links")
    labels = connected(stars.unionByName(more))
    return found.join(labels, "node", "left").select("doc_id", "place", "n_shingles", F.coalesce("label", "node").alias("comp"))


def near_groups(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows = _components(docs, words)
    names = rows.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("name"))
    named_rows = rows.join(names, "comp", "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("name"))
    return named_rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest doc_id, one without an id only if there is
    no other, and of several texts with that id one. Rows that agree in doc_id and text stay or go together."""
    rows = _components(docs, words).where("comp is not null")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    best = rows.groupBy("comp").agg(F.min(key).alias("best"))
    doc, place = free_name(docs, "_gone"), free_name(docs, "_gone_place")
    gone = rows.join(best, "comp").where(key != F.col("best")).select(F.col("doc_id").alias(doc), F.col("place").alias(place)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone[doc]) & (F.xxhash64(text_or_empty()) == gone[place])
    return docs.join(gone, same, "left_anti")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), words=2)


QUERIES = {"op3_minhash_near_dedup": (op3_minhash_near_dedup, None)}
