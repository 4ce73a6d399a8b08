"""Secret scan through a trigram index.

From every rule's regular expression a Boolean query over trigrams is derived: which trigrams, folded to lower-case ASCII
letters, must be in any text that the rule matches. Documents are indexed in segments, as they come: for each trigram that
some rule asks for, the sorted list of the segment's documents that hold it. A rule's query is answered by intersecting
and uniting these lists, and only the documents found are run through the regular expression. Rules without mandatory
trigrams (a run of hexadecimal digits) scan every document. The index only ever rules documents out, so results are those
of a full scan.

Segments are the batches of a task: nothing is shuffled, and a lost task is done again on its own.

Defined results. A null text counts as empty. Spans are code points, end exclusive, found per rule from left to right
without overlaps. Repeated rows are scanned each on their own. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as K
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import table, text_or_empty

# An exact set of strings larger than this is no longer followed.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters. ASCII rules only."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The kinds of secret, in the order in which spans at one place are listed. A run of hexadecimal digits is
# always matched whole, so asking for 32 at once finds the same runs as dropping shorter ones afterwards.
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
)
MORE = (
    Rule("private_key", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]{36}"),
)

# A query is True (any text), a trigram, or ("and" | "or", queries).


def _all(queries: list) -> object:
    rest = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not rest else rest[0] if len(rest) == 1 else ("and", tuple(rest))


def _any(queries: list) -> object:
    if not queries or True in queries:
        return True
    rest = list(dict.fromkeys(queries))
    return rest[0] if len(rest) == 1 else ("or", tuple(rest))


def _of_strings(strings: set[str]) -> object:
    """Some of the strings is in the text."""
    found = []
    for s in sorted(strings):
        raw = s.encode()
        found.append(_all([raw[i : i + 3] for i in range(len(raw) - 2)]))
    return _any(found)


def _fold(character: int) -> str:
    c = chr(character)
    return c.lower() if c.isascii() else c


def _node(kind, value) -> tuple[set[str] | None, object]:
    if kind is K.LITERAL:
        return {_fold(value)}, True
    if kind is K.IN:
        members = set()
        for sub, x in value:
            if sub is K.LITERAL:
                members.add(_fold(x))
            elif sub is K.RANGE and x[1] - x[0] < MOST_STRINGS:
                members |= {_fold(c) for c in range(x[0], x[1] + 1)}
            else:
                return None, True
        return (members if len(members) <= 8 else None), True
    if kind is K.BRANCH:
        return _branch([derive_parts(b) for b in value[1]])
    if kind is K.SUBPATTERN:
        return derive_parts(value[3])
    if kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        least, most, sub = value
        strings, query = derive_parts(sub)
        if least == 0:
            return (strings | {""} if most == 1 and strings is not None else None), True
        if strings is None or least != most:
            return (strings if most == 1 else None), _all([query, True if strings is None else _of_strings(strings)])
        repeated = {""}
        for _ in range(least):
            repeated = {a + b for a in repeated for b in strings}
            if len(repeated) > MOST_STRINGS:
                return None, _all([query, _of_strings(strings)])
        return repeated, query
    if kind in (K.AT, K.ASSERT, K.ASSERT_NOT):
        return {""}, True
    return None, True


def _branch(parts: list) -> tuple[set[str] | None, object]:
    strings: set[str] | None = set()
    for s, _ in parts:
        strings = None if s is None or strings is None else strings | s
    if strings is not None and len(strings) <= MOST_STRINGS:
        return strings, True
    return None, _any([_all([q, True if s is None else _of_strings(s)]) for s, q in parts])


def derive_parts(items) -> tuple[set[str] | None, object]:
    """The exact strings of a sequence, if they are few, else None; and the query that holds beside them."""
    runs: list[set[str] | None] = [{""}]
    queries: list = []
    for kind, value in items:
        strings, query = _node(kind, value)
        queries.append(query)
        if strings is None:
            runs.append(None)
        elif runs[-1] is not None and len(runs[-1]) * len(strings) <= MOST_STRINGS:
            runs[-1] = {a + b for a in runs[-1] for b in strings}
        else:
            runs.append(strings)
    if len(runs) == 1:
        return runs[0], _all(queries)
    return None, _all(queries + [_of_strings(r) for r in runs if r is not None])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every match of ``pattern`` satisfies; True if nothing is mandatory."""
    strings, query = derive_parts(_parser.parse(pattern, re.ASCII))
    return _all([query, True if strings is None else _of_strings(strings)])


def trigrams_of(query: object) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*(trigrams_of(q) for q in query[1]))


def _code(trigram: bytes) -> int:
    return int.from_bytes(trigram, "big")


def post(texts: list[str], wanted: list[bytes]) -> dict[bytes, np.ndarray]:
    """The postings of one segment: for each wanted trigram the sorted numbers of the texts that hold it."""
    ids = np.zeros(1 << 24, np.uint16)
    ids[[_code(t) for t in wanted]] = np.arange(1, len(wanted) + 1)
    raw = [t.encode().lower() for t in texts]
    # 0xFF is in no UTF-8 text, so no trigram crosses the border of two texts.
    at = np.cumsum([len(r) + 1 for r in raw])
    whole = np.frombuffer(b"\xff".join(raw), np.uint8)
    postings = [np.zeros(0, np.int64)] * len(wanted)
    pairs = []
    for begin in range(0, max(0, len(whole) - 2), 1 << 22):
        part = whole[begin : begin + (1 << 22) + 2].astype(np.int32)
        found = ids[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
        hits = np.flatnonzero(found)
        pairs.append(np.unique(found[hits].astype(np.int64) << 40 | np.searchsorted(at, hits + begin, "right")))
    if pairs:
        both = np.unique(np.concatenate(pairs))
        split = np.searchsorted(both >> 40, np.arange(1, len(wanted) + 2))
        postings = [both[split[i] : split[i + 1]] & ((1 << 40) - 1) for i in range(len(wanted))]
    return dict(zip(wanted, postings))


def candidates(query: object, postings: dict[bytes, np.ndarray], everything: int) -> np.ndarray:
    """The texts of a segment that a query lets through."""
    if query is True:
        return np.arange(everything)
    if isinstance(query, bytes):
        return postings[query]
    found = [candidates(q, postings, everything) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    out = min(found, key=len)
    for f in found:
        out = np.intersect1d(out, f, assume_unique=True)
    return out


def find(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Spans per text as (start, rule number, end), in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams_of, queries)))
    postings = post(texts, wanted)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        pattern = rule.compiled()
        for i in candidates(query, postings, len(texts)):
            for m in pattern.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    spans[i].append((m.start(), k, m.end()))
    for s in spans:
        s.sort()
    return spans


def index_trigrams(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """The index as a table: segment, trigram, documents (their ids, in order of the segment)."""
    wanted = sorted(set().union(*(trigrams_of(trigram_query(r.pattern)) for r in rules)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for n, batch in enumerate(batches):
            postings = {t.decode(): p for t, p in post(batch.column(1).to_pylist(), wanted).items() if len(p)}
            segment = f"{TaskContext.get().partitionId()}-{n}"
            held = [batch.column(0).take(pa.array(p)).to_pylist() for p in postings.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment] * len(held), pa.string()), pa.array(list(postings), pa.string()), pa.array(held, pa.list_(pa.int64()))],
                names=["segment", "trigram", "documents"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(build, "segment string, trigram string, documents array<long>")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Per document: doc_id and ``found``, its spans in order as an array of kind, start and end."""

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = find(batch.column(1).to_pylist(), rules)
            found = pa.array([[{"kind": rules[k].name, "start": a, "end": b} for a, k, b in s] for s in spans], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "found"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, found array<struct<kind:string,start:int,end:int>>")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin([r.name for r in BASE]))

    def listed(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(r.name) for r in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


QUERIES = {"op5_secret_scan": (op5_secret_scan, None)}
