import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import suffix_dedup as sd
from tests.conftest import SF


def brute(rows):
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in texts:
        for k in range(len(b) - 49):
            least[b[k : k + 50]] = min(least.get(b[k : k + 50], float("inf")), i)
    out = []
    for (i, b), (doc, _) in zip(texts, rows):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if least[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    cut = sd.cut_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return sorted(map(tuple, cut.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, sd.op9_suffix_array_dedup(spark, SF).collect()), key=repr) == brute(rows)


def test_awkward_rows(documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents) == brute(rows)
    assert result(nothing) == []


def test_many_blocks_and_heavy_texts(spark, monkeypatch):
    """Repeats within and across blocks, copies spread over blocks, text that repeats itself, bytes 0 and 255."""
    monkeypatch.setattr(sd, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(sd, "HEAVY", 5)
    rng = random.Random(4)
    word = ["".join(rng.choices("abcdé\0", k=rng.randint(1, 7))) for _ in range(60)]
    shared = [" ".join(rng.choices(word, k=20)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choices(word, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        rows.append((rng.choice([i, i, 3, None]), "".join(parts)))
    rows += [(500 + i, shared[0] + shared[1]) for i in range(12)]
    rows += [(600, "ab" * 200), (601, "xab" * 90), (602, "a" * 300), (603, "a" * 49), (604, "a" * 50), (605, "b" + "a" * 51)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    raw = rng.integers(0, 1 + seed, 400).astype(np.uint8) + 97
    order = sd.suffix_array(raw, 64)
    text = raw.tobytes()
    assert [text[i : i + 64].ljust(64, b"\0") for i in order] == sorted(text[i : i + 64].ljust(64, b"\0") for i in range(len(text)))
    length = np.array([100, 80, 150, 70])
    got = sd.common_prefixes(raw, order, np.cumsum(length) - length, length)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :].ljust(600, b"\0"), text[order[k] :].ljust(600, b"\1")
        same = next(i for i in range(51) if i == 50 or a[i] != b[i])
        assert got[k] == same or min(len(text) - order[k - 1], len(text) - order[k]) <= same


def test_split_suffix_arrays_agree_with_one():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 3, 3000).astype(np.uint8) + 97
    at = rng.integers(0, 2900, 300)
    length = rng.integers(50, sd.LONGEST_RUN + 1, 300)
    rows = sd._run_rows(base, at, length)
    owner = rng.integers(0, 40, 300)
    one = sd.settle(rows, length.astype(np.uint8), owner)
    many = sd.settle(rows, length.astype(np.uint8), owner, shard_bytes=1500)
    assert (one == many).all() and one.any() and not one.all()


def test_minima_are_those_of_the_grams():
    raw = np.random.default_rng(0).integers(0, 5, 300).astype(np.uint8)
    low = sd.window_minima(raw)
    again = sd.window_minima(np.concatenate([raw[100:], raw[:100]]))
    assert len(low) == 251 and (low[100:] == again[:151]).all()
    single = np.array([sd.window_minima(raw[i : i + 50])[0] for i in range(251)])
    assert (single == low).all() and len(sd.window_minima(raw[:49])) == 0
