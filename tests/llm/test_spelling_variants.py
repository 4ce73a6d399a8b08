import random
import re
import zlib
from collections import Counter

import pytest

from rankloom.llm import spelling_variants
from rankloom.llm.spelling_variants import SQL, VariantIndex, group_variants, near_words, op11_spelling_variants, suffix_order
from tests.conftest import SF

SCHEMA = "doc_id long, text string, word string, n string, half int, asks string, shard string"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    lower = {c: c + 32 for c in range(65, 91)}
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute(words):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def got(docs):
    return sorted(map(tuple, group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_suffix_order():
    rng = random.Random(1)
    for n, letters in ((1, 1), (2, 1), (50, 2), (500, 3), (300, 1)):
        import numpy as np

        codes = np.array([rng.randint(1, letters) for _ in range(n)] + [0])
        raw = codes.tolist()
        assert suffix_order(codes).tolist() == sorted(range(n + 1), key=lambda i: raw[i:])


@pytest.mark.parametrize("letters, n, longest", [("ab", 60, 8), ("abc", 400, 9), ("aé÷z", 300, 8), ("a", 12, 40)])
def test_index_finds_all_and_only_words_one_apart(letters, n, longest):
    rng = random.Random(n)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)})
    # Not all words that ask are indexed, and some have letters that the index lacks.
    indexed, asking = words[:: 1 + n % 2], words + ["q" + w for w in words[:20]]
    index = VariantIndex(indexed)
    found = set()
    for right in (False, True):
        at, near = index.near(asking, right)
        found |= {(asking[i], indexed[k]) for i, k in zip(at, near)}
    assert found == {(a, b) for a in asking for b in indexed if one_apart(a, b)}


def test_each_half_is_enough_for_errors_in_the_other():
    index = VariantIndex(["abcdef"])
    for word, halves in (("abcxef", [0]), ("axcdef", [1]), ("abcde", [0]), ("bcdef", [1]), ("abcxdef", [0]), ("abdef", [0, 1]), ("axcdxf", [])):
        assert [h for h in (0, 1) if len(index.near([word], bool(h))[0])] == halves


def awkward(spark):
    rng = random.Random(3)
    base = ["Straßenbahn", "collection", "collections", "colection", "ÀÉÎÕÜßàé÷×", "aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabcabc"]
    words = base + [w[:k] + rng.choice("aeé") + w[k + 1 :] for w in base for k in range(len(w))]
    rows = []
    for i in range(120):
        some = [rng.choice(words[: 3 + rng.randint(0, len(words))]) for _ in range(60)]
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in some)))
    rows += [(None, "collection " * 9), (None, "Null id words"), (7, None), (7, ""), (8, "12 34 ·"), (8, "twice the same row collections")] * 2
    rows += [(900 + k, "long" * 1500 + "x" * (k > 9)) for k in range(15)]
    rows.append((999, "collection,Collections " * 3000 + "colection"))
    return spark.createDataFrame([(i, t, "w", "n", 1, "a", "s") for i, t in rows], SCHEMA), rows


def test_equals_brute_force(spark, documents, nothing):
    docs, rows = awkward(spark)
    want = brute(counted(rows))
    assert got(docs) == want
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] != r[2] for r in want if r[1]) and max(len(r[0]) for r in want) > 5000
    assert got(documents) == brute(counted([(r.doc_id, r.text) for r in documents.collect()]))
    assert got(nothing) == []


def test_texts_in_pieces_and_counts_passed_on_early(spark, monkeypatch):
    docs, rows = awkward(spark)
    monkeypatch.setattr(spelling_variants, "PIECE_CHARS", 7)
    n = Counter()
    for i, text in rows:
        spelling_variants.count_words(i, text or "", n)
    assert {w: c for w, c in n.items() if c >= 5} == counted(rows)


def test_halves_that_many_words_share_are_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 6))): 10 for _ in range(300)}
    words |= {"other" + str(k): k for k in range(50)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = sorted((a, words[a], b, words[b]) for a in words for b in words if one_apart(a, b))
    for rows in (20_000, 40, 7):
        monkeypatch.setattr(spelling_variants, "SHARD_ROWS", rows)
        assert sorted(map(tuple, near_words(table).collect())) == want


def test_query_equals_its_sql(spark):
    from catalog.check import compare

    verdict, rows, _, _ = compare(spark, SF, op11_spelling_variants, SQL)
    assert verdict == "ok" and rows > 500
