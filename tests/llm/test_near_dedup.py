import random
import re

import numpy as np
import pytest

from rankloom.llm import near_dedup as nd
from rankloom.llm.components import connected
from tests.conftest import SF, plan_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    """component_id by all pairs of full shingle sets."""
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    name = {i: min((x for x in g if x is not None), default=None) for i, g in groups.items()}
    out = []
    for i, (doc, _) in enumerate(rows):
        n = name[top(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), n, doc == n))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = nd.op3_minhash_near_dedup(spark, SF)
    assert "CartesianProduct" not in plan_of(df)
    assert sorted(map(tuple, df.collect()), key=repr) == brute(rows, 2)


@pytest.mark.parametrize("k", [2, 5])
def test_awkward_rows(documents, nothing, k):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, nd.near_groups(documents, k).collect()), key=repr) == brute(rows, k)
    assert nd.near_groups(nothing, k).count() == 0


@pytest.mark.parametrize("k", [2, 5])
def test_sets_of_three_to_six_shingles(spark, k):
    """A set of four in a set of five is a link, and can be the middle of a chain; three in four is none."""
    rows = []
    for case in range(6):
        # Texts of n shingles have n + k - 1 words.
        w = [f"c{case}.{i}" for i in range(6 + k)]
        cuts = [w[1 : k + 5], w[1 : k + 4], w[: k + 4], w[: k + 5], w[1 : k + 3]]
        rows += [(100 * case + i, " ".join(c)) for i, c in enumerate(cuts[: 3 + case % 3])]
    got = sorted(map(tuple, nd.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k).collect()), key=repr)
    assert {n for _, n, _, _ in got} == {3, 4, 5, 6}
    assert got == brute(rows, k)
    # The texts of five shingles share four of six: only the one of four joins them.
    assert {(doc, name) for doc, _, name, _ in got if doc < 3} == {(0, 0), (1, 0), (2, 0)}


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """One text with edits: stars and blocks are both split, and most links do not lead to the first document."""
    monkeypatch.setattr(nd, "SPLIT", 20)
    monkeypatch.setattr(nd, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        rows.append((i + 1, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{i}.{j}" for j in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, nd.near_groups(df, 2).collect()), key=repr) == brute(rows, 2)


def test_entries_meet_whenever_signatures_are_within_the_distance():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 16, (500, nd.VALUES)).astype(np.uint16)
    b = a.copy()
    for i in range(500):
        b[i, rng.choice(nd.VALUES, nd.DISTANCE, replace=False)] += 1
    for x, y in zip(nd.entries(a), nd.entries(b)):
        assert set(x.tolist()) & set(y.tolist())


def test_packed_sets_come_back():
    s = nd.shingle_set("a b c d e f " * 30 + " ".join(map(str, range(99))))
    assert (nd._unpack(nd._pack(s)) == s).all() and (np.diff(s) > 0).all()


def test_drop_keeps_columns_and_one_of_each_group(documents, nothing):
    left = nd.drop_near_copies(documents, 5)
    assert left.columns == documents.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 5, 6, 7, 8, 10, 12, 12, 13, 14, 15]
    assert nd.drop_near_copies(nothing, 5).count() == 0


def test_drop_decides_by_row(spark):
    """One id with two texts, near copies without an id, near copies with one id, and groups without any id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (2, a + " z"), (2, b), (None, a + " y"), (3, c), (3, c + " z"), (None, d), (None, d + " z"), (None, "alone"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {}
    for r in nd.drop_near_copies(df, 5).collect():
        left.setdefault(r.doc_id, []).append(r.text)
    assert left[1] == [a] and left[2] == [b]
    assert len(left[3]) == 1 and left[3][0] in (c, c + " z")
    assert sorted((t or "-")[:2] for t in left[None]) == ["-", "al", "d0"]


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(100, i) for i in range(101, 140)]
    df = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    got = {r.node: r.label for r in connected(df).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}
    assert connected(df.limit(0)).count() == 0


def test_sketches_never_differ_more_than_signatures():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 16, (300, nd.VALUES)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.4, rng.integers(0, 1 << 16, a.shape), a).astype(np.uint16)
    differ = nd._sketches(a) ^ nd._sketches(b)
    apart = ((differ & 15) > 0).sum(1) + (differ > 15).sum(1)
    assert (apart <= (a != b).sum(1)).all() and apart.mean() > 0.9 * (a != b).sum(1).mean()


def test_fewer_links_keep_the_components(spark):
    import random

    from rankloom.llm.components import connected, fewer_links

    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000 + i, 1000 + i % 7) for i in range(7, 200)]
    links += [(2000 + rng.randrange(60), 2100 + rng.randrange(60)) for _ in range(2000)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    table = spark.createDataFrame(links, "a long, b long")
    less = fewer_links(table)
    assert less.count() < 1000
    for some in (table, less):
        assert {r.node: r.label for r in connected(some).collect()} == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}


def _chance(spark, n=400, words=30, vocabulary=160):
    """Texts of common words: many share entries by chance, and few are near."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(words))) for i in range(n)]
    rows += [(n + i, rows[i][1] + " end") for i in range(20)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_entries_shared_by_chance_join_no_clusters(spark, monkeypatch):
    """What is compared in blocks, each block with each, must not grow with chance meetings: nodes within the distance only."""
    rows, df = _chance(spark)
    seen = []
    monkeypatch.setattr(nd, "_blocks", lambda nodes, *more, put=nd._blocks: seen.append(nodes.count()) or put(nodes, *more))
    assert sorted(map(tuple, nd.near_groups(df, 1).collect()), key=repr) == brute(rows, 1)
    sets = {nd._node(s): s for s in (nd.shingle_set(t, 1) for _, t in rows)}
    sketch = nd._sketches(nd.signatures(list(sets.values())))
    near = np.array([(nd._apart(s[None], sketch) <= nd.DISTANCE).sum() > 1 for s in sketch])
    assert 0 < near.sum() < len(sets) / 2 and seen[0] <= near.sum()


def test_entries_that_may_be_shared_are_all_those_shared(spark, monkeypatch):
    monkeypatch.setattr(nd, "PACKED", 50)
    monkeypatch.setattr(nd, "ENTRIES", 3000)
    rows, df = _chance(spark)
    found = nd.features(df.unionAll(df), 1)
    assert "entries" not in found.columns
    sets = {nd._node(s): s for s in (nd.shingle_set(t, 1) for _, t in rows)}
    owners = {}
    for node, row in zip(sets, nd.entries(nd.signatures(list(sets.values())))):
        for e in row.tolist():
            owners.setdefault(e, set()).add(node)
    shared = {(e, n) for e, some in owners.items() if len(some) > 1 for n in some}
    got = [tuple(r) for r in nd._entered(nd._index(found)).collect()]
    assert len(got) == len(set(got)) and shared <= set(got)
    assert len(shared) < len(owners) / 2 and len(got) < 1.01 * len(shared) + 10
    assert nd._entered(nd._index(found.limit(0))).count() == 0


@pytest.mark.parametrize("most", [4, 1 << 14])
def test_near_nodes_of_open_entries_join_their_components(spark, monkeypatch, most):
    """Large entries are compared in parts; what is joined is what all plausible pairs join."""
    monkeypatch.setattr(nd, "OPEN", most)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 256, (6, nd.VALUES // 2)).astype(np.uint8)
    sketch = base[rng.integers(0, 6, 60)]
    sketch = np.where(rng.random(sketch.shape) < 0.25, rng.integers(0, 256, sketch.shape), sketch).astype(np.uint8)
    comp = [int(rng.integers(0, 25)) for _ in range(60)]
    rows = [(e, i, comp[i]) for e in range(12) for i in rng.choice(60, 2 + 2 * e, replace=False).tolist()]
    sizes = {e: 2 + 2 * e for e in range(12)}
    frame = spark.createDataFrame([(*r, sizes[r[0]]) for r in rows], "entry long, node long, comp long, n long")
    sketches = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sketch)], "node long, sketch binary")

    def joined(links):
        root = {c: c for c in comp}

        def top(c):
            while root[c] != c:
                c = root[c]
            return c

        for a, b in links:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {c: top(c) for c in comp}

    every = [
        (comp[i], comp[j]) for e in sizes for x, i, _ in rows for y, j, _ in rows
        if x == y == e and i < j and nd._apart(sketch[i][None], sketch[j][None])[0] <= nd.DISTANCE
    ]
    want = joined(every)
    assert 1 < len(set(want.values())) < len(set(comp))
    assert joined([tuple(r) for r in nd._near(frame, sketches).collect()]) == want


def test_common_members_are_counted():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(30)]
    column, owner, columns = nd._columns(sets)
    both = nd._common(30, column, owner, columns, width=64)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_blocks_confirm_alike_in_either_way(spark, monkeypatch):
    rows, df = _chance(spark, 150, 20, 60)
    for products in (0, 1 << 60):
        monkeypatch.setattr(nd, "PRODUCTS", products)
        assert sorted(map(tuple, nd.near_groups(df, 1).collect()), key=repr) == brute(rows, 1)
