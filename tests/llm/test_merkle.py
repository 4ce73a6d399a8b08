import hashlib

import pytest
from pyspark.sql import functions as F

from rankloom.llm import merkle
from rankloom.llm.merkle import SQL, op13_merkle_manifest, proof_digest, verify
from tests.conftest import SF


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(leaves):
    """The root over a list of digests, and every leaf's siblings as (left, right) level by level."""
    paths = [[] for _ in leaves]
    nodes, places = list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for leaf, at in enumerate(places):
            run, own = runs[at // 3], at % 3
            paths[leaf].append(("".join(run[:own]), "".join(run[own + 1 :])))
        nodes, places = [h(*run) for run in runs], [at // 3 for at in places]
    return nodes[0], paths


def brute(rows, now):
    """``now`` gives the text that a row has by now."""
    sources = {}
    for row in rows:
        sources.setdefault(row.source, []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    grown = {}
    for name in names:
        ordered = sorted((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r) for r in sources[name])
        grown[name] = (climb([leaf for _, _, leaf, _ in ordered]), ordered)
    root, above = climb([grown[name][0][0] for name in names])
    out = []
    for name, upper in zip(names, above):
        (subroot, paths), ordered = grown[name]
        for (_, _, leaf, row), lower in zip(ordered, paths):
            path = lower + upper
            folded = leaf_of(row, now(row))
            for left, right in path:
                folded = h(left, folded, right)
            out.append((row.doc_id, leaf, subroot, root, h(*[x for step in path for x in step]), folded, folded == root))
    return sorted(out, key=repr)


def got(docs):
    columns = ["doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), "folded_root", "verified"]
    return sorted(map(tuple, verify(docs).select(*columns).collect()), key=repr)


def many(spark, sizes, schema="doc_id long, text string, lang string, source string, n_chars long, lo int, tree string, digest string"):
    rows = [
        (i * 7919 % 1000 + (s or "").__len__() * 1000, f"text {i}\nof {s}", None if i % 5 == 0 else "en", s, None if i % 7 == 0 else i, 1, "t", "d")
        for s, n in sizes.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "sizes",
    [{None: 1}, {"a": 3}, {"a": 82, None: 81, "": 1, "ä": 4, "z": 2, "Z": 9}, {"hot": 700, "b": 1}],
    ids=["one row", "one run", "sources of all sizes", "several buckets"],
)
def test_equals_brute_force(spark, sizes):
    docs = many(spark, sizes)
    assert got(docs) == brute(docs.collect(), lambda row: row.text)


def test_many_sources_make_a_tree_of_several_buckets(spark):
    docs = many(spark, {f"s{i:03}": 1 + i % 2 for i in range(100)})
    assert got(docs) == brute(docs.collect(), lambda row: row.text)


def test_tampered_rows_fail_and_no_others(spark):
    docs = many(spark, {"a": 90, "b": 5, None: 2})
    shorter = F.when(F.col("doc_id") % 3 == 0, merkle.leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    want = brute(docs.collect(), lambda row: row.text.replace("\n", "") if row.doc_id % 3 == 0 else row.text)
    assert got(docs.withColumn("_other", shorter)) == want
    assert all(r[-1] == (r[0] % 3 != 0) for r in want)


def test_awkward_rows(documents, nothing):
    docs = documents.select(*documents.columns)
    assert got(docs) == brute(docs.collect(), lambda row: row.text)
    assert got(nothing) == []


def test_query_equals_its_sql_and_a_brute_force(spark):
    import zlib

    from catalog.check import compare

    verdict, rows, _, _ = compare(spark, SF, op13_merkle_manifest, SQL)
    assert verdict == "ok" and rows == 200
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute(table, lambda r: r.text.replace("\n", "") if zlib.crc32(str(r.doc_id).encode()) % 2 == 0 else r.text)
    assert sorted(map(tuple, op13_merkle_manifest(spark, SF).collect()), key=repr) == want
