import hashlib
import re

from rankloom.llm.secrets import BASE, MORE, Rule, candidates, find, index_trigrams, op5_secret_scan, post, scan, trigram_query, trigrams_of
from tests.conftest import SF


def brute(text):
    """The base kinds by their definition, without an index."""
    kinds = [
        ("(password|passwd|secret|token|api_?key)", 2, 8, "assign"), ("AKIA[A-Z0-9]+", 0, 16, "access"), ("[0-9a-f]+", 0, 32, "hex"),
    ]
    assign = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = []
    for k, (pattern, group, least, name) in enumerate(kinds):
        for m in (assign if k == 0 else re.compile(pattern)).finditer(text):
            if len(m.group(group)) >= least:
                out.append((m.start(), k, m.end(), name))
    return [f"{n}:{a}:{b}" for a, _, b, n in sorted(out)]


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(r.spans.split(","))


def test_awkward_rows(documents, nothing):
    rows = scan(documents).collect()
    assert len(rows) == documents.count() and scan(nothing).count() == 0
    assert [(s.kind, s.start, s.end) for s in next(r for r in rows if r.doc_id == 15).found] == [
        ("assign", 0, 15), ("access", 16, 36), ("hex", 37, 85)
    ]


def test_case_and_overlap_rules():
    texts = ["PassWord = 'abcdefgh'", "toKen=secret:abcdefghij", "to\u212aen=abcdefgh", "ſecret=abcdefgh", "API_KEY:\"abcd.efg=", "x" * 40, "AKIA" + "B" * 11, "ab" * 15]
    rules = tuple(BASE)
    got = [[f"{rules[k].name}:{a}:{b}" for a, k, b in spans] for spans in find(texts, rules)]
    assert got == [brute(t) for t in texts]


def test_index_never_rules_out_a_match():
    rules = (*BASE, *MORE, Rule("odd", "(?:abc|ab[0-9]{2}x)+d?e{2}f|xyzzy"), Rule("none", "[a-z]{3}"), Rule("caseless", "(?i:HeLLo)\\s+wor(?=ld)"))
    texts = ["abcabceef", "ab12xdeef", "XYZZY", "xyzzy", "hello  world HELLO world", "éabceef", "", "ab", "ghp_" + "a1B2" * 9]
    for rule in rules:
        query = trigram_query(rule.pattern)
        postings = post(texts, sorted(trigrams_of(query)))
        through = set(candidates(query, postings, len(texts)).tolist())
        assert {i for i, t in enumerate(texts) if rule.compiled().search(t)} <= through
    assert trigram_query("[0-9a-f]{32,}") is True
    assert trigram_query("AKIA[A-Z0-9]+") == ("and", (b"aki", b"kia"))


def test_index_as_a_table(documents):
    rows = {r.trigram: r.documents for r in index_trigrams(documents.coalesce(1)).collect()}
    assert rows["aki"] == [15]
