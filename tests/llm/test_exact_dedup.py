import hashlib
import random

from rankloom.llm.exact_dedup import SQL, CuckooIndex, delete_rows, digests, drop_copies, groups, mark_copies
from tests.conftest import SF


def digest(i: int) -> bytes:
    return hashlib.sha256(str(i).encode()).digest()


def test_index_inserts_finds_deletes_and_grows():
    index = CuckooIndex(4)
    live = {}
    rng = random.Random(1)
    for i in range(3000):
        d = digest(i)
        assert index.find(d) is None
        index.insert(d, [i])
        live[d] = i
        if rng.random() < 0.4:
            gone = rng.choice(list(live))
            assert index.delete(gone)
            del live[gone]
    assert index.resizes > 3 and index.live == len(live)
    assert all(index.find(d) == [i] for d, i in live.items())
    assert all((index.find(digest(i)) is None) == (digest(i) not in live) for i in range(4000))
    assert not index.delete(digest(99_999))
    assert int((index.table > 0).sum()) == len(live)


def brute(rows):
    space = str.maketrans("", "", " \t\n\x0b\x0c\r")
    by_text = {}
    for i, t in rows:
        t = t or ""
        by_text.setdefault(t.translate(space), []).append((-len(t), i is None, i))
    out = []
    for i, t in rows:
        key = (t or "").translate(space)
        chars, _, keep = min(by_text[key], key=lambda e: (e[0], e[1], e[2] or 0))
        out.append((i, keep, len(by_text[key]), i == keep and len(t or "") == -chars, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_marks_equal_brute_force(documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(map(tuple, mark_copies(documents).collect()), key=repr) == brute(rows)
    assert mark_copies(nothing).count() == 0


def test_drop_keeps_one_row_of_each_group_and_all_columns(documents, nothing):
    left = drop_copies(documents)
    assert left.columns == documents.columns
    kept = sorted((r.doc_id, r.text) for r in left.collect() if r.doc_id is not None)
    assert [i for i, _ in kept] == [3, 4, 7, 8, 10, 12, 13, 14, 15]
    assert drop_copies(nothing).count() == 0


def test_rows_leave_the_index(spark, documents):
    rows = digests(documents)
    index = groups(rows, 2)
    after = {bytes(r.digest): (r.keep_id, r.group_size) for r in delete_rows(index, rows, rows.where("doc_id in (3, 8)")).collect()}
    of = {r.doc_id: bytes(r.digest) for r in rows.collect()}
    assert after[of[1]] == (1, 3)
    assert after[of[9]] == (9, 1)
    alone = delete_rows(index, rows, rows.where("doc_id = 15"))
    assert of[15] not in {bytes(r.digest) for r in alone.collect()}


def test_query_equals_its_sql(spark):
    from catalog.check import compare
    from rankloom.llm.exact_dedup import op7_exact_dedup

    assert compare(spark, SF, op7_exact_dedup, SQL)[0] == "ok"
