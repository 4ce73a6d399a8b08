import hashlib

from pyspark.sql import functions as F

from rankloom.llm import line_dedup
from rankloom.llm.line_dedup import SQL, drop_shared_lines, op12_line_dedup, split_documents
from tests.conftest import SF

LONG = "A line that is Long enough to be COUNTED, with Ünïcode"
SCHEMA = "doc_id long, text string, hash string, pos int, _doc long, row string, keeper int, gone string, lines string"


def brute(rows, least_chars=40, least_documents=5):
    """(doc_id, kept text) by counting every key over all rows."""
    lower = str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower())

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(lower)

    def place(i):
        return -(1 << 63) if i is None else i

    held = {}
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= least_chars:
                held.setdefault(k, []).append(place(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < least_documents or max(held[key(x)]) == place(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def got(docs):
    split = split_documents(docs)
    rows = split.select("row.doc_id", F.size("lines"), F.coalesce(F.size("gone"), F.lit(0)), line_dedup._kept())
    return sorted(map(tuple, rows.collect()), key=repr)


def awkward(spark):
    rows = [(i, f"own {i}\n {LONG.upper() if i % 2 else LONG}\t\r\n\n{LONG}\nend") for i in range(7)]
    rows = [(i, t.replace("ÜNÏCODE", "Ünïcode")) for i, t in rows]
    rows += [
        (None, LONG), (None, LONG + "\n" + LONG), (None, None), (20, None), (21, ""), (22, "\n"), (23, "\n\n" + LONG + "\n"),
        # Twice the same row, and the largest id of the key: both keep it.
        (24, "x\n" + LONG), (24, "x\n" + LONG),
        # 39 code points, however many bytes; 40; Ä is not Ä in lower case.
        *[(30 + i, "ä" * 39) for i in range(6)], *[(40 + i, "ä" * 40) for i in range(6)],
        *[(50 + i, ("Ä" if i else "ä") * 45) for i in range(5)],
        # Four documents, one of which holds it three times.
        *[(60 + i, "\n".join(["four documents hold this line, and no more"] * (1 + 2 * (i == 0)))) for i in range(4)],
        # A very long text of one line over and over.
        (70, "\n".join([LONG, *map(str, range(3000))] * 20)),
    ]
    return spark.createDataFrame([(i, t, "h", 1, 2, "r", 3, "g", "l") for i, t in rows], SCHEMA), rows


def test_equals_brute_force(spark):
    docs, rows = awkward(spark)
    want = brute(rows)
    assert got(docs) == want
    assert sum(r[2] for r in want) > 20 and any(r[2] == r[1] for r in want)


def test_texts_come_back_with_all_columns(spark, documents, nothing):
    docs, rows = awkward(spark)
    out = drop_shared_lines(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(((i, t) for i, _, _, t in brute(rows)), key=repr)
    assert got(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])
    assert got(nothing) == [] and drop_shared_lines(nothing).count() == 0


def test_frequent_lines_take_the_other_way_to_the_same_result(spark, monkeypatch):
    docs, rows = awkward(spark)
    monkeypatch.setattr(line_dedup, "HEAVY_ROWS", 6)
    assert got(docs) == brute(rows)


def test_query_equals_its_sql(spark):
    from catalog.check import compare

    verdict, rows, _, _ = compare(spark, SF, op12_line_dedup, SQL)
    assert verdict == "ok" and rows == 200
