"""Candidates and job descriptions derived from the given tables, in Spark and in SQL.

The prose of the tables holds no skills, years or degrees. Every document becomes a candidate by putting a few lines in
front of its text, every benchmark item a job description likewise. The lines come from lists of cases, one for each rule
that the operators follow (spans that overlap, leave gaps, stay open, run backwards, ...), dealt by the row's number with
different moduli, so that all combinations occur. Next to every case stands what is expected of it, as a template over the
same numbers; the SQL side states that, without matching any pattern.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.stop_words import ENGLISH
from rankloom.functions.vocabulary import DEFAULT_VOCABULARY
from rankloom.runtime import spread

YEAR = 2026
# The year that span_validity_filter judges by.
EARLIER_YEAR = YEAR - 2

# The job that whole-table rankings use; every benchmark has it.
SINGLE_JOB = 2
# The jobs that one collection is ranked for at once.
SEVERAL_JOBS = [1, 4, 6]

STOP_WORDS = ENGLISH

CATEGORIES = ["QUALITY", "FIELD-SUPPORT", "SHOP-FLOOR", "FRONT-DESK", "BACK-OFFICE", "NIGHT-SHIFT", "TRANSPORT"]
RELEVANT_CATEGORIES = ["QUALITY", "BACK-OFFICE", "TRANSPORT"]

# Numbers in templates: {name+n} is start + document number % modulus + n; the one without a name is a year.
NUMBERS = {"": (2005, 7), "open": (2020, 6), "school": (1995, 4), "k": (1, 9)}
_NUMBER = re.compile(r"\{([a-z]*)\+?(\d*)\}")


class Spans(NamedTuple):
    """Lines about past work, and what is expected: spans found, those that are work, those valid in the earlier year,
    years covered."""

    lines: str | None = None
    found: str | None = None
    work: str | None = None
    earlier: str | None = None
    years: str = "0"


_FAR = "on the roads " * 5
SPAN_CASES = [
    Spans(),
    Spans("Dockhand {0} to {4}\nCrane crew {2} - {7}", "{0}-{4},{2}-{7}", "{0}-{4},{2}-{7}", "{0}-{4},{2}-{7}", "7"),
    Spans("Ledger room {0} \u2013 Sep {2}\nStock count {5}-{9}", "{0}-{2},{5}-{9}", "{0}-{2},{5}-{9}", "{0}-{2},{5}-{9}", "6"),
    # Of the open starts the last lies after the earlier year; OPEN_EARLIER says so in SQL.
    Spans("Night porter {open} to present", f"{{open}}-{YEAR}", f"{{open}}-{YEAR}", f"{{open}}-{EARLIER_YEAR}", f"({YEAR} - (2020 + doc_id % 6))"),
    Spans("Kiln {0} - {8}\nKiln hand {1} - {3}\nKiln {0} - {8}", *["{0}-{8},{1}-{3},{0}-{8}"] * 3, "8"),
    Spans(
        "Forge {3} - {0}\nLoom {0} till 2025\nBookings 2027 - 2029", "{3}-{0},{0}-2025,2027-2029", "{3}-{0},{0}-2025,2027-2029",
        None, "(2025 - (2005 + doc_id % 7))",
    ),
    Spans("Farm 1970 to 2020\nMill 1980 - 2025", "1970-2020,1980-2025", "1970-2020,1980-2025", None, "45"),
    Spans(
        f"Helper at a college {{0}} - {{3}}\nMasonry academy, {_FAR}{{1}} - {{5}}", "{0}-{3},{1}-{5}", "{1}-{5}", "{1}-{5}", "4"
    ),
]
# Every other document has a span that is schooling.
SCHOOL = ("Institute of joinery ({school} - {school+3})", "{school}-{school+3}")

# A statement of years and the years that count.
STATED_CASES = [
    (None, None),
    ("{k} years of site experience", "{k}"),
    ("{k}-{k+2} yrs\u2019 hands-on yard experience", "{k}"),
    ("50 years of proud house experience, {k}+ years in quiet trade experience", "{k}"),
    ("{k} years of deck experience and {k+3} yrs galley experience", "{k+3}"),
]

# Wordings of every education pattern, and the levels they name.
EDUCATION_CASES = [
    (None, []),
    ("Holds a doctorate", [4]),
    ("Ph.D, earlier M.Sc", [3, 4]),
    ("Master of Arts, Bachelors in Music", [2, 3]),
    ("PGDM and B.Com", [2, 3]),
    ("Postgraduate, diploma", [1, 3]),
    ("BCA", [2]),
    ("B. E with diploma", [1, 2]),
    ("To be an under-graduate", [2]),
]

HEADINGS = ["Nice to have:", "PREFERRED QUALIFICATIONS", "Bonus points:", "Good-to-have", "  Desirable:"]

# The last alias of a skill, where it has one, is its second spelling.
_ALIAS = {skill: alias for alias, skill in DEFAULT_VOCABULARY.skill_of.items() if alias != skill}
# (number, skill, category, spelling, second spelling)
SKILLS = [
    (k, skill, category, skill, _ALIAS.get(skill, skill).upper())
    for k, (skill, category) in enumerate(DEFAULT_VOCABULARY.category_of.items())
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _listed(number: Column, a: int, b: int, modulus: int, below: int, second: bool) -> Column:
    """Skills k with (number*a + k*b) % modulus < below, separated by commas; every third in its second spelling."""
    one, two = (F.split(F.lit("|".join(row[i] for row in SKILLS)), r"\|") for i in (3, 4))
    held = F.filter(F.sequence(F.lit(0), F.lit(len(SKILLS) - 1)), lambda k: (number * a + k * b) % modulus < below)
    spelling = lambda k: F.when(
        ((number + k) % 3 == 0) & F.lit(second), F.element_at(two, k + 1)
    ).otherwise(F.element_at(one, k + 1))
    return F.array_join(F.transform(held, spelling), ", ")


def _pick(options: list, number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (number % len(options) + 1).cast("int"))


def _filled(template: str | None, d: Column) -> Column:
    """A template with its numbers."""
    if template is None:
        return F.lit(None).cast("string")
    parts, at = [], 0
    for m in _NUMBER.finditer(template):
        start, modulus = NUMBERS[m[1]]
        parts += [F.lit(template[at : m.start()]), (d % modulus + start + int(m[2] or 0)).cast("string")]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def _case(templates: list, d: Column) -> Column:
    found = F
    for i, template in enumerate(templates):
        found = found.when(d % len(templates) == i, _filled(template, d))
    return found


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pos, id, category, text, jd_id)``; ``jd_id`` is the number of the document's source."""
    d = F.col("doc_id")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Entry "), d),
        _case([e[0] for e in EDUCATION_CASES], d),
        F.when(d % 2 == 0, _filled(SCHOOL[0], d)),
        F.concat(F.lit("Tools and trades: "), _listed(d, 7, 11, 29, 5, second=True)),
        _case([c.lines for c in SPAN_CASES], d),
        _case([s[0] for s in STATED_CASES], d),
        F.col("text"),
    )
    return documents(spark, sf_dir).select(
        d.alias("pos"),
        d.cast("string").alias("id"),
        F.when(d % 11 != 0, _pick(CATEGORIES, d * 5 + F.floor(d / 13))).alias("category"),
        text.alias("text"),
        F.substring("source", 4, 9).cast("bigint").alias("jd_id"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(jd_id, text)``, one job description per benchmark item."""
    j = F.col("item_id")
    required = _listed(j, 13, 7, 19, 2, second=False)
    education = (
        F.when(j % 8 == 4, F.lit("- Master's degree"))
        .when(j % 4 == 1, F.lit("- Bachelor’s degree"))
        .when(j % 4 == 2, F.lit("- Bachelor's or Master's degree"))
        .when(j % 4 == 3, F.lit("- PhD"))
    )
    optional = F.concat_ws(
        "\n",
        _pick(HEADINGS, j),
        F.concat(F.lit("- "), _listed(j, 5, 3, 17, 1, second=False)),
        F.lit("- Diploma welcome"),
    )
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Opening "), j),
        F.lit("Requirements:"),
        F.when(j % 8 != 7, F.concat(F.lit("- "), required)),
        F.when(j % 5 != 0, F.concat(F.lit("- "), j % 5 + 1, F.lit("+ years of experience"))),
        education,
        F.col("text"),
        F.when(j % 3 != 2, optional),
    )
    return table(spark, sf_dir, "benchmark").select(j.alias("jd_id"), text.alias("text"))


def single_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).where(F.col("jd_id") == SINGLE_JOB)


# ---- the same in SQL -------------------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(options: list) -> str:
    return "[" + ", ".join(quoted(o) if isinstance(o, str) else str(o) for o in options) + "]"


def sql_filled(template: str | None) -> str:
    if template is None:
        return "NULL"
    parts, at = [], 0
    for m in _NUMBER.finditer(template):
        start, modulus = NUMBERS[m[1]]
        parts += [quoted(template[at : m.start()]), f"CAST(doc_id % {modulus} + {start + int(m[2] or 0)} AS VARCHAR)"]
        at = m.end()
    return " || ".join([*parts, quoted(template[at:])])


def sql_case(values: list[str]) -> str:
    return f"CASE doc_id % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_VOCAB = ",\n    ".join(
    f"({k}, {quoted(skill)}, {quoted(category)}, {quoted(one)}, {quoted(two)})" for k, skill, category, one, two in SKILLS
)
_EARLIER = [sql_filled(c.earlier) for c in SPAN_CASES]
_EARLIER[3] = f"CASE WHEN 2020 + doc_id % 6 <= {EARLIER_YEAR} THEN {_EARLIER[3]} END"

# cand: the candidates with their expected features; skill_of: the expected skills of each.
CANDIDATE_SQL = f"""
vocab(k, skill, category, one, two) AS (VALUES
    {_VOCAB}),
held AS (
    SELECT doc_id AS pos, k, skill, CASE WHEN (doc_id + k) % 3 = 0 THEN two ELSE one END AS spelling
    FROM documents, vocab WHERE (doc_id * 7 + k * 11) % 29 < 5),
written AS (SELECT pos, string_agg(spelling, ', ' ORDER BY k) AS listed FROM held GROUP BY pos),
skill_of AS (
    SELECT pos, skill FROM held
    UNION SELECT pos, 'javascript' FROM held WHERE spelling = 'NODE JS'),
skill_list AS (SELECT pos, list(skill ORDER BY skill) AS skills FROM skill_of GROUP BY pos),
numbered AS (
    SELECT *,
        {sql_case([sql_filled(e[0]) for e in EDUCATION_CASES])} AS studies,
        {sql_case([f"CAST({sql_list(e[1])} AS INTEGER[])" for e in EDUCATION_CASES])} AS levels,
        CASE WHEN doc_id % 2 = 0 THEN {sql_filled(SCHOOL[0])} END AS school,
        CASE WHEN doc_id % 2 = 0 THEN {sql_filled(SCHOOL[1])} END AS school_spans,
        {sql_case([sql_filled(c.lines) for c in SPAN_CASES])} AS work,
        {sql_case([sql_filled(c.found) for c in SPAN_CASES])} AS spans,
        {sql_case([sql_filled(c.work) for c in SPAN_CASES])} AS work_spans,
        {sql_case(_EARLIER)} AS earlier_spans,
        {sql_case([c.years for c in SPAN_CASES])} AS covered,
        {sql_case([sql_filled(s[0]) for s in STATED_CASES])} AS statement,
        CAST({sql_case([sql_filled(s[1]) for s in STATED_CASES])} AS INTEGER) AS stated_years
    FROM documents),
cand AS (
    SELECT n.doc_id AS pos, CAST(n.doc_id AS VARCHAR) AS id,
        CASE WHEN n.doc_id % 11 <> 0 THEN {sql_list(CATEGORIES)}[(n.doc_id * 5 + n.doc_id // 13) % {len(CATEGORIES)} + 1] END AS category,
        CAST(substr(n.source, 4) AS BIGINT) AS source_no,
        concat_ws(chr(10), 'Entry ' || n.doc_id, studies, school, 'Tools and trades: ' || coalesce(w.listed, ''), work, statement,
            n.text) AS text,
        coalesce(s.skills, []) AS skills,
        CAST(coalesce(stated_years, covered) AS DOUBLE) AS experience_years,
        stated_years,
        levels,
        coalesce(list_max(levels), 0) AS education_level
    FROM numbered n LEFT JOIN written w ON w.pos = n.doc_id LEFT JOIN skill_list s ON s.pos = n.doc_id)"""

# prof: the expected profile of every job.
JOB_SQL = f"""
wanted AS (
    SELECT item_id AS jd_id, k, skill, one FROM benchmark, vocab
    WHERE (item_id * 13 + k * 7) % 19 < 2 AND item_id % 8 <> 7),
extra AS (SELECT item_id AS jd_id, k, skill, one FROM benchmark, vocab WHERE (item_id * 5 + k * 3) % 17 < 1),
wanted_list AS (
    SELECT jd_id, string_agg(one, ', ' ORDER BY k) AS listed, list(skill ORDER BY skill) AS skills FROM wanted GROUP BY jd_id),
extra_list AS (SELECT jd_id, string_agg(one, ', ' ORDER BY k) AS listed FROM extra GROUP BY jd_id),
nice_list AS (
    SELECT jd_id, list(skill ORDER BY skill) AS skills
    FROM (SELECT jd_id, skill FROM extra WHERE jd_id % 3 <> 2 EXCEPT SELECT jd_id, skill FROM wanted) GROUP BY jd_id),
prof AS (
    SELECT b.item_id AS jd_id,
        concat_ws(chr(10), 'Opening ' || b.item_id, 'Requirements:', '- ' || w.listed,
            CASE WHEN b.item_id % 5 <> 0 THEN '- ' || (b.item_id % 5 + 1) || '+ years of experience' END,
            CASE WHEN b.item_id % 8 = 4 THEN '- Master''s degree'
                 WHEN b.item_id % 4 = 1 THEN '- Bachelor' || chr(8217) || 's degree'
                 WHEN b.item_id % 4 = 2 THEN '- Bachelor''s or Master''s degree'
                 WHEN b.item_id % 4 = 3 THEN '- PhD' END,
            b.text) AS required_text,
        CASE WHEN b.item_id % 3 <> 2 THEN concat_ws(chr(10), {sql_list(HEADINGS)}[b.item_id % 5 + 1],
            '- ' || coalesce(e.listed, ''), '- Diploma welcome') END AS optional_text,
        concat_ws(chr(10), required_text, optional_text) AS text,
        coalesce(w.skills, []) AS required,
        coalesce(n.skills, []) AS nice,
        CASE WHEN b.item_id % 5 <> 0 THEN CAST(b.item_id % 5 + 1 AS DOUBLE) END AS min_years,
        CASE WHEN b.item_id % 8 = 4 THEN 3 WHEN b.item_id % 4 IN (1, 2) THEN 2 WHEN b.item_id % 4 = 3 THEN 4 END AS min_education
    FROM benchmark b LEFT JOIN wanted_list w ON w.jd_id = b.item_id
        LEFT JOIN extra_list e ON e.jd_id = b.item_id LEFT JOIN nice_list n ON n.jd_id = b.item_id)"""


def with_fixtures(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([CANDIDATE_SQL, JOB_SQL, *ctes]) + "\n" + select
