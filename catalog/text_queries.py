"""Sources, text scalars, features and job descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import features, terms, text
from rankloom.functions.vocabulary import DEFAULT_VOCABULARY
from rankloom.operators import insights, jobs as job_ops, vocabulary_join
from rankloom.runtime import scratch_path
from rankloom.sources import readers, sinks

from . import fixtures as fx
from .fixtures import YEAR, quoted, table, with_fixtures

# Unicode word and space characters as RE2 spells them.
W, S = r"\p{L}\p{N}_", r"\t-\r\x1c-\x20\x85\p{Z}"


# ---- SQL building blocks --------------------------------------------------------------------


def sql_clean(x: str) -> str:
    plain = f"translate({x}, chr(8217) || chr(8216) || chr(160), '''''' || ' ')"
    spaced = f"regexp_replace({plain}, '[ \\t]+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({spaced}, '\\n[{S}]*\\n+', chr(10), 'g'), '\\A[{S}]+|[{S}]+\\z', '', 'g')"


def sql_email(x: str) -> str:
    return f"regexp_replace({x}, '[{W}.+-]+@[{W}-]+\\.[{W}.-]+', ' ', 'g')"


def sql_url(x: str) -> str:
    return f"regexp_replace({x}, '(?:https?://|www\\.)[^{S}]+', ' ', 'g')"


def sql_phone(x: str) -> str:
    """Bracket every run with control characters, cut there and judge each run.

    RE2 cannot look around, and a boundary taken by one run is missing for the next. So every
    character that may stand in front of a run is followed by a mark first; a run starts behind a
    mark, takes the character behind it along, and leaves that character's own mark to the next.
    """
    mark = r"\x03"
    run = (
        rf"(^|{mark})((?:\+{mark})?(?:\({mark})?\p{{Nd}}(?:\p{{Nd}}|[{S}().-]{mark}){{8,}}\p{{Nd}})($|[^{W}/{mark}])"
    )
    marked = f"regexp_replace({x}, '([^{W}/])', '\\1' || chr(3), 'g')"
    bracketed = f"regexp_replace({marked}, '{run}', '\\1' || chr(1) || '\\2' || chr(2) || '\\3', 'g')"
    number = "split_part(p, chr(2), 1)"
    count = f"length(regexp_replace({number}, '[^\\p{{Nd}}]', '', 'g'))"
    judged = (
        f"CASE WHEN contains(p, chr(2)) THEN (CASE WHEN {count} BETWEEN 10 AND 15 THEN ' ' ELSE {number} END) "
        f"|| split_part(p, chr(2), 2) ELSE p END"
    )
    joined = f"array_to_string(list_transform(string_split({bracketed}, chr(1)), lambda p: {judged}), '')"
    return f"replace({joined}, chr(3), '')"


def sql_pii(x: str) -> str:
    return sql_phone(sql_url(sql_email(x)))


SQL_STOP = "(" + ", ".join(map(quoted, fx.STOP_WORDS)) + ")"


def sql_grams(x: str) -> str:
    """Tokens without stop words, then pairs, of a list expression computed once in a subquery."""
    return f"list_filter(regexp_extract_all(lower({x}), '[{W}]{{2,}}'), lambda w: w NOT IN {SQL_STOP})"


# ---- sources --------------------------------------------------------------------------------


def _in_files(rows: DataFrame, number: str, label: str, fmt: str = "csv", **options) -> list[str]:
    """``rows`` in three folders of unequal size, in order of ``number``; a small one comes first.

    Each is written in ranges of ``number``, so that no task reads or writes all rows; files in order of their names, one after
    the other, hold the rows as one file would. Rows of one number keep the order in which they are read.
    """
    folder, n = scratch_path(rows.sparkSession, label), F.col(number)
    parts = {"a": n % 7 == 0, "b": n % 7 > 1, "c": n % 7 == 1}
    for name, held in parts.items():
        placed = rows.where(held).withColumn("_read", F.monotonically_increasing_id())
        ranges = placed.repartitionByRange(number, "_read").sortWithinPartitions(number, "_read")
        ranges.drop(number, "_read").write.format(fmt).options(**options).save(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in parts]


# The place of a document in those files.
FILE_PLACE = "row_number() OVER (ORDER BY CASE doc_id % 7 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END, doc_id) - 1"
CSV = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All documents through CSV files with quotes and line breaks, then cleaned and redacted."""
    raw = table(spark, sf, "documents").select(
        "doc_id", F.col("doc_id").alias("ID"), F.col("source").alias("Category"), F.col("text").alias("Resume_str")
    )
    return readers.load_csv(spark, _in_files(raw.withColumnRenamed("doc_id", "_number"), "_number", "documents-csv", **CSV))


def csv_scan_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same files, split among tasks wherever they can be, line breaks in fields or not."""
    raw = table(spark, sf, "documents").select(
        "doc_id", F.col("doc_id").alias("ID"), F.col("source").alias("Category"), F.col("text").alias("Resume_str")
    )
    return readers.load_large_csv(spark, _in_files(raw.withColumnRenamed("doc_id", "_number"), "_number", "documents-csv", **CSV))


CSV_SCAN = (
    f"SELECT {FILE_PLACE} AS pos, CAST(doc_id AS VARCHAR) AS id, source AS category, {sql_pii(sql_clean('text'))} AS text FROM documents"
)


def resolve_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A table without id and category: row numbers over all files become ids."""
    raw = table(spark, sf, "documents").select("doc_id", "lang", F.col("text").alias("Resume"), F.col("n_chars"))
    files = _in_files(raw, "doc_id", "documents-parquet", "parquet")
    return readers.resolve_columns(spark.read.parquet(*files)).select("pos", "id", "category", F.md5("text").alias("digest"))


RESOLVE_COLUMNS = f"""
SELECT pos, CAST(pos AS VARCHAR) AS id, '' AS category, digest
FROM (SELECT {FILE_PLACE} AS pos, md5(text) AS digest FROM documents)"""


def _write_files(rows: DataFrame, label: str) -> str:
    """One file for each ``(name, content)``, in a new folder."""
    folder = scratch_path(rows.sparkSession, label)

    def put(some) -> None:
        from pyarrow import fs

        plain = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
        store, base = (fs.LocalFileSystem(), plain) if plain.startswith("/") else fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        for row in some:
            with store.open_output_stream(f"{base}/{row.name}") as out:
                out.write(bytes(row.content))

    rows.select("name", "content").foreachPartition(put)
    return folder


def folder_scan_txt(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as text files, with suffixes in either case and a byte that is not UTF-8 in each, among other files."""
    suffix = F.when(F.col("doc_id") % 2 == 0, F.lit(".txt")).otherwise(F.when(F.col("doc_id") % 5 == 0, F.lit(".md")).otherwise(F.lit(".TXT")))
    files = table(spark, sf, "documents").select(
        F.concat(F.lit("doc."), F.col("doc_id"), suffix).alias("name"),
        F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF"))).alias("content"),
    )
    return readers.load_folder(spark, _write_files(files, "inbox"), redact=False)


FOLDER_SCAN = f"""
SELECT row_number() OVER (ORDER BY 'doc.' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.txt' ELSE '.TXT' END) - 1 AS pos,
    'doc.' || doc_id AS id, '' AS category, {sql_clean('text')} AS text
FROM documents WHERE doc_id % 2 = 0 OR doc_id % 5 <> 0"""


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources of several files each below each other; ``pos`` in order of sources, files and rows."""
    documents = table(spark, sf, "documents").select("doc_id", F.col("doc_id").alias("id"), F.col("lang").alias("category"), "text")
    files = _in_files(documents.withColumnRenamed("doc_id", "_number"), "_number", "documents-parquet", "parquet")
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("ID"), F.col("role").alias("Category"), F.col("text").alias("Text"),
        F.col("conv_id").alias("_number"),
    )
    talks = _in_files(turns, "_number", "turns-csv", **CSV)
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("resume_id"), F.col("text").alias("resume_text"))
    sources = [readers.load_table(t, redact=False) for t in (spark.read.parquet(*files), items, items)]
    sources.insert(1, readers.load_csv(spark, talks, redact=False))
    return readers.union_sources(sources).select(
        F.shiftright("pos", 48).cast("int").alias("source"), (F.col("pos") % (1 << 48)).alias("place"), "id", "category", "text"
    ).withColumn("place", F.when(F.col("source") != 1, F.col("place")))


# Turns of one conversation can come in any order within their file, so only the others' places are checked.
UNION_SOURCES = f"""
SELECT source, place, id, category, {sql_clean('text')} AS text FROM (
    SELECT 0 AS source, {FILE_PLACE} AS place, CAST(doc_id AS VARCHAR) AS id, lang AS category, text FROM documents
    UNION ALL SELECT 1, NULL, conv_id || '-' || turn, role, text FROM conversations
    UNION ALL SELECT 2, row_number() OVER (ORDER BY item_id) - 1, CAST(item_id AS VARCHAR), '', text FROM benchmark
    UNION ALL SELECT 3, row_number() OVER (ORDER BY item_id) - 1, CAST(item_id AS VARCHAR), '', text FROM benchmark)"""


def jd_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Job descriptions read from files, one each."""
    files = fx.jobs(spark, sf).select(
        F.concat(F.lit("opening_"), "jd_id", F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content")
    )
    return readers.load_jobs(spark, _write_files(files, "openings"))


JD_SCAN = with_fixtures("SELECT 'opening_' || jd_id AS jd_id, text FROM prof")


def labels_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels-csv")
    table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).write.csv(path, header=True)
    return readers.load_labels(spark, path).select("id", "label")


LABELS_SCAN = "SELECT CAST(doc_id AS VARCHAR) AS id, quality AS label FROM labels"


def labels_append(spark: SparkSession, sf: str) -> DataFrame:
    """The two label columns appended one after the other to one store."""
    path = scratch_path(spark, "label-store")
    stored = table(spark, sf, "labels")
    sinks.append_labels(stored.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")), path)
    sinks.append_labels(stored.select(F.concat(F.lit("t"), "doc_id").alias("id"), F.col("toxic").alias("label")), path)
    return readers.load_labels(spark, path).select("id", "label")


LABELS_APPEND = """
SELECT CAST(doc_id AS VARCHAR) AS id, quality AS label FROM labels
UNION ALL SELECT 't' || doc_id, toxic FROM labels"""


def labels_latest(spark: SparkSession, sf: str) -> DataFrame:
    """All ids labelled once, every third one again and some of these a third time: what holds in the end."""
    path = scratch_path(spark, "label-log")
    stored = table(spark, sf, "labels")
    numbers = [
        sinks.append_labels(stored.where(F.col("doc_id") % every == 0).select(F.col("doc_id").alias("id"), label.alias("label")), path)
        for every, label in ((1, F.col("quality")), (3, F.col("toxic")), (6, F.lit(7)))
    ]
    return readers.latest_labels(readers.load_labels(spark, path)).withColumn("batches", F.lit(numbers[-1]).cast("long"))


LABELS_LATEST = """
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 6 = 0 THEN 7 WHEN doc_id % 3 = 0 THEN toxic ELSE quality END AS label,
       3 AS batches
FROM labels"""


# ---- cleaning and redaction -----------------------------------------------------------------


def _documents_with(spark: SparkSession, sf: str, **columns) -> DataFrame:
    return fx.documents(spark, sf).select("doc_id", *(c.alias(n) for n, c in columns.items()))


def clean_text(spark, sf):
    return _documents_with(spark, sf, text=text.clean_text(F.col("text")))


def redact_email(spark, sf):
    return _documents_with(spark, sf, text=text.redact_email(F.col("text")))


def redact_phone(spark, sf):
    return _documents_with(spark, sf, text=text.redact_phone(F.col("text")))


def redact_url(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        text.redact_url(F.concat(F.lit("see "), F.col("url"), F.lit(" for more"))).alias("line"),
        text.redact_url(F.col("html")).alias("html"),
    )


REDACT_URL = f"""
SELECT page_id, {sql_url("'see ' || url || ' for more'")} AS line, {sql_url('html')} AS html FROM pages"""


def redact_pii(spark, sf):
    """Documents, with a link and a phone number put into the first line of each."""
    line = F.concat(
        F.lit("mail: a.b+c@x-y.example, http://x.example/"), "doc_id", F.lit(" or (+91) 98765-43210 since 2019 - 2022\n"), "text"
    )
    return text.redact_pii(_documents_with(spark, sf, text=line))


REDACT_PII = f"""
SELECT doc_id, {sql_pii("line")} AS text FROM (
    SELECT doc_id, 'mail: a.b+c@x-y.example, http://x.example/' || doc_id || ' or (+91) 98765-43210 since 2019 - 2022'
        || chr(10) || text AS line FROM documents)"""


def norm_quotes(spark, sf):
    return _documents_with(spark, sf, text=text.norm_quotes(F.concat(F.lit("‘it’s’ "), F.col("text"))))


NORM_QUOTES = """
SELECT doc_id, replace(replace(chr(8216) || 'it' || chr(8217) || 's' || chr(8217) || ' ' || text, chr(8217), ''''), chr(8216), '''') AS text
FROM documents"""


def text_preview(spark, sf):
    body = F.col("text")
    return _documents_with(spark, sf, first=text.text_preview(body), second=text.text_preview(body, 1500, 1500))


TEXT_PREVIEW = f"""
SELECT doc_id, trim(regexp_replace(substr(text, 1, 1500), '[{S}]+', ' ', 'g')) AS first,
    trim(regexp_replace(substr(text, 1501, 1500), '[{S}]+', ' ', 'g')) AS second FROM documents"""


# ---- features -------------------------------------------------------------------------------


def _candidates_with(spark, sf, **columns) -> DataFrame:
    return fx.candidates(spark, sf).select("id", *(c.alias(n) for n, c in columns.items()))


def extract_skills(spark, sf):
    return _candidates_with(spark, sf, skills=F.array_join(features.extract_skills(F.col("text")), ","))


def extract_skills_by_table(spark, sf):
    """The same skills, with the vocabulary as a table of terms."""
    terms = spark.createDataFrame(list(DEFAULT_VOCABULARY.skill_of.items()), "term string, skill string")
    found = vocabulary_join.skills_by_table(fx.candidates(spark, sf), terms)
    return found.select(F.col("pos").cast("string").alias("id"), F.array_join("skills", ",").alias("skills"))


def skill_category_rollup(spark, sf):
    rows = fx.candidates(spark, sf).select(features.extract_skills(F.col("text")).alias("skills"))
    return insights.skill_category_rollup(rows)


SKILL_CATEGORY_ROLLUP = with_fixtures(
    "SELECT category, count(*) AS mentions, count(DISTINCT pos) AS documents FROM skill_of JOIN vocab USING (skill) GROUP BY category"
)


def explicit_years(spark, sf):
    return _candidates_with(spark, sf, years=features.explicit_years(F.col("text")))


def _span_text(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")


def year_spans(spark, sf):
    return _candidates_with(spark, sf, spans=_span_text(features.year_spans(F.col("text"), YEAR)))


YEAR_SPANS = with_fixtures("SELECT CAST(doc_id AS VARCHAR) AS id, concat_ws(',', school_spans, spans) AS spans FROM numbered")


def education_context_filter(spark, sf):
    kept = F.filter(features.year_spans(F.col("text"), YEAR), lambda x: ~x["schooling"])
    return _candidates_with(spark, sf, spans=_span_text(kept))


EDUCATION_CONTEXT = with_fixtures("SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(work_spans, '') AS spans FROM numbered")


def span_validity_filter(spark, sf):
    """Each candidate once more against an earlier year, which turns later spans into future ones."""
    return _candidates_with(spark, sf, spans=_span_text(features.work_spans(F.col("text"), fx.EARLIER_YEAR)))


SPAN_VALIDITY = with_fixtures("SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(earlier_spans, '') AS spans FROM numbered")


def merge_intervals(spark, sf):
    return _candidates_with(
        spark, sf, years=features.merged_length(features.work_spans(F.col("text"), YEAR)).cast("double")
    )


MERGE_INTERVALS = with_fixtures("SELECT CAST(doc_id AS VARCHAR) AS id, CAST(covered AS DOUBLE) AS years FROM numbered")


def experience_years(spark, sf):
    return _candidates_with(spark, sf, years=features.experience_years(F.col("text"), YEAR))


def education_levels(spark, sf):
    return _candidates_with(spark, sf, levels=F.array_join(features.education_levels(F.col("text")).cast("array<string>"), ","))


def education_level(spark, sf):
    return _candidates_with(spark, sf, level=features.education_level(F.col("text")))


def education_label(spark, sf):
    return _candidates_with(spark, sf, label=features.education_label(features.education_level(F.col("text"))))


def build_features(spark, sf):
    return features.build_features(fx.candidates(spark, sf), YEAR).select(
        "id", "category", F.array_join("skills", ",").alias("skills"), "experience_years", "education_level"
    )


# ---- job descriptions -----------------------------------------------------------------------


def jd_split_optional(spark, sf):
    parts = job_ops.split_optional(fx.jobs(spark, sf))
    return parts.select(
        "jd_id", text.strip(F.col("required_text")).alias("required_text"), text.strip(F.col("optional_text")).alias("optional_text")
    )


JD_SPLIT = with_fixtures("""
SELECT jd_id, trim(required_text, ' ' || chr(10)) AS required_text, coalesce(trim(optional_text, ' ' || chr(10)), '') AS optional_text
FROM prof""")


def _profiles(spark, sf):
    return job_ops.parse_job_descriptions(fx.jobs(spark, sf))


def jd_required_skills(spark, sf):
    return _profiles(spark, sf).select("jd_id", F.array_join("required", ",").alias("required"))


def jd_nice_skills(spark, sf):
    return _profiles(spark, sf).select("jd_id", F.array_join("nice", ",").alias("nice"))


def jd_min_years(spark, sf):
    return _profiles(spark, sf).select("jd_id", "min_years")


def jd_min_education(spark, sf):
    return _profiles(spark, sf).select("jd_id", "min_education")


def parse_job_description(spark, sf):
    return _profiles(spark, sf).select(
        "jd_id", F.array_join("required", ",").alias("required"), F.array_join("nice", ",").alias("nice"),
        "min_years", "min_education",
    )


# ---- terms and chunks -----------------------------------------------------------------------


def tokenize_ngrams(spark, sf):
    grams = terms.add_ngrams(fx.documents(spark, sf), terms.default_stop_words())
    return grams.select("doc_id", F.size("grams").cast("bigint").alias("n_grams"), F.md5(F.array_join("grams", "|")).alias("digest"))


TOKENIZE_NGRAMS = f"""
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_grams, md5(array_to_string(g, '|')) AS digest FROM (
    SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM (SELECT doc_id, {sql_grams('text')} AS w FROM documents))"""


def chunk_words(spark, sf):
    return terms.chunk_words(fx.documents(spark, sf).select("doc_id", "text"))


CHUNK_WORDS = f"""
SELECT doc_id, CAST(c AS INTEGER) AS chunk_no, array_to_string(w[c * 200 + 1 : c * 200 + 200], ' ') AS chunk FROM (
    SELECT doc_id, w, unnest(range(0, greatest((len(w) + 199) // 200, 1))) AS c FROM (
        SELECT doc_id, regexp_extract_all(text, '[^{S}]+') AS w FROM documents))"""


def _expected(columns: str) -> str:
    return with_fixtures(f"SELECT id, {columns} FROM cand")


QUERIES = {
    "csv_scan": (csv_scan, CSV_SCAN),
    "csv_scan_split": (csv_scan_split, CSV_SCAN),
    "resolve_columns": (resolve_columns, RESOLVE_COLUMNS),
    "folder_scan_txt": (folder_scan_txt, FOLDER_SCAN),
    "union_sources": (union_sources, UNION_SOURCES),
    "jd_scan": (jd_scan, JD_SCAN),
    "labels_scan": (labels_scan, LABELS_SCAN),
    "labels_latest": (labels_latest, LABELS_LATEST),
    "labels_append": (labels_append, LABELS_APPEND),
    "clean_text": (clean_text, f"SELECT doc_id, {sql_clean('text')} AS text FROM documents"),
    "redact_email": (redact_email, f"SELECT doc_id, {sql_email('text')} AS text FROM documents"),
    "redact_url": (redact_url, REDACT_URL),
    "redact_phone": (redact_phone, f"SELECT doc_id, {sql_phone('text')} AS text FROM documents"),
    "redact_pii": (redact_pii, REDACT_PII),
    "norm_quotes": (norm_quotes, NORM_QUOTES),
    "text_preview": (text_preview, TEXT_PREVIEW),
    "extract_skills": (extract_skills, _expected("array_to_string(skills, ',') AS skills")),
    "extract_skills_by_table": (extract_skills_by_table, _expected("array_to_string(skills, ',') AS skills")),
    "skill_category_rollup": (skill_category_rollup, SKILL_CATEGORY_ROLLUP),
    "explicit_years": (explicit_years, _expected("stated_years AS years")),
    "year_spans": (year_spans, YEAR_SPANS),
    "education_context_filter": (education_context_filter, EDUCATION_CONTEXT),
    "span_validity_filter": (span_validity_filter, SPAN_VALIDITY),
    "merge_intervals": (merge_intervals, MERGE_INTERVALS),
    "experience_years": (experience_years, _expected("experience_years AS years")),
    "education_levels": (education_levels, _expected("array_to_string(levels, ',') AS levels")),
    "education_level": (education_level, _expected("education_level AS level")),
    "education_label": (
        education_label,
        _expected("['Not stated', 'Diploma', 'Bachelor''s', 'Master''s', 'PhD'][education_level + 1] AS label"),
    ),
    "build_features": (
        build_features,
        _expected("category, array_to_string(skills, ',') AS skills, experience_years, education_level"),
    ),
    "jd_split_optional": (jd_split_optional, JD_SPLIT),
    "jd_required_skills": (
        jd_required_skills, with_fixtures("SELECT jd_id, array_to_string(required, ',') AS required FROM prof")
    ),
    "jd_nice_skills": (jd_nice_skills, with_fixtures("SELECT jd_id, array_to_string(nice, ',') AS nice FROM prof")),
    "jd_min_years": (jd_min_years, with_fixtures("SELECT jd_id, min_years FROM prof")),
    "jd_min_education": (jd_min_education, with_fixtures("SELECT jd_id, min_education FROM prof")),
    "parse_job_description": (
        parse_job_description,
        with_fixtures(
            "SELECT jd_id, array_to_string(required, ',') AS required, array_to_string(nice, ',') AS nice, "
            "min_years, min_education FROM prof"
        ),
    ),
    "tokenize_ngrams": (tokenize_ngrams, TOKENIZE_NGRAMS),
    "chunk_words": (chunk_words, CHUNK_WORDS),
}
