"""Documents, job descriptions and labels from files or tables.

Loaded documents have ``pos bigint, id string, category string, text string``; ``pos`` is unique and follows
input order: files by path, rows as they stand in them. Spark's reader gives a CSV file with line breaks inside fields
to one task; ``load_large_csv`` splits such files, and ``multi_line=False`` those without line breaks.
"""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text, redact_pii
from ..operators.ordering import rank_rows, row_ordinals
from ..runtime import materialize, spread
from .sinks import has_batches
from .split_csv import read_split_csv

# ---- fixed values: column names recognised, the first one present wins -----------------------
TEXT_COLUMNS = ("Resume_str", "resume_str", "resume_text", "Resume", "resume", "text", "Text")
ID_COLUMNS = ("ID", "id", "Id", "resume_id")
CATEGORY_COLUMNS = ("Category", "category")

TEXT_FILES = ("*.[tT][xX][tT]",)
# Documents in these formats count as candidates too, but nothing here decodes them.
UNREAD_FILES = ("*.[pP][dD][fF]", "*.[dD][oO][cC][xX]")

# Names listed at a time, and bytes of contents held at a time; larger files come one by one.
_LISTED, _HELD = 10_000, 8 << 20

# Sources below each other: the number of the source above, the position in it below.
_SOURCE_BITS = 48


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV with a header and quoted fields; every column is text. Without ``multi_line`` files are split among tasks."""
    return spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8")


def _present(columns: Sequence[str], known: Sequence[str]) -> str | None:
    return next((name for name in known if name in columns), None)


def resolve_columns(raw: DataFrame, numbered_by: str | None = None) -> DataFrame:
    """``(pos, id, category, text)`` out of a table with any of the known column names.

    A missing id becomes the row number and a missing category is empty. Without a text column there
    is nothing to load. Rows are numbered here unless ``numbered_by`` names the column that does.
    """
    text, key, category = (
        _present(raw.columns, known) for known in (TEXT_COLUMNS, ID_COLUMNS, CATEGORY_COLUMNS)
    )
    if text is None:
        raise ValueError(f"no text column: expected one of {list(TEXT_COLUMNS)}, found {raw.columns}")
    rows = raw.select(
        *([F.col(f"`{numbered_by}`").alias("pos")] if numbered_by else []),
        *([F.col(f"`{key}`").cast("string").alias("id")] if key else []),
        (F.col(f"`{category}`") if category else F.lit("")).cast("string").alias("category"),
        F.col(f"`{text}`").alias("text"),
    )
    numbered = rows if numbered_by else row_ordinals(rows)
    made_up = F.col("pos").cast("string").alias("id")
    return numbered.select("pos", "id" if key else made_up, "category", "text")


def prepare_text(documents: DataFrame, redact: bool = True) -> DataFrame:
    """Clean and, unless told otherwise, redact the text; missing text becomes empty."""
    cleaned = documents.withColumn("text", clean_text(F.coalesce("text", F.lit(""))))
    return redact_pii(cleaned) if redact else cleaned


def load_table(raw: DataFrame, redact: bool = True) -> DataFrame:
    return prepare_text(resolve_columns(raw), redact)


def load_csv(spark: SparkSession, path: str | list[str], redact: bool = True, multi_line: bool = True) -> DataFrame:
    return load_table(read_csv(spark, path, multi_line), redact)


def load_large_csv(spark: SparkSession, path: str | list[str], redact: bool = True) -> DataFrame:
    """:func:`load_csv` for large files whose fields may hold line breaks: they are split among tasks all the same."""
    return prepare_text(resolve_columns(read_split_csv(spark, path), "pos"), redact)


def _local_folder(spark: SparkSession, folder: str) -> str | None:
    """``file:`` and the full path, if ``folder`` is a folder on disk; None for a file, a pattern or any other store."""
    if re.search(r"[*?\[\]{}\\]", folder):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    full = store.makeQualified(path)
    return f"file:{full.toUri().getPath()}" if full.toUri().getScheme() == "file" and store.isDirectory(full) else None


def _listed(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """``(path, place)`` of the files directly in a folder on disk whose name matches, as a task walks over them.

    Nothing holds all names: Spark's reader keeps an entry for every file on the driver, of whatever name. Like there,
    empty files and names that begin with a dot or an underscore are left out, and ``place``, the name as in a link, gives the order.
    """
    wanted = re.compile("|".join(map(fnmatch.translate, names)))
    hidden = re.compile(r"\.|_[^=]*$|.*\._COPYING_$", re.DOTALL)
    base = folder.rstrip("/") + "/"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found: list[str]) -> pa.RecordBatch:
            place = [re.sub(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]', lambda m: f"%{ord(m[0]):02X}", name) for name in found]
            return pa.RecordBatch.from_pydict({"path": pa.array([base + n for n in found], pa.string()), "place": pa.array(place, pa.string())})

        for _ in batches:
            found: list[str] = []
            with os.scandir(base.removeprefix("file:")) as files:
                for file in files:
                    if wanted.match(file.name) and not hidden.match(file.name) and file.is_file() and file.stat().st_size:
                        found.append(file.name)
                        if len(found) == _LISTED:
                            yield packed(found)
                            found = []
            yield packed(found)

    return spark.range(0, 1, 1, 1).mapInArrow(walk, "path string, place string")


def _with_contents(files: DataFrame) -> DataFrame:
    """``files`` on disk with the ``content`` at each ``path``, read by the tasks that the paths are dealt to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch: pa.RecordBatch, begin: int, found: list[bytes]) -> pa.RecordBatch:
            held = batch.slice(begin, len(found))
            return pa.RecordBatch.from_arrays([*held.columns, pa.array(found, pa.binary())], names=[*held.schema.names, "content"])

        for batch in batches:
            begin, found, size = 0, [], 0
            for path in batch.column("path").to_pylist():
                with open(path.removeprefix("file:"), "rb") as file:
                    found.append(file.read())
                size += len(found[-1])
                if size >= _HELD:
                    yield packed(batch, begin, found)
                    begin, found, size = begin + len(found), [], 0
            yield packed(batch, begin, found)

    return spread(files, "path").mapInArrow(read, ", ".join(f"{c} {kind}" for c, kind in files.dtypes) + ", content binary")


def _by_spark(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    files = spark.read.format("binaryFile").options(recursiveFileLookup="false", pathGlobFilter="{" + ",".join(names) + "}")
    return files.load(folder).select("path", "content")


def read_files(spark: SparkSession, folder: str, names: Sequence[str] = TEXT_FILES) -> DataFrame:
    """``(path, content)`` of the files directly in ``folder`` whose name matches; other files are not opened.

    Files of a folder on disk are listed and read by tasks. Spark's reader serves other stores, and lists them on the driver.
    """
    local = _local_folder(spark, folder)
    return _with_contents(_listed(spark, local, names).select("path")) if local else _by_spark(spark, folder, names)


def _numbered_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(pos, path, content)`` of the text files in ``folder``, in order of their paths. Numbering moves paths only."""
    local = _local_folder(spark, folder)
    if not local:
        return row_ordinals(_by_spark(spark, folder, TEXT_FILES))
    ranked = rank_rows(materialize(_listed(spark, local, TEXT_FILES), "listed"), [], [F.col("place")])
    return _with_contents(ranked.select((F.col("rank") - 1).cast("long").alias("pos"), "path"))


def _no_unread(spark: SparkSession, folder: str) -> None:
    local = _local_folder(spark, folder)
    unread = (_listed(spark, local, UNREAD_FILES) if local else _by_spark(spark, folder, UNREAD_FILES)).select("path")
    some = [r.path for r in unread.orderBy("path").limit(3).collect()]
    if some:
        raise ValueError(f"{unread.count()} files in {folder} are in formats that are not decoded, such as {some}")


def decode_utf8(content: Column) -> Column:
    """UTF-8 with invalid bytes dropped. A replacement character that was really there goes as well."""
    return F.translate(F.make_valid_utf8(content.cast("string")), "\ufffd", "")


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def text_files(files: DataFrame) -> DataFrame:
    """``(id, category, text)`` and ``pos``, if there is one, of ``(path, content)``; the id is the name's stem."""
    return files.select(
        *(c for c in files.columns if c == "pos"),
        file_stem(F.col("path")).alias("id"), F.lit("").alias("category"), decode_utf8(F.col("content")).alias("text"),
    )


def load_folder(spark: SparkSession, folder: str, redact: bool = True) -> DataFrame:
    """Documents out of the text files in a folder, in order of their paths. Numbering reads paths only.

    Files that would be documents but cannot be decoded are an error, not left out.
    """
    _no_unread(spark, folder)
    return prepare_text(text_files(_numbered_files(spark, folder)).select("pos", "id", "category", "text"), redact)


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources below each other, duplicates included; positions follow that order."""
    rows = (
        s.select((F.lit(i << _SOURCE_BITS) + F.col("pos")).alias("pos"), "id", "category", "text") for i, s in enumerate(sources)
    )
    return reduce(DataFrame.unionByName, rows)


def jobs_from_files(files: DataFrame) -> DataFrame:
    """``(jd_id, text)`` out of ``(path, content)``: one job per text file, its text untouched."""
    return text_files(files).select(F.col("id").alias("jd_id"), "text")


def load_jobs(spark: SparkSession, path: str) -> DataFrame:
    return jobs_from_files(read_files(spark, path))


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels ``(id, label, pos)`` from CSV; ids stay text, so leading zeros survive.

    ``pos`` is the label's place: by batches in a store that :func:`append_labels` made, by the time that files were written
    in any other folder, and rows as they stand.
    """
    if has_batches(spark, path):
        rows = spark.read.csv(path, header=True, schema="id string, label int, batch long")
        first = F.col("batch")
    else:
        rows = spark.read.csv(path, header=True, schema="id string, label int")
        first = F.col("_metadata.file_modification_time")
    written = F.struct(first.alias("written"), "_metadata.file_path", "_metadata.file_block_start")
    return rows.select("id", "label", F.struct(written, F.monotonically_increasing_id()).alias("pos"))


def latest_labels(labels: DataFrame) -> DataFrame:
    """``(id, label)``: of the labels of an id (:func:`load_labels`) the one given last."""
    return labels.groupBy("id").agg(F.max_by("label", "pos").alias("label"))
