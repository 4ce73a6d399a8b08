"""CSV files with line breaks inside fields, read by many tasks.

A reader of such a file cannot begin in its middle: whether a line break ends a record depends on the quotes before it.
What a split needs to know is only whether their number is odd. So lines are read in splits, each split counts its quotes and,
for either case, the records that begin in it; one row per split then says what each split begins with and how many
records come before. Lines of one record are put together where they are read; the few records that splits cut through
are put together afterwards. Records are parsed with the CSV expressions of Spark.

The rule holds for fields quoted with ``"`` and quotes in them doubled. A lone quote inside a field without quotes would
turn everything after it inside out, so a file with an odd number of quotes is an error. Blank lines between records
are left out, as the CSV reader does, and a carriage return before a line break is part of the break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.ordering import BROADCAST_OFFSETS
from ..runtime import is_small, materialize

OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(_file, _block, _at, line, _quotes)``: lines in their splits, and the quotes up to the end of the line within the split.

    Dealing lines by split moves them once, in portions as large as a split.
    """
    raw = spark.read.text(path, lineSep="\n")
    lines = raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.when(F.endswith(F.col("value"), F.lit("\r")), F.substr("value", F.lit(1), F.char_length("value") - 1)).otherwise(F.col("value")).alias("line"),
    )
    quotes = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    before = Window.partitionBy(*SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lines.withColumn("_own", quotes.cast("long"))
    return counted.withColumn("_quotes", F.sum("_own").over(before))


def _blank() -> Column:
    return F.col("line") == ""


def _begins(entered: Column) -> Column:
    """Whether a record begins with the line, if the split is entered with so many open quotes."""
    return ((entered + F.col("_quotes") - F.col("_own")) % 2 == 0) & ~_blank()


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: open quotes and records before it in its file, and rows before the file (its header left out)."""
    per_split = lines.groupBy(*SPLIT).agg(
        F.sum("_own").alias("_quotes"),
        *[F.count(F.when(_begins(F.lit(k)), F.lit(1))).alias(f"_records{k}") for k in (0, 1)],
    )
    counts = materialize(per_split, "csv-splits")
    # One row per split.
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entered = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2
    chosen = counts.withColumn("_open", entered).withColumn("_own_records", F.when(F.col("_open") == 0, F.col("_records0")).otherwise(F.col("_records1")))
    placed = chosen.withColumn("_before", F.coalesce(F.sum("_own_records").over(earlier), F.lit(0)))
    files = placed.groupBy("_file").agg(F.sum("_own_records").alias("_n"), F.sum("_quotes").alias("_total"))
    broken = [r["_file"] for r in files.where("_total % 2 = 1").orderBy("_file").limit(3).collect()]
    if broken:
        raise ValueError(f"odd number of quotes in {broken}: fields must be quoted and quotes in them doubled")
    # One row per file.
    above = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    rows = files.select("_file", F.coalesce(F.sum(F.greatest(F.col("_n") - 1, F.lit(0))).over(above), F.lit(0)).alias("_rows"))
    return materialize(placed.join(rows, "_file").select(*SPLIT, "_open", "_before", "_rows"), "csv-offsets")


def _joined(lines: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(lines)), lambda x: x["line"]), "\n")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(pos, record)``: the text of every record but the header of each file; ``pos`` counts them file by file from 0."""
    lines = _lines(spark, path)
    starts = _splits(lines)
    placed = lines.join(F.broadcast(starts) if is_small(starts, BROADCAST_OFFSETS) else starts, SPLIT)
    begins = _begins(F.col("_open"))
    within = Window.partitionBy(*SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.col("_open") + F.col("_quotes") - F.col("_own")) % 2 == 1
    numbered = placed.where(begins | inside | ~_blank()).withColumns(
        {"_no": F.col("_before") + F.sum(F.when(begins, F.lit(1)).otherwise(F.lit(0))).over(within), "_ends": F.col("_open") + F.col("_quotes")}
    )
    # Grouped within the splits, where the lines already are.
    parts = numbered.groupBy(*SPLIT, "_no").agg(
        _joined(F.struct("_at", "line")).alias("line"), F.min("_at").alias("_at"), F.first("_rows").alias("_rows"),
        F.max(F.when(begins, F.lit(1)).otherwise(F.lit(0))).alias("_whole_begin"),
        F.max_by("_ends", "_at").alias("_ends"),
    )
    whole = (F.col("_whole_begin") == 1) & (F.col("_ends") % 2 == 0)
    # At most two parts of a split are cut off.
    cut = parts.where(~whole).groupBy("_file", "_no", "_rows").agg(_joined(F.struct("_block", "line")).alias("line"))
    records = parts.where(whole).select("_file", "_no", "_rows", "line").unionByName(cut)
    return records.where("_no > 1").select((F.col("_rows") + F.col("_no") - 2).alias("pos"), F.col("line").alias("record"))


def read_split_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The columns named by the header, all text, after ``pos``, the row's number in order of files and records."""
    names = spark.read.csv(path, header=True, quote='"', escape='"', encoding="UTF-8").columns
    kind = StructType()
    for k in range(len(names)):
        kind.add(f"c{k}", StringType())
    parsed = F.from_csv("record", F.lit(kind.simpleString()[7:-1].replace(":", " ")), OPTIONS)
    rows = read_records(spark, path).select("pos", parsed.alias("r"))
    return rows.select("pos", *[F.col(f"r.c{k}").alias(name) for k, name in enumerate(names)])
