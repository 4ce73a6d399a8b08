"""Row numbers and running totals over groups of any size.

``row_number()`` over a whole group sorts that group in one task, and in a screening one job can own
all rows. Here the rows are range-partitioned by group and sort key, so that tasks hold equal shares
whatever the groups are; a table with one row per task and group then says what each task starts from.
That table is stored and counted; up to a bound it is broadcast, and the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import is_small, materialize

# monotonically_increasing_id(): partition number above, row number in the partition below.
_ROW_BITS = 33

# Offsets are a few numbers and a key or path: so many rows take some 20 MB.
BROADCAST_OFFSETS = 100_000


def _numbered(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` with the partition and the place in it of every row."""
    stored = materialize(df.withColumn("_at", F.monotonically_increasing_id()), label)
    return stored.withColumns(
        {
            "_part": F.shiftright("_at", _ROW_BITS),
            "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """``df`` stored in range order. Store it before if it is dear to compute: the ranges take a pass of their own."""
    keys = [F.col(c).asc() for c in by] + list(order)
    return _numbered(df.repartitionByRange(*keys).sortWithinPartitions(*keys), label)


def _offsets(rows: DataFrame, by: Sequence[str], amount: Column) -> DataFrame:
    """Per partition and group: its first row, and the total of all earlier partitions of the group.

    The input of this window has one row per partition and group, never one per data row.
    """
    parts = rows.groupBy(*by, "_part").agg(F.min("_row").alias("_first"), amount.alias("_amount"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(
        parts.select(*by, "_part", "_first", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_before")), "offsets"
    )


def _with_offsets(rows: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join each row with its partition's offset; groups of one partition differ by key, so there is no hot one to split."""
    return rows.join(F.broadcast(starts) if is_small(starts, BROADCAST_OFFSETS) else starts, list(keys))


def _places(df: DataFrame) -> DataFrame:
    """``df`` with the file and split of every row, where it is read from files, and its place among them.

    Spark packs splits into tasks by size, so numbers that follow tasks do not follow files.
    """
    at = F.monotonically_increasing_id().alias("_at")
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), at)
    except AnalysisException:
        # Not read from files: the partitions are in order.
        return df.select("*", F.lit("").alias("_file"), at).withColumn("_block", F.shiftright("_at", _ROW_BITS))


def row_ordinals(df: DataFrame, name: str = "pos") -> DataFrame:
    """Number the rows 0, 1, 2, ... file by file in order of their paths, and as they stand in each.

    Takes one pass that counts rows per split. No row is moved or stored.
    """
    parts = _places(df).groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_amount"))
    # One row per split of a file.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_amount").over(earlier), F.lit(0))
    starts = materialize(parts.select("_file", "_block", "_first", before.alias("_before")), "splits")
    return _with_offsets(_places(df), starts, ["_file", "_block"]).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(name)
    )


def rank_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number the rows of every group 1, 2, 3, ... in the given order.

    End ``order`` with a unique column, both to make the numbers definite and to let ties be split.
    """
    rows = _ranged(df, by, order, "ranked")
    starts = _offsets(rows, by, F.count(F.lit(1)))
    number = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return _with_offsets(rows, starts, [*by, "_part"]).select(number.alias(name), *df.columns)


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, the row itself left out."""
    rows = _ranged(df, by, order, "totals")
    starts = _offsets(rows, by, F.sum(value))
    nearby = Window.partitionBy(*by, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("_within", F.coalesce(F.sum(value).over(nearby), F.lit(0)))
    return _with_offsets(within, starts, [*by, "_part"]).select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def _cut(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Of every group the first ``n`` rows of each task, found without moving a row.

    The rows are sorted and stored where they are; then a row's place in its group and task is its number less
    that of the group's first row.
    """
    keys = [F.col(c).asc() for c in by]
    rows = _numbered(df.sortWithinPartitions(*keys, *order), "cut")
    starts = materialize(rows.groupBy(*by, "_part").agg(F.min("_row").alias("_first")), "cut-starts")
    return _with_offsets(rows, starts, [*by, "_part"]).where(F.col("_row") - F.col("_first") < n).select(*df.columns)


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "_place") -> DataFrame:
    """The first ``n`` rows of every group, numbered from 1.

    Every task cuts its share of a group down to ``n`` rows before the shuffle, so the size of a group does not
    matter. Spark does so by itself up to a limit in its settings; beyond that the rows are cut here first.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    cut = df if n <= limit else _cut(df, by, order, n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return cut.withColumn(name, place).where(F.col(name) <= n)
