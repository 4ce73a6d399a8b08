"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Deleting these characters, or splitting at them, is what the operators mean by white space.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


# The table of the byte-wise CRC-32, made by its rule, as a DuckDB query with the one column ``t``.
CRC_TABLE_SQL = (
    "SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    " ORDER BY n) AS t FROM (SELECT unnest(range(256)) AS n)"
)


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of the UTF-8 bytes of ``text``, where the column ``t`` is in reach."""
    bytes_of = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2] AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {bytes_of}, lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores put before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def grown(x: np.ndarray, used: int, need: int) -> np.ndarray:
    """``x`` with room for ``need`` entries. What is not used yet is never written, so it takes no memory."""
    if need <= len(x):
        return x
    larger = np.zeros((max(need, 2 * len(x)), *x.shape[1:]), x.dtype)
    larger[:used] = x[:used]
    return larger
