"""Writing rankings, documents and labels."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def without_contributions(ranked: DataFrame) -> DataFrame:
    return ranked.drop(*(c for c in ranked.columns if c.startswith("contrib_")))


def write_ranking(ranked: DataFrame, path: str, fmt: str = "csv", files: int | None = None) -> None:
    """The full ranking without its ``contrib_*`` columns, as CSV or any other Spark format, in order of job and rank.

    A stored ranking is read back in splits that are packed by size, so writing what is read loses the order. Here rows go to
    ranges of (job, rank), each sorted and written as one file; Spark numbers files by range, so that the files, read in
    order of their names, are the ranking. ``files`` asks for so many of them; by default the shuffle settings decide.
    """
    by = [F.col("jd_id"), F.col("rank")]
    rows = without_contributions(ranked)
    dealt = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    writer = dealt.sortWithinPartitions(*by).write.mode("overwrite")
    if fmt == "csv":
        # Text holds quotes and line breaks; escape as readers of plain CSV expect.
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.format(fmt).save(path)


STORE_ROW_GROUP = 4 << 20


def write_documents(documents: DataFrame, path: str, files: int | None = None, row_group: int = STORE_ROW_GROUP) -> None:
    """A store of documents for lookups by ``id``, to be read with ``spark.read.parquet``.

    Each file holds a range of ids in order, in small row groups with a Bloom filter of their ids. A lookup of some ids
    (``insights.lookup_by_id``) leaves out files and row groups by their least and largest id and by the filters, and reads
    texts of the few that are left. Rows of one id are dealt by a hash too, so that an id that many rows share splits.
    """
    hashed = [F.col(f"`{c}`") for c, kind in documents.dtypes if "map<" not in kind and kind != "variant"]
    by = [F.col("id"), F.xxhash64(*hashed)]
    dealt = documents.repartitionByRange(files, *by) if files else documents.repartitionByRange(*by)
    (
        dealt.sortWithinPartitions("id").write.mode("overwrite")
        .option("parquet.block.size", row_group)
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def append_labels(labels: DataFrame, path: str) -> int:
    """Add labels to the store as a batch of their own, and return its number. Only the new rows are written.

    The rows are written to a folder that readers do not see. Then the batch claims the next number, by creating a file that
    must not be there yet, and the folder takes its place under that number in one renaming. So the order of labels is that
    of the batches, whatever the clocks say, an append that fails half-way leaves nothing to be read, and of two
    appends at a time each gets its own number. (A store without atomic renaming shows a batch while it is moved.)
    """
    spark = labels.sparkSession
    if has_plain_labels(spark, path):
        raise ValueError(f"{path} holds labels without batches: load them and append them to a new store")
    rows = labels.select(F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"))
    pending = f"{path}/_pending-{uuid.uuid4().hex}"
    rows.write.csv(pending, header=True)
    files, place = _hadoop(spark, path)
    files.mkdirs(place(f"{path}/{LABEL_LOG}"))
    number = max((int(f.getPath().getName()) for f in files.listStatus(place(f"{path}/{LABEL_LOG}"))), default=0) + 1
    while not _claimed(files, place(f"{path}/{LABEL_LOG}/{number:012d}")):
        number += 1
    if not files.rename(place(pending), place(f"{path}/batch={number:012d}")):
        raise OSError(f"batch {number} of {path} could not be put in place")
    return number


LABEL_LOG = "_batches"


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path``, and what makes paths for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _claimed(files, place) -> bool:
    try:
        files.create(place, False).close()
        return True
    except Py4JJavaError as e:
        if files.exists(place):
            return False
        raise e


def has_batches(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place(f"{path}/{LABEL_LOG}"))


def has_plain_labels(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    if not files.exists(place(path)):
        return False
    return any(f.isFile() and not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(place(path)))
