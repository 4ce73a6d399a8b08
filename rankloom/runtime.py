"""Session, scratch tables and size-checked joins shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One row per job is broadcast only up to this many jobs; see attach().
BROADCAST_ROWS = 5_000
# Rows of unknown width are broadcast only if their bytes stay below this too.
BROADCAST_BYTES = 64 << 20
SALTS = 64
# Rows of costly work that a task may hold, those that it gets when rows are dealt anew, and the most tasks for that; see spread().
MOST_ROWS, DEALT_ROWS, MOST_TASKS = 5_000, 2_500, 10_000


def build_session(app: str = "rankloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on. Cluster settings are left alone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: whatever ``spark.checkpoint.dir`` names.

    A folder is made up only for a local master, where driver and executors share one disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place for a table. All of one application lie together, to be deleted when its results are written."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet to the scratch folder and read it back.

    Cuts the lineage on storage that outlives executors, and unlike a checkpoint keeps columns
    apart, so later steps read only those they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows that lie in few tasks over all shuffle partitions, ahead of costly work on each row.

    What counts is how many tasks of the scan hold rows: a file that splits is as good as many, and one that
    cannot be split is one task, however many cores wait. Counting reads no column of the table. Where there are
    as many such tasks as cores, and none has more than MOST_ROWS rows, nothing is moved. Else a task gets about DEALT_ROWS,
    so that its time does not grow with the table. The number of partitions is given because adaptive execution
    would otherwise merge them by their bytes.
    """
    spark = df.sparkSession
    tasks = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    filled, total, most = tasks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if filled >= spark.sparkContext.defaultParallelism and most <= MOST_ROWS:
        return df
    fine = min(-(-total // DEALT_ROWS), MOST_TASKS)
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), fine), key)


def is_small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``dim`` has at most ``rows`` rows, found without reading on beyond them."""
    return dim.limit(rows + 1).count() <= rows


def is_light(dim: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``dim`` has at most ``rows`` rows that take at most about ``size`` bytes as text."""
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in dim.columns])))
    n, total = dim.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and total <= size


def attach(facts: DataFrame, dim: DataFrame, key: str, spread_by: Column, small: bool, how: str = "inner") -> DataFrame:
    """Equi-join ``facts`` with one row per ``key``.

    ``small`` says that the row count was checked: then the rows are broadcast. Otherwise both sides
    are salted, because one key may own a third of all facts.
    """
    if small:
        return facts.join(F.broadcast(dim), key, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
