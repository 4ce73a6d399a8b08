from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rankloom.runtime import is_light, materialize, scratch_dir, scratch_path, spread


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def session(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=FakeContext(master))


def test_a_local_session_without_setting_gets_one_folder():
    local = session("local[2]")
    assert scratch_dir(local) == scratch_dir(local)


def test_a_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"))


def test_tables_are_written_below_the_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    stored = materialize(spark.range(5).selectExpr("id", "array(id) AS a"), "x")
    assert stored.count() == 5 and all(spark.conf.get("spark.checkpoint.dir") in f for f in stored.inputFiles())


def test_rows_move_only_when_files_are_few(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100, numPartitions=2).write.parquet(few)
    spark.range(100, numPartitions=spark.sparkContext.defaultParallelism).write.parquet(many)
    plan = lambda path: spread(spark.read.parquet(path), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan(few) and "Exchange" not in plan(many)


def test_one_file_of_many_splits_stays(spark, tmp_path):
    """What counts is tasks with rows, not files."""
    cores = spark.sparkContext.defaultParallelism
    one = str(tmp_path / "one")
    spark.range(40_000).selectExpr("id", "sha2(string(id), 256) AS text").coalesce(1).write.option("parquet.block.size", 65536).parquet(one)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = spark.read.parquet(one)
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= cores
        assert "Exchange" not in spread(rows, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_wide_rows_are_not_light(spark):
    assert is_light(spark.range(5).selectExpr("id", "repeat('x', 100) AS t"))
    assert not is_light(spark.range(5).selectExpr("id", "repeat('x', 100) AS t"), size=300)
    assert not is_light(spark.range(6), rows=5)


def test_tasks_do_not_grow_with_the_table(spark, tmp_path):
    """Files as many as cores, each with many rows, are dealt to more tasks."""
    cores, rows = spark.sparkContext.defaultParallelism, 6_000
    path = str(tmp_path / "large")
    spark.range(cores * rows, numPartitions=cores).write.parquet(path)
    dealt = spread(spark.read.parquet(path), "id")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > cores and max(sizes) < 5_000 and sum(sizes) == cores * rows
