import pytest
from pyspark.sql import functions as F

from rankloom.operators.insights import split_by_category
from rankloom.plans.batch import labelling_pool, load_documents, rank_files
from rankloom.runtime import scratch_dir
from rankloom.sources import readers, sinks
from rankloom.streaming.intake import start_intake
from tests.conftest import plan_of

CSV = 'ID,Category,Resume_str\n007,HR,"First ""line""\n\nsecond, line  x@y.example"\nR2,,\nR3,IT,"plain"\n'


def test_csv(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text(CSV)
    rows = readers.load_csv(spark, str(path)).orderBy("pos").collect()
    assert [r.id for r in rows] == ["007", "R2", "R3"]
    assert rows[0].text == 'First "line"\nsecond, line  '
    assert rows[1].text == "" and rows[2].category == "IT"
    kept = readers.load_csv(spark, str(path), redact=False).where("id = '007'").first()
    assert "x@y.example" in kept.text


def test_columns_are_resolved_by_name(spark):
    raw = spark.createDataFrame([("a", "b", "c")], "text string, resume_text string, Category string")
    row = readers.resolve_columns(raw).first()
    assert (row.pos, row.id, row.text, row.category) == (0, "0", "b", "c")
    bare = readers.resolve_columns(spark.createDataFrame([("t", 5)], "Text string, Id int")).first()
    assert (bare.id, bare.category) == ("5", "")
    with pytest.raises(ValueError, match="no text column"):
        readers.resolve_columns(spark.createDataFrame([("t",)], "body string"))


def test_missing_id_counts_rows_over_many_files(spark, tmp_path):
    spark.range(100, numPartitions=5).select(F.col("id").cast("string").alias("text")).write.csv(str(tmp_path / "c"), header=True)
    rows = readers.resolve_columns(readers.read_csv(spark, str(tmp_path / "c"))).collect()
    assert sorted(int(r.id) for r in rows) == list(range(100))


def test_folder(spark, tmp_path):
    (tmp_path / "b.two.TXT").write_bytes(b"caf\xc3\xa9 \xff ok")
    (tmp_path / "a.txt").write_text("one\n\ntwo")
    (tmp_path / "c.md").write_text("no")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.txt").write_text("no")
    rows = readers.load_folder(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.id, r.category, r.text) for r in rows] == [("a", "", "one\ntwo"), ("b.two", "", "café ok")]


def test_a_folder_is_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """As Spark's reader does it, but nothing about a file is held on the driver; many files, odd names, files not wanted."""
    monkeypatch.setattr(readers, "_LISTED", 7)
    monkeypatch.setattr(readers, "_HELD", 50)
    inbox = tmp_path / "in box"
    inbox.mkdir()
    odd = ["a b.txt", "a!b.txt", "a%20b.txt", "é.txt", "_x.txt", "_x=1.txt", "_metadata.txt", ".h.txt", "a.b.TXT", "c.md", "x.txt._COPYING_", "[1].txt"]
    for name in odd + [f"doc.{i}.txt" for i in range(40)]:
        (inbox / name).write_text(f"text of {name}" * (1 + len(name) % 5))
    (inbox / "deep.txt").mkdir()
    (inbox / "link.txt").symlink_to(inbox / "c.md")
    (inbox / "empty.txt").write_text("")
    for folder in (str(inbox), f"file://{inbox}", f"file:{inbox}/"):
        got = readers.read_files(spark, folder)
        assert not got.inputFiles() and "binaryFile" not in plan_of(got)
        assert sorted((r.path, bytes(r.content)) for r in got.collect()) == sorted(
            (r.path, bytes(r.content)) for r in readers._by_spark(spark, folder, readers.TEXT_FILES).collect()
        )
        loaded = readers.load_folder(spark, folder, redact=False)
        assert "binaryFile" not in plan_of(loaded)
        old = readers.row_ordinals(readers._by_spark(spark, folder, readers.TEXT_FILES))
        want = readers.prepare_text(readers.text_files(old), redact=False).select("pos", "id", "category", "text")
        assert loaded.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, want.collect()))
    assert "binaryFile" in readers.read_files(spark, str(inbox / "a b.txt"))._jdf.queryExecution().toString()
    assert [r.content for r in readers.read_files(spark, str(inbox / "doc.1.t*")).collect()] == [(inbox / "doc.1.txt").read_bytes()]
    (tmp_path / "bare").mkdir()
    assert readers.load_folder(spark, str(tmp_path / "bare")).count() == 0


def test_positions_follow_files_not_tasks(spark, tmp_path):
    """A small file first: Spark packs the larger one into the first task."""
    (tmp_path / "a.csv").write_text("text\nfirst\n")
    (tmp_path / "b.csv").write_text("text\n" + "".join(f"row {i}\n" for i in range(50)))
    (tmp_path / "c.csv").write_text("text\nlast\n")
    for multi_line in (True, False):
        rows = readers.load_csv(spark, str(tmp_path / "*.csv"), multi_line=multi_line).orderBy("pos").collect()
        assert [r.text for r in rows] == ["first", *(f"row {i}" for i in range(50)), "last"]
        assert [r.id for r in rows] == [str(i) for i in range(52)]
    plan = plan_of(readers.resolve_columns(readers.read_csv(spark, str(tmp_path / "*.csv"))))
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_files_that_are_not_decoded_are_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "b.PDF").write_bytes(b"%PDF")
    with pytest.raises(ValueError, match="1 files .* b.PDF|1 files"):
        readers.load_folder(spark, str(tmp_path))
    assert [r.jd_id for r in readers.load_jobs(spark, str(tmp_path)).collect()] == ["a"]


def test_a_ranking_needs_exactly_one_job(spark, tmp_path):
    jobs, people = tmp_path / "jobs", tmp_path / "people.csv"
    jobs.mkdir()
    people.write_text("id,text\n1,python\n")
    with pytest.raises(ValueError, match="must be one job"):
        rank_files(spark, str(jobs), str(people), 2026)
    for name in ("x", "y"):
        (jobs / f"{name}.txt").write_text("Python")
    with pytest.raises(ValueError, match="'x', 'y'"):
        rank_files(spark, str(jobs), str(people), 2026)


def test_union_keeps_duplicates(spark):
    one = readers.resolve_columns(spark.createDataFrame([("a", "x")], "id string, text string"))
    both = readers.union_sources([one, one, one]).collect()
    assert len(both) == 3 and len({r.pos for r in both}) == 3


def test_labels_append(spark, tmp_path):
    store = str(tmp_path / "labels")
    for batch in ([("01", 1), ("2", 0)], [("3", 2)]):
        sinks.append_labels(spark.createDataFrame(batch, "id string, label int"), store)
    assert sorted(map(tuple, readers.load_labels(spark, store).select("id", "label").collect())) == [("01", 1), ("2", 0), ("3", 2)]


def test_category_split_sends_null_to_other(spark):
    rows = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)], "id string, category string")
    names = spark.createDataFrame([("A",)], "category string")
    assert [r.id for r in split_by_category(rows, names).collect()] == ["1"]
    assert sorted(r.id for r in split_by_category(rows, names, relevant_rows=False).collect()) == ["2", "3"]


def test_files_to_ranking_and_evaluation(spark, tmp_path):
    (tmp_path / "people.csv").write_text(
        "id,text\n1,\"python, sql\"\n2,excel\n3,\"python, 3 years of experience\"\n"
    )
    (tmp_path / "analyst.txt").write_text("Python and SQL\n2 years of experience")
    (tmp_path / "labels.csv").write_text("id,label\n1,2\n2,0\n3,1\n")
    ranked, metrics = rank_files(
        spark, str(tmp_path / "analyst.txt"), str(tmp_path / "people.csv"), 2026,
        out=str(tmp_path / "out"), labels=str(tmp_path / "labels.csv"), stop_words=[],
    )
    assert {r.jd_id for r in ranked.collect()} == {"analyst"}
    assert {r.method for r in metrics.collect()} == {"final", "skills", "tfidf"}
    written = spark.read.csv(str(tmp_path / "out"), header=True, multiLine=True, escape='"')
    assert written.count() == 3 and not [c for c in written.columns if c.startswith("contrib_")]
    labels = spark.createDataFrame([("1", 2)], "id string, label int")
    assert {r.id for r in labelling_pool(ranked, labels, 10).collect()} == {"2", "3"}
    assert load_documents(spark, str(tmp_path / "people.csv")).count() == 3


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stream_of_documents(spark, tmp_path):
    inbox, table = str(tmp_path / "inbox"), str(tmp_path / "table")
    schema = "id string, category string, text string"
    for batch in ([("1", "A", "Python a@b.example")], [("2", "B", "sql, 4 years of experience")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(inbox)
        start_intake(spark, inbox, table, str(tmp_path / "state"), 2026).awaitTermination(120)
    rows = spark.read.parquet(table).orderBy("id").collect()
    assert [(r.id, r.skills, r.experience_years) for r in rows] == [("1", ["python"], 0.0), ("2", ["sql"], 4.0)]
    assert "@" not in rows[0].text


def test_a_ranking_is_written_in_order_of_its_files(spark, tmp_path):
    from rankloom.sources.sinks import write_ranking

    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("jd_id"), (F.col("id") * 7919 % 5000 + 1).alias("rank"), F.lit(1.0).alias("contrib_x")
    )
    for fmt, suffix in (("csv", ".csv"), ("parquet", ".parquet")):
        path = tmp_path / fmt
        write_ranking(rows, str(path), fmt, files=6)
        files = sorted(p for p in path.iterdir() if p.name.endswith(suffix))
        reader = spark.read.schema("jd_id string, rank long").option("header", True).format(fmt)
        got = [tuple(r) for p in files for r in reader.load(str(p)).coalesce(1).collect()]
        assert len(files) > 3 and got == sorted(got) and len(got) == 5000


def messy_csv(n, newline="\n"):
    """Fields with line breaks, doubled quotes, commas, blank lines inside and between records, empty and missing fields."""
    out = ["id,Category,Resume_str"]
    for i in range(n):
        body = ["plain %d" % i, 'a "quoted"" word', "", "line one" + newline + newline + 'two, "' + newline, "ü" * (i % 50), newline * 3][i % 6]
        out.append(f'{i},{["HR", "", "a,b"][i % 3] if i % 3 < 2 else chr(34) + "a,b" + chr(34)},"{body.replace(chr(34), chr(34) * 2)}"')
        out += [""] * (i % 7 == 0)
    return newline.join(out) + newline


@pytest.mark.parametrize("size, newline", [(40, "\n"), (333, "\r\n"), (1 << 20, "\n")])
def test_csv_with_line_breaks_is_split_among_tasks(spark, tmp_path, monkeypatch, size, newline):
    for name, n in (("a.csv", 60), ("b.csv", 1), ("c.csv", 0), ("d.csv", 25)):
        (tmp_path / name).write_text(messy_csv(n, newline), newline="")
    whole = readers.load_csv(spark, str(tmp_path)).orderBy("pos").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        split = readers.load_large_csv(spark, str(tmp_path))
        assert sorted(split.collect()) == whole and len(whole) == 86
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 900 // size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_with_a_lone_quote_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,text\n1,5" pipe\n2,plain\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        readers.load_large_csv(spark, str(tmp_path / "x.csv"))


def test_the_label_log_keeps_its_order(spark, tmp_path):
    import os
    import shutil

    store = str(tmp_path / "log")
    batches = [[("1", 0), ("2", 0)], [("1", 1)], [], [("1", 2), ("3", 2)]]
    numbers = [sinks.append_labels(spark.createDataFrame(b, "id string, label int"), store) for b in batches]
    assert numbers == [1, 2, 3, 4]
    # A copy with all files written at the same time, an append that failed, and a number claimed by another one.
    other = str(tmp_path / "copy")
    shutil.copytree(store, other)
    for folder, _, names in os.walk(other):
        for name in names:
            os.utime(os.path.join(folder, name), (1, 1))
    spark.createDataFrame([("9", 9)], "id string, label int").write.csv(f"{other}/_pending-x", header=True)
    (tmp_path / "copy" / sinks.LABEL_LOG / f"{5:012d}").touch()
    assert sinks.append_labels(spark.createDataFrame([("2", 5)], "id string, label int"), other) == 6
    for path, second in ((store, 0), (other, 5)):
        latest = readers.latest_labels(readers.load_labels(spark, path))
        assert {r.id: r.label for r in latest.collect()} == {"1": 2, "2": second, "3": 2}


def test_labels_without_batches_are_not_appended_to(spark, tmp_path):
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "labels.csv").write_text("id,label\n1,2\n")
    with pytest.raises(ValueError, match="without batches"):
        sinks.append_labels(spark.createDataFrame([("2", 5)], "id string, label int"), str(tmp_path / "plain"))
    assert [tuple(r) for r in readers.load_labels(spark, str(tmp_path / "plain")).select("id", "label").collect()] == [("1", 2)]


def test_store_of_documents_reads_little_for_a_lookup(spark, tmp_path):
    from rankloom.operators.insights import lookup_by_id

    rows = spark.range(60_000).select(
        F.format_string("%06d", "id").alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.array("id").alias("tags")
    )
    # An id that a third of all rows have is split among files.
    hot = spark.range(30_000).select(F.lit("030000").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.array("id").alias("tags"))
    nulls = spark.createDataFrame([(None, "x", [1]), ("000007", None, None)], "id string, text string, tags array<bigint>")
    path = str(tmp_path / "store")
    sinks.write_documents(rows.union(hot).union(nulls).repartition(5), path, files=6, row_group=256 << 10)
    store = spark.read.parquet(path)
    assert store.count() == 90_002
    sizes = [r["count"] for r in store.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 30_000
    found = lookup_by_id(store, ["000007", "051234", "no such id"])
    assert sorted((r.id, r.text is None) for r in found.collect()) == [("000007", False), ("000007", True), ("051234", False)]
    assert "In(id" in plan_of(found)
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() < 20_000
    assert lookup_by_id(store, "030000").count() == 30_001
    sinks.write_documents(store.limit(0), str(tmp_path / "empty"))
    assert lookup_by_id(spark.read.schema(store.schema).parquet(str(tmp_path / "empty")), "1").count() == 0


def test_files_of_the_catalog_are_written_in_ranges(spark):
    """No task writes a whole folder, and files in order of their names hold the rows in order."""
    from catalog.text_queries import _in_files

    rows = spark.range(700, numPartitions=3).selectExpr("699 - id AS n", "cast(699 - id AS string) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a, b, c = _in_files(rows, "n", "ranges", "parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(len(spark.read.parquet(path).inputFiles()) > 1 for path in (a, b, c))
    read = [int(r.text) for r in readers.resolve_columns(spark.read.parquet(a, b, c)).orderBy("pos").collect()]
    assert read == [n for held in ([0], [2, 3, 4, 5, 6], [1]) for n in range(700) if n % 7 in held]
