"""Native streams and batch sinks."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rangeload import LoadOptions, scratch_dir
from rangeload.sources.sinks import read_csv, write_csv, write_parquet
from rangeload.sources.tables import read_table
from rangeload.streaming.streams import (
    BatchTable,
    ProgressListener,
    drop_replayed_stream,
    load_once,
    read_stream,
    session_progress,
    start_stream,
    stream_progress,
    stream_table,
)


@pytest.fixture
def source(spark, folder):
    path = f"{folder}/source"
    times = "timestamp_micros(1577836800000000 + id * 1000001)"
    spark.range(100).selectExpr("id", f"{times} AS at", "concat('n', id) AS name").repartition(5).write.parquet(path)
    return path


def test_load_once_in_batches(spark, folder, source):
    schema = spark.read.parquet(source).schema
    rows = read_stream(spark, source, schema, ["id", "name"], "id >= 10", max_files=2)
    query = load_once(rows, f"{folder}/out", f"{folder}/checkpoint")
    assert [p["numInputRows"] > 0 for p in query.recentProgress] == [True, True, True]
    assert stream_progress(spark, query).agg(F.sum("rows")).first()[0] == 100
    written = spark.read.parquet(f"{folder}/out")
    assert written.columns == ["id", "name"] and written.count() == 90


def test_checkpoint_resumes_with_new_files_only(spark, folder, source):
    schema = spark.read.parquet(source).schema

    def run():
        load_once(read_stream(spark, source, schema), f"{folder}/out", f"{folder}/checkpoint", "json")
        return spark.read.schema(schema).json(f"{folder}/out").count()

    assert run() == 100
    assert run() == 100
    spark.read.parquet(source).withColumn("id", F.col("id") + 100).write.mode("append").parquet(source)
    assert run() == 200


def test_stream_by_options(spark, folder, source):
    schema = spark.read.parquet(source).schema
    options = LoadOptions("id", max_batches=2, load_available=True, query_name="by_options")
    query = stream_table(spark, source, schema, folder, options, ["id"])
    query.awaitTermination()
    assert query.name == "by_options" and len(query.recentProgress) == 3
    assert spark.read.parquet(f"{folder}/data").count() == 100


def test_stream_honours_or_refuses_options(spark, folder, source):
    schema = spark.read.parquet(source).schema
    options = LoadOptions("id", "13", "70", include_deleted=False, load_available=True)
    query = stream_table(spark, source, schema, folder, options, ["id"], "id <> 20", deleted="id % 2 = 0")
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/data").collect()) == list(range(13, 71, 2))
    for refused in (LoadOptions("id", reader="a.b"), LoadOptions("id", num_ranges=2), options):
        with pytest.raises(ValueError):
            stream_table(spark, source, schema, folder, refused)


def test_progress_of_more_batches_than_spark_keeps(spark, folder, source):
    schema = spark.read.parquet(source).schema
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1)
    try:
        query = load_once(read_stream(spark, source, schema, max_files=1), f"{folder}/out", f"{folder}/c")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    progress = stream_progress(spark, query)
    assert len(query.recentProgress) <= 1 and progress.count() == 5
    assert progress.agg(F.sum("rows")).first()[0] == 100


def test_polling_stream(spark, folder, source):
    schema = spark.read.parquet(source).schema
    listener = ProgressListener()
    spark.streams.addListener(listener)
    rows = read_stream(spark, source, schema, max_bytes=1 << 30)
    query = start_stream(rows, f"{folder}/out", f"{folder}/c", poll_interval_ms=100, query_name="polling")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{folder}/out").count() == 100
        spark.read.parquet(source).write.mode("append").parquet(source)
        query.processAllAvailable()
        assert spark.read.parquet(f"{folder}/out").count() == 200
    finally:
        query.stop()
    deadline = time.time() + 20
    while time.time() < deadline and listener.queries.get(str(query.id), {}).get("status") != "FINISHED":
        time.sleep(0.1)
    seen = listener.queries[str(query.id)]
    spark.streams.removeListener(listener)
    assert (seen["name"], seen["status"], seen["rows"]) == ("polling", "FINISHED", 200)


def test_empty_source(spark, folder):
    schema = spark.range(1).schema
    spark.range(0).write.parquet(f"{folder}/source")
    query = load_once(read_stream(spark, f"{folder}/source", schema), f"{folder}/out", f"{folder}/c")
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0


def test_single_file(spark, folder, source):
    whole = spark.read.parquet(source)
    whole.coalesce(1).write.parquet(f"{folder}/one")
    name = whole.sparkSession.read.parquet(f"{folder}/one").select("_metadata.file_path").first()[0]
    rows = read_stream(spark, name.removeprefix("file:"), whole.schema)
    load_once(rows, f"{folder}/out", f"{folder}/c")
    assert spark.read.parquet(f"{folder}/out").count() == 100


def test_replayed_rows_are_dropped(spark, folder, source):
    schema = spark.read.parquet(source).schema
    spark.read.parquet(source).write.mode("append").parquet(source)
    spark.read.parquet(source).where("id = 5").crossJoin(spark.range(500)).drop(spark.range(1).id).select(
        F.lit(5).cast("bigint").alias("id"), "at", "name"
    ).write.mode("append").parquet(source)
    rows = drop_replayed_stream(read_stream(spark, source, schema, max_files=4), ["id"], "1 hour")
    load_once(rows, f"{folder}/out", f"{folder}/c")
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(r.id for r in out.collect()) == list(range(100))


def test_late_rows_are_kept_and_replays_after_a_restart_are_not(spark, folder):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "id long, at string").withColumn("at", F.col("at").cast("timestamp"))
    late = spark.createDataFrame([(2, "2020-01-01 00:00:00"), (1, "2020-01-01 00:00:00")], "id long, at string").withColumn("at", F.col("at").cast("timestamp"))
    for more in (rows, late, rows):
        more.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = read_stream(spark, f"{folder}/in", rows.schema)
        load_once(drop_replayed_stream(stream, ["id"], "1 hour"), f"{folder}/out", f"{folder}/c")
    found = [(r.id, r["at"].year) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(found) == [(1, 2024), (2, 2020)]


def test_sinks_keep_every_value(spark, folder):
    df = spark.createDataFrame(
        [(1, 'a "quoted", text', 1.5), (2, " space ", None), (3, None, 1e-300), (4, "back\\slash", -0.0)],
        "id int, text string, number double",
    ).withColumn("at", F.expr("timestamp_micros(1577836800123456 + id)"))
    df = df.withColumn("local", F.col("at").cast("timestamp_ntz"))
    write_csv(df, f"{folder}/csv")
    write_parquet(df, f"{folder}/parquet")
    wanted = sorted(map(str, df.collect()))
    assert sorted(map(str, read_csv(spark, f"{folder}/csv", df.schema).collect())) == wanted
    assert sorted(map(str, read_table(spark, f"{folder}/parquet").collect())) == wanted


class Session:
    """Just what ``scratch_dir`` asks a session for."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = self
        self.master = master


def test_scratch_is_where_the_session_says():
    cluster = Session("yarn", "/tmp/shared/")
    assert scratch_dir(cluster, "x").startswith("/tmp/shared/rangeload-x-")
    assert scratch_dir(cluster) != scratch_dir(cluster)
    assert scratch_dir(Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"))


def test_progress_outlives_the_session(spark, folder, monkeypatch):
    """Batches of two runs, folded by threes, read without the query in a session that never heard of it."""
    monkeypatch.setattr(BatchTable, "MANY", 3)
    schema = spark.range(1).schema
    for part in range(4):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    for turn in range(2):
        rows = read_stream(spark, f"{folder}/in", schema, max_files=1)
        query = start_stream(rows, f"{folder}/out", f"{folder}/check", query_name="kept")
        query.awaitTermination()
        session_progress(spark).wait_for(query)
        spark.range(1000 + turn * 10, 1010 + turn * 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    other = spark.newSession()
    found = stream_progress(other, f"{folder}/check").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in found] == list(range(5)) and {r["rows"] for r in found} == {10}
    assert {(r["query_id"], r["query_name"]) for r in found} == {(str(query.id), "kept")}
    documents = list(Path(folder, "check", "batches").glob("*/[0-9]*.json"))
    assert len(documents) == 3
    assert session_progress(spark).batches.get(str(query.id)) is None, "the driver holds no batches"
    assert stream_progress(other, f"{folder}/none").count() == 0


def test_state_is_on_disk_and_survives_a_restart(spark, folder):
    """Repeats of earlier runs are dropped by the state in the checkpoint, which comes as changes."""
    schema = spark.range(1).schema
    for turn in range(3):
        spark.range(turn * 50, turn * 50 + 100).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        rows = drop_replayed_stream(read_stream(spark, f"{folder}/in", schema, max_files=1), ["id"], "1 hour")
        start_stream(rows, f"{folder}/out", f"{folder}/check").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == list(range(200))
    assert list(Path(folder, "check", "state").rglob("*.changelog")), "the state store writes changes"
    assert "spark.sql.streaming.stateStore.providerClass" not in spark.conf.getAll
