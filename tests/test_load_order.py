"""Loads of rows that share offsets, of files out of order, and the jobs a step takes."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql import types as T

import plans
from rangeload import IncrementalLoader, LoadOptions, OffsetRange
from rangeload.plans.bounds import joined, rebuild_ranges
from rangeload.plans.histogram import Chunk, next_cut, still_open, tied_chunks
from rangeload.plans.offsets import OffsetType
from rangeload.streaming.state import ConcurrentLoad, StateFiles


def options(**given):
    return LoadOptions("v", **{"num_ranges": 3, "max_records": 100, **given})


def written(spark, folder, rows, files=5, kind="bigint"):
    path = f"{folder}/source"
    spark.createDataFrame(rows, f"id int, v {kind}").repartition(files).write.parquet(path)
    return path


def ids(loader):
    return Counter(r["id"] for r in loader.output().select("id").collect())


def tied(many, on, others, seed=1):
    values = [on] * many + others
    random.Random(seed).shuffle(values)
    return list(enumerate(values))


@pytest.mark.parametrize(
    ("kind", "make"),
    [
        ("bigint", lambda i: i),
        ("double", lambda i: i / 7),
        ("timestamp", lambda i: datetime(2020, 1, 1) + timedelta(hours=i)),
        ("string", lambda i: f"key-{i:05d}"),
        ("decimal(12,2)", lambda i: i),
    ],
)
def test_a_value_on_a_third_of_the_rows_is_loaded_in_steps(spark, folder, kind, make):
    rows = tied(700, make(500), [make(i) for i in range(1400)])
    if kind.startswith("decimal"):
        from decimal import Decimal

        rows = [(i, Decimal(v)) for i, v in rows]
    loader = IncrementalLoader(spark, written(spark, folder, rows, kind=kind), f"{folder}/load", options())
    loader.load_available()
    assert ids(loader) == Counter(range(2100))
    progress = loader.progress().collect()
    assert not any(r.over_cap for r in progress) and max(r.rows for r in progress) <= 100
    assert sum(r.rows for r in progress) == 2100


def test_all_rows_share_one_offset(spark, folder):
    path = written(spark, folder, [(i, 7) for i in range(1000)], files=4)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(max_records=64))
    loader.load_available()
    assert ids(loader) == Counter(range(1000))
    rows = [r.rows for r in loader.progress().collect()]
    assert max(rows) <= 64 and len(rows) <= 1000 // 60 + 4


@pytest.mark.parametrize("stop_after", [1, 2, 4, 7])
def test_restart_within_a_value(spark, folder, stop_after):
    path = written(spark, folder, tied(600, 5, list(range(300))))
    first = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2))
    for _ in range(stop_after):
        first.step()
    again = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2))
    assert [(r.lower, r.after) for r in again.ranges] == [(r.lower, r.after) for r in first.ranges]
    again.load_available()
    assert ids(again) == Counter(range(900))
    assert not any(r.over_cap for r in again.progress().collect())


def test_more_windows_than_are_fetched_at_once(spark, folder, monkeypatch):
    monkeypatch.setattr("rangeload.plans.histogram.MAX_BUCKETS", 32)
    path = written(spark, folder, tied(900, 5, list(range(100))))
    loader = IncrementalLoader(spark, path, f"{folder}/load", options())
    loader.load_available()
    assert ids(loader) == Counter(range(1000))
    assert not any(r.over_cap for r in loader.progress().collect())


def test_new_rows_at_a_value_that_is_being_loaded_are_left(spark, folder):
    path = written(spark, folder, [(i, 7) for i in range(300)], files=2)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=1))
    loader.step()
    spark.createDataFrame([(1000, 7), (1001, 8)], "id int, v bigint").coalesce(1).write.mode("append").parquet(path)
    loader.run(max_polls=1)
    assert ids(loader) == Counter([*range(300), 1001])


def test_readers_take_a_value_at_once(spark, folder):
    path = written(spark, folder, tied(400, 5, list(range(100))))

    def reader(session, predicate):
        rows = session.read.parquet(path)
        return rows if predicate is None else rows.where(predicate)

    loader = IncrementalLoader(spark, reader, f"{folder}/load", options())
    loader.load_available()
    assert ids(loader) == Counter(range(500))
    assert max(r.rows for r in loader.progress().collect()) >= 401


def test_only_files_of_a_piece_are_opened(spark, folder):
    path = f"{folder}/source"
    for part in range(6):
        spark.range(part * 100, part * 100 + 100).selectExpr("int(id) as id", "7L as v").coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    chunks = tied_chunks(df, 7, 100)
    assert [c.rows for c in chunks] and sum(c.rows for c in chunks) == 600 and max(c.rows for c in chunks) <= 100
    kind = OffsetType.of(df, "v")
    piece = OffsetRange(0, 7, 7, after=chunks[1].place, until=chunks[2].place)
    rows = df.where(piece.predicate("v", kind))
    assert rows.count() == chunks[2].rows and plans.scan_metrics(rows)["numFiles"] <= 2


def test_places_in_bounds():
    a, b = ("f", 3), ("f", 9)
    span = OffsetRange(0, 1, 9, after=a)
    assert span.moved_to(1, after=b) == OffsetRange(0, 1, 9, ">=", "<=", after=b)
    assert span.moved_to(4) == OffsetRange(0, 4, 9, ">")
    first, second = rebuild_ranges([span], 2, OffsetType(T.LongType()))
    assert (first.after, second.after) == (a, None) and first.lower == 1
    pieces = [replace(span, upper=1, until=b), OffsetRange(1, 1, 5, after=b)]
    assert joined(pieces) == pieces
    chunks = [Chunk(1, 1, 5, place=a), Chunk(1, 1, 5, place=b), Chunk(1, 1, 2), Chunk(2, 9, 4)]
    assert next_cut(chunks, OffsetRange(0, 1, 9)) == (1, a)
    assert next_cut(chunks, span) == (1, b)
    assert next_cut(chunks, span.moved_to(1, after=b)) == (1, None)
    assert next_cut(chunks, span.moved_to(1)) is None
    assert still_open(chunks, [span]) == chunks[1:]


# -- files out of order -------------------------------------------------------


def shuffled(spark, folder, files=40, many=4000):
    values = list(range(many))
    random.Random(3).shuffle(values)
    return written(spark, folder, list(enumerate(values)), files)


def test_unsorted_files_are_read_from_a_staged_copy(spark, folder):
    path = shuffled(spark, folder)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2, max_records=170))
    loader.step()
    staged = loader._state["staged"]
    assert staged and len(list(Path(staged, "rows").glob("part-*"))) >= 2
    source = spark.read.parquet(path)
    piece = loader._rows([OffsetRange(0, 2000, 2100)])
    assert plans.scan_metrics(piece)["numFiles"] <= 2 < source.rdd.getNumPartitions() * 40
    loader.load_available()
    assert ids(loader) == Counter(range(4000))
    assert not any(r.over_cap for r in loader.progress().collect())
    assert loader._state["staged"] is None and not Path(staged).exists()


def test_restart_with_a_staged_copy(spark, folder):
    path = shuffled(spark, folder)
    given = options(num_ranges=2, max_records=170)
    first = IncrementalLoader(spark, path, f"{folder}/load", given, where="v % 2 = 0", columns=["id"])
    first.step()
    again = IncrementalLoader(spark, path, f"{folder}/load", given, where="v % 2 = 0", columns=["id"])
    assert again._state["staged"] == first._state["staged"] is not None
    again.load_available()
    kept = {r["id"] for r in spark.read.parquet(path).where("v % 2 = 0").collect()}
    assert ids(again) == Counter(kept)
    spark.createDataFrame([(9000, 5000)], "id int, v bigint").coalesce(1).write.mode("append").parquet(path)
    again.run(max_polls=1)
    assert ids(again) == Counter(kept | {9000})


def test_ties_in_a_staged_copy(spark, folder):
    rows = tied(1500, 40, list(range(2500)), seed=4)
    loader = IncrementalLoader(spark, written(spark, folder, rows, 40), f"{folder}/load", options(num_ranges=2, max_records=150))
    loader.step()
    assert loader._state["staged"]
    loader.load_available()
    assert ids(loader) == Counter(range(4000)) and not any(r.over_cap for r in loader.progress().collect())


def test_ordered_files_are_not_copied(spark, folder):
    path = f"{folder}/source"
    spark.range(4000).selectExpr("int(id) as id", "id as v").repartitionByRange(20, "v").write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2, max_records=100))
    loader.step()
    assert loader._state["staged"] is None and not Path(folder, "load", "staged").exists()


def test_bytes_read_from_unsorted_files(spark, folder):
    """Every column of every row is read at most three times, offsets for the planning included."""
    many = 120_000
    path = f"{folder}/source"
    rows = spark.range(many).selectExpr("int(id) as id", "hash(id) as v", "sha2(string(id), 512) as text")
    rows.repartition(40).write.parquet(path)
    size = sum(p.stat().st_size for p in Path(path).glob("*.parquet"))
    before = input_bytes(spark)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=1, max_records=many // 12))
    loader.load_available()
    read = input_bytes(spark) - before
    assert loader.summary().first().steps >= 12
    assert read <= 3 * size


def input_bytes(spark):
    """Bytes that tasks have read from files so far."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    executors = spark._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalInputBytes() for i in range(executors.size()))


# -- jobs -----------------------------------------------------------------------


def test_a_step_is_one_job(spark, folder):
    path = f"{folder}/source"
    spark.range(3000).selectExpr("int(id) as id", "id as v").repartitionByRange(6, "v").write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options())
    loader.step()
    tracker = spark.sparkContext.statusTracker()
    for turn in range(3):
        spark.sparkContext.setJobGroup(f"step-{folder}-{turn}", "a step")
        try:
            assert loader.step() > 0
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        assert len(tracker.getJobIdsForGroup(f"step-{folder}-{turn}")) == 1


def test_a_step_without_rows(spark, folder):
    path = written(spark, folder, [(i, v) for i, v in enumerate([*range(50), *range(10_000, 10_050)])], files=1)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=5, max_records=10), where="v < 5")
    loader.load_available()
    assert ids(loader) == Counter(range(5))


def test_many_ranges_are_counted_from_the_files(spark, folder):
    rows = list(enumerate(range(2000)))
    loader = IncrementalLoader(spark, written(spark, folder, rows), f"{folder}/load", options(num_ranges=50, max_records=20))
    loader.load_available()
    assert ids(loader) == Counter(range(2000))
    assert loader.progress().agg(F.sum("rows")).first()[0] == 2000


# -- two loaders --------------------------------------------------------------------


class Interleaved(StateFiles):
    """Lets another loader make a step before the ``turn``-th document is written."""

    def __init__(self, spark, root):
        super().__init__(spark, root)
        self.turn, self.other, self.refused = -1, None, None

    def write(self, *given, **named):
        self.turn -= 1
        if self.turn == 0:
            try:
                self.other.step()
            except ConcurrentLoad as error:
                self.refused = error
        super().write(*given, **named)


@pytest.mark.parametrize("turn", [1, 2, 3, 4, 5])
def test_of_two_interleaved_loaders_one_is_refused(spark, folder, turn):
    path = shuffled(spark, folder, files=8, many=800)
    given = options(num_ranges=2, max_records=40)
    one, two = (IncrementalLoader(spark, path, f"{folder}/load", given) for _ in range(2))
    documents = one._documents = Interleaved(spark, f"{folder}/load")
    documents.turn, documents.other = turn, two
    refused = None
    try:
        one.step()
    except ConcurrentLoad as error:
        refused = error
    wrote = documents.turn <= 0  # the other had its turn
    assert wrote == bool(refused or documents.refused)
    last = IncrementalLoader(spark, path, f"{folder}/load", given)
    assert last._state["step"] == 1 and last.output().count() == last._state["rows"] > 0
    last.load_available()
    assert ids(last) == Counter(range(800))


def test_a_name_is_given_once(spark, folder):
    documents = StateFiles(spark, folder)
    draft = Path(folder, "state", ".draft.tmp")
    documents.write("state", 1, {"a": 1})
    draft.write_text("{}")
    target, fs = documents._open(documents.path("state", 1))
    with pytest.raises(Py4JJavaError, match="FileAlreadyExists"):
        documents._publish(documents._open(str(draft))[0], target, fs)
    assert documents.read("state", 1) == {"a": 1}
    assert sorted(p.name for p in Path(folder, "state").iterdir() if p.suffix == ".json") == ["000001.json"]


def test_names_are_given_once_on_other_file_systems(spark, folder):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.names.link./in", f"file://{folder}")
    documents = StateFiles(spark, "viewfs://names/in/load")
    documents.write("state", 1, {"a": 1})
    with pytest.raises(ConcurrentLoad):
        documents.write("state", 1, {"a": 2})
    assert documents.read("state", 1) == {"a": 1}


# -- the log of states --------------------------------------------------------------


def test_states_are_folded(spark, folder, monkeypatch):
    """Few documents are listed at a restart, and progress tells of all steps."""
    monkeypatch.setattr("rangeload.streaming.incremental.FOLDED", 4)
    rows = spark.createDataFrame([(i, i) for i in range(300)], "id int, v bigint")
    loader = IncrementalLoader(spark, rows, folder, options(num_ranges=1, max_records=20))
    late = IncrementalLoader(spark, rows, folder, options(num_ranges=1, max_records=20))
    for _ in range(6):
        loader.step()
    with pytest.raises(ConcurrentLoad):
        late.step()
    again = IncrementalLoader(spark, rows, folder, options(num_ranges=1, max_records=20))
    again.load_available()
    assert ids(again) == Counter(range(300))
    steps = again.summary().first().steps
    assert steps >= 15 and len(StateFiles(spark, folder).numbers("state")) <= 4
    progress = again.progress().collect()
    assert sorted(r.step for r in progress) == list(range(1, steps + 1)) and sum(r.rows for r in progress) == 300
