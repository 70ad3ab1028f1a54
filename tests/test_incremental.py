"""The incremental loader: caps, restarts, polls, skew, crashes."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import plans
from rangeload import IncrementalLoader, LoadOptions, OffsetRange, drop_replayed, replay_from
from rangeload.plans.files import FileOffsets
from rangeload.plans.offsets import OffsetType
from rangeload.streaming.state import ConcurrentLoad, StateFiles


def options(offset="v", **given):
    return LoadOptions(offset, **{"num_ranges": 3, "max_records": 100, **given})


def numbers(spark, values, kind="bigint"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def steps(loader):
    done = {}
    for row in loader.progress().collect():
        done.setdefault(row.step, []).append(row)
    return done


def test_cap_holds_and_every_row_is_loaded_once(spark, folder):
    df = numbers(spark, range(1000))
    loader = IncrementalLoader(spark, df, folder, options())
    assert loader.status == "PROCESSING_DATA"
    assert loader.load_available() == 1000
    assert ids(loader.output()) == list(range(1000))
    for rows in steps(loader).values():
        assert all(0 < r.rows <= 100 for r in rows) and len(rows) <= 3
    assert loader.status == "WAITING_DATA" and loader.max_offset == 999
    assert loader.step() is None and loader.load_available() == 0


def test_few_rows_take_one_step(spark, folder):
    loader = IncrementalLoader(spark, numbers(spark, range(50)), folder, options())
    assert loader.step() == 50 and loader.step() is None


def test_skew_is_split_again(spark, folder):
    """Nine tenths of the rows are in the first of the ranges."""
    draw = random.Random(1)
    values = [draw.randrange(900) for _ in range(900)] + [draw.randrange(10_000) for _ in range(100)]
    loader = IncrementalLoader(spark, numbers(spark, values), folder, options(num_ranges=4))
    assert loader.load_available() == 1000
    assert ids(loader.output()) == list(range(1000))
    by_step = steps(loader)
    # Rows taken one by one by a single range would need nine steps.
    assert len(by_step) <= 6
    later = by_step[2]
    assert len(later) == 4 and max(r.lower for r in later) < 3000
    assert all(r.rows <= 100 for rows in by_step.values() for r in rows)


def test_one_value_on_a_third_of_the_rows(spark, folder):
    values = [500] * 400 + list(range(800))
    random.Random(2).shuffle(values)
    loader = IncrementalLoader(spark, numbers(spark, values), folder, options())
    loader.load_available()
    assert ids(loader.output()) == list(range(1200))
    big = [r for rows in steps(loader).values() for r in rows if r.rows > 100]
    assert len(big) == 1 and big[0].rows <= 401 + 100


def test_all_rows_share_one_offset(spark, folder):
    loader = IncrementalLoader(spark, numbers(spark, [7] * 300), folder, options())
    assert loader.load_available() == 300 and len(steps(loader)) == 1


@pytest.mark.parametrize(
    ("kind", "make"),
    [
        ("int", lambda i: i * 3),
        ("double", lambda i: i / 7),
        ("timestamp", lambda i: datetime(2020, 1, 1) + timedelta(hours=i)),
        ("timestamp_ntz", lambda i: datetime(2020, 1, 1) + timedelta(microseconds=i)),
        ("date", lambda i: datetime(2020, 1, 1).date() + timedelta(days=i % 50)),
        ("string", lambda i: f"key-{i:05d}"),
    ],
)
def test_offset_types_and_polling(spark, folder, kind, make):
    df = numbers(spark, [make(i) for i in range(400)], kind)
    options_ = options(max_records=60)
    low = IncrementalLoader(spark, df.where("id < 250"), folder, options_)
    low.load_available()
    last = low.output().agg(F.max("v")).first()[0]
    again = IncrementalLoader(spark, df, folder, options_)
    new = df.where(F.col("v") > F.lit(last)).count()
    assert again.poll() == new
    if kind == "string":
        assert len(again.ranges) == 1
    if new:
        assert again.ranges[0].lo_op == ">"
    again.load_available()
    wanted = ids(df.where((F.col("id") < 250) | (F.col("v") > F.lit(last))))
    assert ids(again.output()) == wanted


def test_number_of_ranges_after_a_poll(spark, folder):
    df = numbers(spark, range(1000))
    IncrementalLoader(spark, df.where("v < 700"), folder, options(max_records=1000)).load_available()
    again = IncrementalLoader(spark, df, folder, options(max_records=150))
    assert again.poll() == 300
    assert len(again.ranges) == 2
    assert again.poll() == 0, "open ranges come first"
    again.load_available()
    assert again.poll() == 0
    assert ids(again.output()) == list(range(1000))


def test_filter_columns_and_hidden_offset(spark, folder):
    df = numbers(spark, range(300)).withColumn("x", F.col("id") * 2)
    loader = IncrementalLoader(spark, df, folder, options(), where="x > 100", columns=["X", "id"])
    loader.load_available()
    assert loader.output().columns == ["X", "id"]
    assert ids(loader.output()) == list(range(51, 300))
    with pytest.raises(ValueError, match="No column"):
        IncrementalLoader(spark, df, folder + "/2", options(), columns=["nope"])
    with pytest.raises(ValueError, match="No offset column"):
        IncrementalLoader(spark, df, folder + "/3", options("nope"))


def test_last_offset_is_of_the_whole_table_but_new_rows_must_match(spark, folder):
    df = numbers(spark, range(20))
    loader = IncrementalLoader(spark, df, folder, options(), where="id < 10")
    loader.load_available()
    assert loader.max_offset == 19 and loader.poll() == 0
    assert ids(loader.output()) == list(range(10))


def test_given_bounds(spark, folder):
    loader = IncrementalLoader(
        spark, numbers(spark, range(100)), folder, options(initial_offset="10", end_offset="49", max_records=7)
    )
    loader.load_available()
    assert ids(loader.output()) == list(range(10, 50))
    assert loader.poll() == 50


def test_first_offset_past_the_table(spark, folder):
    df = numbers(spark, range(100))
    early = IncrementalLoader(spark, df.where("v < 50"), folder, options(initial_offset=60))
    assert early.load_available() == 0 and early.poll() == 0
    later = IncrementalLoader(spark, df, folder, options(initial_offset=60))
    later.run(max_polls=1)
    assert ids(later.output()) == list(range(60, 100))


def test_last_offset_before_the_table(spark, folder):
    df = numbers(spark, range(100))
    loader = IncrementalLoader(spark, df, folder, options(end_offset=-5))
    assert loader.load_available() == 0
    loader.run(max_polls=1)
    assert ids(loader.output()) == list(range(100))


def test_empty_table_then_rows(spark, folder):
    df = numbers(spark, range(10))
    empty = IncrementalLoader(spark, df.where("id < 0"), folder, options())
    assert empty.load_available() == 0 and empty.max_offset is None
    assert empty.output().collect() == [] and empty.output().columns == ["id", "v"]
    again = IncrementalLoader(spark, df, folder, options())
    assert again.run(max_polls=1) == 10
    assert ids(again.output()) == list(range(10))


def test_rows_without_offset_are_counted_not_loaded(spark, folder):
    df = numbers(spark, [1.0, 2.0, None, float("nan"), 3.0], "double")
    loader = IncrementalLoader(spark, df, folder, options())
    loader.load_available()
    assert ids(loader.output()) == [0, 1, 4]
    summary = loader.summary().first()
    assert (summary.rows, summary.rows_without_offset, summary.open_ranges) == (3, 2, 0)


def test_restart_with_open_ranges(spark, folder):
    df = numbers(spark, range(1000))
    first = IncrementalLoader(spark, df, folder, options())
    first.step(), first.step()
    second = IncrementalLoader(spark, df, folder, options())
    assert second.ranges == first.ranges and second.max_offset == first.max_offset
    assert ids(second.output()) == ids(first.output())
    second.load_available()
    assert ids(second.output()) == list(range(1000))


def test_restart_from_a_saved_state(spark, folder):
    """As one written by hand: one open range, then new rows past the end."""
    day = datetime(2020, 1, 1)
    df = numbers(spark, [day + timedelta(days=i) for i in range(300)], "timestamp")
    state = {
        "version": 4, "step": 0, "max_offset": "2020-04-02T00:00:00Z", "rows": 0, "planned_rows": 62, "cuts": None,
        "without_offset": 0, "done": [], "started_ms": 0, "took_ms": 0,
        "ranges": [{"id": 0, "lower": "2020-02-01T00:00:00Z", "upper": "2020-04-02T00:00:00Z",
                    "lo_op": ">=", "hi_op": "<=", "loaded": 0, "done": False}],
    }
    Path(folder, "state").mkdir()
    Path(folder, "state", "000004.json").write_text(json.dumps(state))
    loader = IncrementalLoader(spark, df, folder, options())
    loader.load_available()
    assert ids(loader.output()) == list(range(31, 93))
    loader.run(max_polls=1)
    assert ids(loader.output()) == list(range(31, 300))


class Crash(Exception):
    pass


@pytest.mark.parametrize("where", ["_count", "_save"])
def test_a_step_that_crashed_is_repeated_as_planned(spark, folder, monkeypatch, where):
    df = numbers(spark, range(1000))
    first = IncrementalLoader(spark, df, folder, options())
    first.step()

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(first, where, crash)
        with pytest.raises(Crash):
            first.step()
    before = Path(folder, "plan", "000002.json").read_text()
    second = IncrementalLoader(spark, df, folder, options(max_records=9))
    assert len(ids(second.output())) == first._state["rows"], "an unfinished step is not shown"
    second.step()
    assert Path(folder, "plan", "000002.json").read_text() == before
    third = IncrementalLoader(spark, df, folder, options())
    third.load_available()
    assert ids(third.output()) == list(range(1000))


def test_custom_reader(spark, folder):
    df = numbers(spark, range(500))
    asked = []

    def reader(session, predicate):
        asked.append(predicate)
        rows = df.where("id <> 13")
        return rows if predicate is None else rows.where(predicate)

    loader = IncrementalLoader(spark, reader, folder, options())
    loader.load_available()
    assert asked[0] is None and len(asked) > 2
    assert ids(loader.output()) == [i for i in range(500) if i != 13]


def test_named_reader(spark, folder):
    numbers(spark, range(30)).createOrReplaceTempView("named_reader")
    loader = IncrementalLoader(spark, None, folder, options(reader="test_incremental.ViewReader"))
    assert loader.load_available() == 30
    for bad in ("no.such.Reader", "test_incremental.Missing", "json", "test_incremental.__doc__"):
        with pytest.raises(ValueError, match="reader"):
            IncrementalLoader(spark, None, f"{folder}/2", options(reader=bad))


class ViewReader:
    def __call__(self, session, predicate):
        rows = session.table("named_reader")
        return rows if predicate is None else rows.where(predicate)


def test_deleted_rows(spark, folder):
    df = numbers(spark, range(200)).withColumn("gone", F.col("id") >= 150)
    loader = IncrementalLoader(spark, df, folder, options(include_deleted=False), deleted="gone", columns=["id"])
    loader.load_available()
    assert ids(loader.output()) == list(range(150))
    with pytest.raises(ValueError, match="marks deleted"):
        IncrementalLoader(spark, df, f"{folder}/2", options(include_deleted=False))


def test_path_source_sees_new_files(spark, folder):
    path = f"{folder}/source"
    df = numbers(spark, range(200))
    df.where("v < 120").write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(poll_interval_ms=0))
    assert loader.run(max_polls=2) == 120
    df.where("v >= 120").write.mode("append").parquet(path)
    assert loader.run(max_polls=2) == 80
    assert ids(loader.output()) == list(range(200))


def test_table_source(spark, folder):
    numbers(spark, range(150)).createOrReplaceTempView("loader_source")
    loader = IncrementalLoader(spark, "loader_source", folder, options(load_available=True))
    loader.run()
    assert loader.status == "FINISHED" and ids(loader.output()) == list(range(150))


def test_polls_wait_and_end(spark, folder, monkeypatch):
    waits = []
    monkeypatch.setattr("rangeload.streaming.incremental.sleep", waits.append)
    loader = IncrementalLoader(spark, numbers(spark, range(5)), folder, options(poll_interval_ms=2500))
    assert loader.run(max_polls=3) == 5
    assert waits == [2.5, 2.5]


def test_steps_open_only_the_files_they_need(spark, folder):
    path = f"{folder}/source"
    numbers(spark, range(2000)).repartitionByRange(10, "v").write.parquet(path)
    df = spark.read.parquet(path)
    files = FileOffsets.collect(df, "v", f"{folder}/index")
    narrowed = files.narrow(df, [OffsetRange(0, 100, 150), OffsetRange(1, 1900, 1999)])
    assert plans.scan_metrics(narrowed)["numFiles"] == 2
    stats = files.stats()
    assert (stats.first, stats.last, stats.rows) == (0, 1999, 2000)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2))
    assert loader._files is not None
    loader.load_available()
    assert ids(loader.output()) == list(range(2000))


def test_few_of_very_many_files(spark, folder):
    """A slice of a fiftieth of the files opens just these, however many there are."""
    path = f"{folder}/source"
    numbers(spark, range(3000)).repartitionByRange(150, "v").write.parquet(path)
    df = spark.read.parquet(path)
    narrowed = FileOffsets.collect(df, "v", f"{folder}/index").narrow(df, [OffsetRange(0, 1000, 1050)])
    assert plans.scan_metrics(narrowed)["numFiles"] <= 5
    assert narrowed.where("v BETWEEN 1000 AND 1050").count() == 51


def test_polls_open_only_new_files(spark, folder):
    path = f"{folder}/source"
    df = numbers(spark, [*range(300), None, None], "bigint")
    df.where("id < 200").repartition(4).write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options())
    loader.load_available()
    known = dict(loader._known)
    assert len(known) == 4
    assert loader.poll() == 0 and loader._files.names() == {}
    df.where("id >= 200").coalesce(1).write.mode("append").parquet(path)
    assert loader.poll() == 100
    assert len(loader._files.names()) == 1 and not loader._files.names().keys() & known.keys()
    assert loader.summary().first().rows_without_offset == 2, "those that came later count as well"
    loader.load_available()
    assert loader.poll() == 0 and loader.summary().first().rows_without_offset == 2
    assert ids(loader.output()) == list(range(300))


def test_rows_past_the_last_offset_in_old_files_are_found(spark, folder):
    path = f"{folder}/source"
    numbers(spark, range(100)).write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(end_offset="49"))
    loader.load_available()
    assert loader.poll() == 50


def test_scattered_steps_write_few_files(spark, folder):
    path = f"{folder}/source"
    numbers(spark, range(4000)).repartition(40).write.parquet(path)
    loader = IncrementalLoader(spark, path, f"{folder}/load", options(num_ranges=2, max_records=250))
    loader.load_available()
    written = list(Path(folder, "load", "data").glob("*/part-*.parquet"))
    assert ids(loader.output()) == list(range(4000))
    assert len(written) <= 4 * loader.summary().first().steps


def test_what_the_driver_keeps_does_not_grow(spark, folder, monkeypatch):
    monkeypatch.setattr("rangeload.plans.histogram.MAX_BUCKETS", 32)
    values = [int(1.01**i) for i in range(2000)]
    loader = IncrementalLoader(spark, numbers(spark, values), folder, options(num_ranges=2, max_records=40))
    held = []
    while loader.step() is not None:
        held.append(len(loader._chunks))
    sizes = [p.stat().st_size for p in sorted(Path(folder, "finer").glob("*.json"))]
    assert ids(loader.output()) == list(range(2000))
    assert len(held) > 10 and max(held) <= 3 * 32 and len(sizes) > 3 and max(sizes[len(sizes) // 2 :]) <= 2 * max(sizes[: len(sizes) // 2])


def test_restart_between_finer_cuts(spark, folder, monkeypatch):
    monkeypatch.setattr("rangeload.plans.histogram.MAX_BUCKETS", 16)
    df = numbers(spark, [int(1.02**i) for i in range(900)])
    while True:
        loader = IncrementalLoader(spark, df, folder, options(num_ranges=2, max_records=40))
        if loader.step() is None:
            break
    assert ids(loader.output()) == list(range(900))
    assert all(r.rows <= 40 or r.over_cap for r in loader.progress().collect())


def test_another_load_on_the_same_root_is_refused(spark, folder):
    df = numbers(spark, range(100)).withColumn("w", F.col("id") % 7)
    IncrementalLoader(spark, df, folder, options(), where="id > 3").step()
    for given, narrow in ((options("id"), {"where": "id > 3"}), (options(), {"where": "id > 4"}), (options(), {"where": "id > 3", "columns": ["id"]})):
        with pytest.raises(ValueError, match="another load"):
            IncrementalLoader(spark, df, folder, given, **narrow)
    again = IncrementalLoader(spark, df, folder, options(), where="id > 3")
    again.load_available()
    assert ids(again.output()) == list(range(4, 100))


def test_columns_that_would_be_overwritten_are_refused(spark, folder):
    df = numbers(spark, range(3)).withColumn("Load_Step", F.lit(99))
    with pytest.raises(ValueError, match="load_step"):
        IncrementalLoader(spark, df, folder, options())
    assert IncrementalLoader(spark, df, folder, options(), columns=["id"]).load_available() == 3


def test_two_loaders_on_one_root(spark, folder):
    df = numbers(spark, range(1000))
    one, two = (IncrementalLoader(spark, df, folder, options()) for _ in range(2))
    one.step()
    with pytest.raises(ConcurrentLoad):
        two.step()
    three = IncrementalLoader(spark, df, folder, options())
    three.step()
    with pytest.raises(ConcurrentLoad):
        one.step()
    three.load_available()
    assert ids(three.output()) == list(range(1000))
    assert (one.status, three.status) == ("FAILED", "WAITING_DATA")


def test_documents_are_not_replaced(spark, folder):
    documents = StateFiles(spark, folder)
    documents.write("state", 1, {"a": 1})
    with pytest.raises(ConcurrentLoad):
        documents.write("state", 1, {"a": 2})
    assert documents.read("state", 1) == {"a": 1} and documents.numbers("state") == [1]
    documents.write("state", 1, {"a": 3}, replace=True)
    assert documents.read("state", 1) == {"a": 3}


def test_failed_until_a_step_ends_well(spark, folder, monkeypatch):
    loader = IncrementalLoader(spark, numbers(spark, range(500)), folder, options())

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(loader, "_count", crash)
        with pytest.raises(Crash):
            loader.step()
    assert loader.status == "FAILED" and loader.summary().first().status == "FAILED"
    loader.step()
    assert loader.status == "PROCESSING_DATA"


def test_infinite_offsets(spark, folder):
    inf = float("inf")
    values = [inf, -inf, None, float("nan"), 1e308, -1e308, *[i / 3 for i in range(500)]]
    loader = IncrementalLoader(spark, numbers(spark, values, "double"), folder, options())
    loader.load_available()
    assert ids(loader.output()) == [i for i in range(506) if i not in (2, 3)]
    assert all(r.rows <= 100 for rows in steps(loader).values() for r in rows)


def test_no_file_offsets_without_files(spark, folder):
    assert FileOffsets.collect(spark.range(3), "id", folder) is None


def test_progress_times_and_cursors(spark, folder):
    loader = IncrementalLoader(spark, numbers(spark, range(1000)), folder, options(query_name="numbers"))
    loader.load_available()
    rows = loader.progress().collect()
    assert sum(r.rows for r in rows) == 1000
    assert all(r.took_ms >= 0 and r.started.year >= 2020 for r in rows)
    assert all(r.lower <= r.cursor <= r.upper for r in rows if r.rows)
    summary = loader.summary().first()
    assert (summary.query_name, summary.max_offset, summary.rows) == ("numbers", "999", 1000)
    assert summary.steps == len({r.step for r in rows})
    assert (summary.initial_offset, summary.rows_left) == ("0", 0) and summary.begun <= summary.last_step
    assert max(r.rows_so_far for r in rows) == 1000 and not any(r.over_cap for r in rows)


def test_replay(spark):
    df = numbers(spark, [10, 11, 15, 15, 20, 21])
    span = OffsetRange(0, 10, 20)
    assert ids(replay_from(df, "v", span, 15)) == [2, 3, 4]
    assert ids(replay_from(df, "v", span, 15, "at_most_once")) == [4]
    seen = df.where("v <= 15 AND v >= 10").unionByName(replay_from(df, "v", span, 15))
    assert Counter(ids(seen)) == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1}
    assert ids(drop_replayed(seen, "id")) == [0, 1, 2, 3, 4]
    assert ids(drop_replayed(seen, "id", offset="v", cursors=[15])) == [0, 1, 2, 3, 4]
    assert ids(drop_replayed(seen, "id", offset="v")) == ids(seen)
    empty = seen.unionByName(numbers(spark, [None]))
    assert drop_replayed(empty, "id", offset="v", cursors=[15]).count() == 6
    assert OffsetType.of(df, "V").kind == "integer"
