"""Native streams and replays."""

from pyspark.sql import functions as F

from rangeload.catalog.registry import query, table
from rangeload.operators.ranges import range_scan
from rangeload.operators.replay import drop_replayed, replay_from
from rangeload.operators.stats import offset_stats
from rangeload.options import LoadOptions
from rangeload.plans.offsets import OffsetType
from rangeload.session import scratch_dir
from rangeload.streaming.streams import drop_replayed_stream, load_once, read_stream, stream_progress, stream_table


def _streamed(spark, folder, fmt="parquet", **narrow):
    """Load ``events`` through a stream; returns the rows read back and the query."""
    schema = table(spark, folder, "events").schema
    rows = read_stream(spark, f"{folder}/events.parquet", schema, max_files=1000, **narrow)
    root = scratch_dir(spark, "stream")
    done = load_once(rows, f"{root}/out", f"{root}/checkpoint", fmt)
    return spark.read.schema(rows.schema).format(fmt).load(f"{root}/out"), done


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def stream_load_once(spark, folder):
    return _streamed(spark, folder, columns=["event_id", "ts", "value"], where="event_type = 'click'")[0]


@query("SELECT * FROM events WHERE value > 10")
def stream_json_sink(spark, folder):
    schema = table(spark, folder, "events").schema
    rows = read_stream(spark, f"{folder}/events.parquet", schema, where="value > 10")
    root = scratch_dir(spark, "stream")
    load_once(rows, f"{root}/out", f"{root}/checkpoint", "json")
    return (
        spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/out")
    )


@query("SELECT event_id FROM events WHERE value < 0")
def stream_empty(spark, folder):
    return _streamed(spark, folder, columns=["event_id"], where="value < 0")[0]


def _in_files(spark, folder, parts, copies=1):
    """``events`` as a folder of files, with several copies of each row in files of their own."""
    path = f"{scratch_dir(spark, 'files')}/events"
    for _ in range(copies):
        table(spark, folder, "events").repartition(parts, "event_id").write.mode("append").parquet(path)
    return path


@query("SELECT count(*) AS rows FROM events")
def stream_progress_rows(spark, folder):
    """Eight micro-batches, of which Spark itself remembers two."""
    schema = table(spark, folder, "events").schema
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        root = scratch_dir(spark, "stream")
        rows = read_stream(spark, _in_files(spark, folder, 8), schema, max_files=1)
        done = load_once(rows, f"{root}/out", f"{root}/checkpoint")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    return stream_progress(spark, done).agg(F.sum("rows").alias("rows"))


@query("SELECT event_id, ts FROM events")
def stream_drop_replayed(spark, folder):
    """Every row comes twice, in different micro-batches."""
    schema = table(spark, folder, "events").schema
    rows = read_stream(spark, _in_files(spark, folder, 2, copies=2), schema, ["event_id", "ts"], max_files=1)
    root = scratch_dir(spark, "stream")
    load_once(drop_replayed_stream(rows, ["event_id"], "1 hour"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@query(
    "SELECT event_id, ts FROM events, (SELECT min(event_id) + 10 AS low, max(event_id) - 10 AS high FROM events) "
    "WHERE event_type <> 'error' AND event_id BETWEEN low AND high"
)
def stream_by_options(spark, folder):
    """Deleted rows and both bounds are left out as the options say."""
    events = table(spark, folder, "events")
    stats = offset_stats(events, "event_id")
    options = LoadOptions(
        "event_id", str(stats.first + 10), str(stats.last - 10), include_deleted=False, load_available=True
    )
    root = scratch_dir(spark, "stream")
    path = f"{folder}/events.parquet"
    stream_table(
        spark, path, events.schema, root, options, ["event_id", "ts"], deleted="event_type = 'error'"
    ).awaitTermination()
    return spark.read.schema(events.select("event_id", "ts").schema).parquet(f"{root}/data")


def _replayed(spark, folder, delivery):
    """The first half, then the whole again from the last offset that was seen."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    kind = OffsetType.of(events, "ts")
    whole = range_scan(events, "ts", 1).ranges[0]
    first = events.where(F.col("ts") <= kind.literal((whole.lower + whole.upper) // 2))
    cursor = kind.to_python(offset_stats(first, "ts").last)
    return first.unionByName(replay_from(events, "ts", whole, cursor, delivery)), cursor


_HALVES = """
WITH b AS (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS middle FROM events),
c AS (SELECT max(ts) AS seen FROM events, b WHERE ts <= middle)
SELECT event_id, ts, value FROM events, c WHERE ts <= seen
UNION ALL SELECT event_id, ts, value FROM events, c WHERE ts {op} seen
"""


@query(_HALVES.format(op=">="))
def replay_at_least_once(spark, folder):
    return _replayed(spark, folder, "at_least_once")[0]


@query(_HALVES.format(op=">"))
def replay_at_most_once(spark, folder):
    return _replayed(spark, folder, "at_most_once")[0]


@query("SELECT event_id, ts, value FROM events")
def replay_dedup(spark, folder):
    rows, _ = _replayed(spark, folder, "at_least_once")
    return drop_replayed(rows, "event_id")


@query("SELECT event_id, ts, value FROM events")
def replay_dedup_at_cursor(spark, folder):
    rows, cursor = _replayed(spark, folder, "at_least_once")
    return drop_replayed(rows, "event_id", offset="ts", cursors=[cursor])
