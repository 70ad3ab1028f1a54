"""Native file streams: load once, keep polling, drop replayed rows."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rangeload.operators.filters import all_of, as_column
from rangeload.operators.scan import scan
from rangeload.options import LoadOptions
from rangeload.plans.offsets import OffsetType
from rangeload.sources.sinks import TEXT_TIMES
from rangeload.streaming.state import StateFiles


def _globbed(path: str) -> str:
    """The same path as a pattern, since a stream takes a lone file only so."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    where: Column | str | Sequence[Column | str] = (),
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream of a file or folder; ``max_files`` or ``max_bytes`` cap a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return scan(reader.load(_globbed(path)), columns, where)


# State on the executors' disks, of which each batch uploads what it changed.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _large_state(spark: SparkSession):
    """The settings of ``LARGE_STATE`` for a query that is started inside, where the session has none of its own.

    A query keeps the settings it was started with, and one that goes on those in its checkpoint.
    """
    given = spark.conf.getAll
    own = [name for name in LARGE_STATE if name not in given]
    for name in own:
        spark.conf.set(name, LARGE_STATE[name])
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def start_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    poll_interval_ms: int | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append the stream to files.

    Without an interval all that is available is loaded and the query ends,
    else it keeps polling. Progress is recorded from the start, in the checkpoint folder, where
    it outlives the driver. State, as of ``drop_replayed_stream``, is on the executors' disks and not in their memory, unless the
    session names another state store.
    """
    listener = session_progress(rows.sparkSession)
    writer = rows.writeStream.outputMode("append").format(fmt)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if fmt in ("json", "csv"):
        writer = writer.options(**TEXT_TIMES)
    if query_name:
        writer = writer.queryName(query_name)
    if poll_interval_ms is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{poll_interval_ms} milliseconds")
    with _large_state(rows.sparkSession):
        query = writer.start()
    listener.keep(query, BatchTable(rows.sparkSession, checkpoint))
    return query


def load_once(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Load all that is available and wait for the end."""
    query = start_stream(rows, path, checkpoint, fmt)
    query.awaitTermination()
    return query


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    root: str,
    options: LoadOptions,
    columns: Sequence[str] | None = None,
    where: Column | str | Sequence[Column | str] = (),
    fmt: str = "parquet",
    deleted: Column | str | None = None,
) -> StreamingQuery:
    """Stream a folder of files into ``root/data`` as the options say: once over
    what is there, or on and on with a poll per interval.

    Both bounds and ``include_deleted`` narrow the rows; ``deleted`` is the condition
    that marks deleted ones. A file stream has neither ranges nor another reader, so
    options that ask for these are refused.
    """
    if options.reader is not None or options.num_ranges != 1:
        raise ValueError("A stream of files has no ranges and no reader of its own; use IncrementalLoader")
    if not options.include_deleted and deleted is None:
        raise ValueError("include_deleted=False needs the condition that marks deleted rows")
    conditions = [where] if isinstance(where, (Column, str)) else list(where)
    if not options.include_deleted:
        conditions.append(~as_column(deleted))
    offset = F.col(options.offset_column)
    kind = OffsetType.of(spark.createDataFrame([], schema), options.offset_column)
    if options.initial_offset is not None:
        conditions.append(offset >= kind.literal(kind.parse(options.initial_offset)))
    if options.end_offset is not None:
        conditions.append(offset <= kind.literal(kind.parse(options.end_offset)))
    rows = read_stream(spark, path, schema, columns, [] if not conditions else all_of(conditions), max_files=options.max_batches)
    interval = None if options.load_available else options.poll_interval_ms
    return start_stream(rows, f"{root}/data", f"{root}/checkpoint", fmt, interval, options.query_name)


def drop_replayed_stream(rows: DataFrame, keys: Sequence[str], delay: str, spread: int = 16) -> DataFrame:
    """One row per key, for repeats that arrive within ``delay`` of each other.

    What counts is when a row arrives, not a time it carries: no row is late, so a row
    whose key is new is never dropped, however old it is, while the state holds only
    the keys of the last ``delay``. Rows that are replayed after a restart meet the
    state as it was when the stream stopped.

    Repeats are first dropped within ``spread`` groups of input tasks, so that a
    key with very many of them sends only a few rows to the task that owns it.
    """
    names = rows.columns
    # one hidden struct, so that no column of the rows is in its way
    hidden = "__arrival"
    while hidden in names:
        hidden += "_"
    timed = rows.withColumn(hidden, F.current_timestamp()).withColumn(f"{hidden}_group", F.spark_partition_id() % spread)
    timed = timed.withWatermark(hidden, delay)
    once = timed.dropDuplicatesWithinWatermark([*keys, f"{hidden}_group"])
    return once.dropDuplicatesWithinWatermark(list(keys)).select(*[F.col(f"`{name}`") for name in names])


# States of a stream.
STARTING, PROCESSING, WAITING, FINISHED, FAILED = "STARTING", "PROCESSING_DATA", "WAITING_DATA", "FINISHED", "FAILED"


class BatchTable:
    """The micro-batches of one query, beside its checkpoint: a document for each, and then one for every hundred."""

    # How many micro-batches share a document, and the columns of the table.
    MANY = 100
    BATCH = "query_id string, query_name string, batch_id bigint, at string, rows bigint, took_ms bigint"

    def __init__(self, spark: SparkSession, checkpoint: str):
        self._spark, self._folder = spark, f"{checkpoint.rstrip('/')}/batches"
        self._documents = StateFiles(spark, self._folder)
        self._single = self._documents.numbers("one")

    def append(self, batch: dict) -> None:
        """Add a batch; one that was run again replaces what it was."""
        number = batch["batch_id"]
        self._documents.write("one", number, batch, replace=True)
        self._single = [n for n in self._single if n != number] + [number]
        if len(self._single) >= self.MANY:
            several = [self._documents.read("one", n) for n in self._single]
            self._documents.write("many", number, {"batches": several}, replace=True)
            for n in self._single:
                self._documents.remove(self._documents.path("one", n))
            self._single = []

    def read(self) -> DataFrame:
        """One row for each batch."""
        found = self._spark.createDataFrame([], self.BATCH)
        if self._documents.numbers("one"):
            found = found.union(self._spark.read.schema(self.BATCH).json(f"{self._folder}/one/*.json"))
        if self._documents.numbers("many"):
            several = self._spark.read.schema(f"batches array<struct<{self.BATCH}>>").json(f"{self._folder}/many/*.json")
            found = found.union(several.select(F.explode("batches").alias("b")).select("b.*"))
        return found.dropDuplicates(["query_id", "batch_id"]).withColumn("at", F.col("at").cast("timestamp"))


class ProgressListener(StreamingQueryListener):
    """State and totals of every stream of the session, by query id.

    Register with ``spark.streams.addListener``. Totals are summed as batches end, so
    they are whole however many there were. Batches go to the table that ``keep`` names; until then, and for
    streams without one, they are held here.
    """

    def __init__(self):
        self.queries: dict[str, dict] = {}
        self.batches: dict[str, list[dict]] = {}
        self.tables: dict[str, BatchTable] = {}
        self._changed = threading.Condition()

    def keep(self, query: StreamingQuery, table: BatchTable) -> None:
        """Append the batches of ``query`` to ``table``, also those that ended already."""
        with self._changed:
            self.tables[str(query.id)] = table
            for batch in self.batches.pop(str(query.id), []):
                table.append(batch)

    def _record(self, batch: dict) -> None:
        if batch["query_id"] in self.tables:
            self.tables[batch["query_id"]].append(batch)
        else:
            self.batches.setdefault(batch["query_id"], []).append(batch)

    def _seen(self, query_id: str, name: str | None) -> dict:
        return self.queries.setdefault(query_id, {"name": name, "status": STARTING, "rows": 0, "batches": 0, "last_batch": -1})

    def onQueryStarted(self, event):
        with self._changed:
            self._seen(str(event.id), event.name)["status"] = STARTING
            self._changed.notify_all()

    def onQueryProgress(self, event):
        progress = event.progress
        with self._changed:
            seen = self._seen(str(progress.id), progress.name)
            seen["status"] = PROCESSING if progress.numInputRows else WAITING
            seen["rows"] += progress.numInputRows
            seen["batches"] += 1 if progress.numInputRows else 0
            seen["last_batch"] = progress.batchId
            if progress.numInputRows:
                told = (str(progress.id), progress.name, progress.batchId, progress.timestamp, progress.numInputRows, progress.batchDuration)
                self._record(dict(zip(("query_id", "query_name", "batch_id", "at", "rows", "took_ms"), told, strict=True)))
            self._changed.notify_all()

    def onQueryIdle(self, event):
        with self._changed:
            self._seen(str(event.id), None)["status"] = WAITING

    def onQueryTerminated(self, event):
        with self._changed:
            self._seen(str(event.id), None)["status"] = FAILED if event.exception else FINISHED
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all that the query has done so far was heard of; events come a little later."""
        last = query.lastProgress
        heard = last["batchId"] if last else -1

        def caught_up() -> bool:
            seen = self.queries.get(str(query.id))
            if seen is None:
                return False
            return seen["last_batch"] >= heard if query.isActive else seen["status"] in (FINISHED, FAILED)

        with self._changed:
            if not self._changed.wait_for(caught_up, seconds):
                raise TimeoutError(f"no end of the progress of query {query.id} after {seconds} seconds")


_LISTENERS: WeakKeyDictionary[SparkSession, ProgressListener] = WeakKeyDictionary()


def session_progress(spark: SparkSession) -> ProgressListener:
    """The listener that hears of all streams of the session from now on."""
    if spark not in _LISTENERS:
        _LISTENERS[spark] = ProgressListener()
        spark.streams.addListener(_LISTENERS[spark])
    return _LISTENERS[spark]


def stream_progress(spark: SparkSession, query: StreamingQuery | str) -> DataFrame:
    """Micro-batches with rows of a query that ``start_stream`` began: rows and time of every one.

    For a query that another driver ran, or that has ended, its checkpoint folder is given.
    """
    if isinstance(query, str):
        return BatchTable(spark, query).read()
    listener = session_progress(spark)
    listener.wait_for(query)
    return listener.tables[str(query.id)].read()
