"""Incremental loads; the result is what landed in the sink."""

from pyspark.sql import functions as F

from rangeload.catalog.registry import query, table
from rangeload.operators.stats import offset_stats
from rangeload.options import LoadOptions
from rangeload.plans.bounds import OffsetRange
from rangeload.plans.histogram import quantile_cuts
from rangeload.plans.offsets import OffsetType
from rangeload.session import scratch_dir
from rangeload.streaming.incremental import IncrementalLoader


def _loader(spark, source, offset, root=None, ranges=3, share=12, rows=None, **narrow):
    """A loader whose cap is a share of the table, so steps do not grow with it."""
    if rows is None:
        rows = offset_stats(source, offset).rows
    options = LoadOptions(offset, num_ranges=ranges, max_records=max(1, rows // share))
    return IncrementalLoader(spark, source, root or scratch_dir(spark, "load"), options, **narrow)


def _middle(df, offset):
    """An offset with two thirds of the rows at or below it, as a literal."""
    kind = OffsetType.of(df, offset)
    stats = offset_stats(df, offset)
    whole = OffsetRange(0, stats.first, stats.last)
    return kind.literal(quantile_cuts(df, offset, whole, 3)[1])


@query("SELECT * FROM events")
def incremental_capped(spark, folder):
    loader = _loader(spark, table(spark, folder, "events"), "ts")
    loader.load_available()
    return loader.output()


@query("SELECT event_id, value FROM events WHERE event_type <> 'view'")
def incremental_rebalance(spark, folder):
    """Skewed values: most ranges end early and the fullest is split again."""
    events = table(spark, folder, "events")
    loader = _loader(
        spark, events, "value", ranges=4, where="event_type <> 'view'", columns=["event_id", "value"]
    )
    loader.load_available()
    return loader.output()


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def incremental_ties(spark, folder):
    """Seven offsets in all, each on a large share of the rows."""
    lines = table(spark, folder, "lineitem")
    loader = _loader(spark, lines, "l_linenumber", columns=["l_orderkey", "l_linenumber", "l_quantity"])
    loader.load_available()
    return loader.output()


@query("SELECT event_id, user_id FROM events")
def incremental_poll_new(spark, folder):
    """Two thirds are there at first; polling finds the rest. The offset column
    is not among the selected ones."""
    events = table(spark, folder, "events")
    first = F.col("ts") <= _middle(events, "ts")
    grown = []

    def reader(_, predicate):
        rows = events if grown else events.where(first)
        return rows if predicate is None else rows.where(predicate)

    rows = offset_stats(events, "ts").rows
    loader = _loader(spark, reader, "ts", rows=rows, share=4, columns=["event_id", "user_id"])
    loader.load_available()
    grown.append(True)
    loader.poll()
    loader.load_available()
    return loader.output()


@query("SELECT * FROM orders")
def incremental_poll_files(spark, folder):
    """A folder that gains files while it is loaded; polls open only the new ones."""
    orders = table(spark, folder, "orders")
    path = f"{scratch_dir(spark, 'files')}/orders"
    middle = _middle(orders, "o_orderkey")
    orders.where(F.col("o_orderkey") <= middle).write.parquet(path)
    loader = _loader(spark, path, "o_orderkey", rows=orders.count(), share=4)
    loader.load_available()
    orders.where(F.col("o_orderkey") > middle).write.mode("append").parquet(path)
    loader.run(max_polls=1)
    return loader.output()


@query("SELECT * FROM orders")
def incremental_restart(spark, folder):
    """Stopped after a step with ranges open; a new loader goes on."""
    orders = table(spark, folder, "orders")
    root = scratch_dir(spark, "load")
    _loader(spark, orders, "o_orderkey", root).step()
    again = _loader(spark, orders, "o_orderkey", root)
    again.load_available()
    return again.output()


@query("SELECT * FROM events")
def incremental_restart_idle(spark, folder):
    """Stopped with nothing left to load; a new loader polls and finds more."""
    events = table(spark, folder, "events")
    root = scratch_dir(spark, "load")
    _loader(spark, events.where(F.col("event_id") <= _middle(events, "event_id")), "event_id", root, share=2).load_available()
    again = _loader(spark, events, "event_id", root, share=2)
    again.run(max_polls=1)
    return again.output()


@query("SELECT * FROM customer")
def incremental_by_string(spark, folder):
    """Text offsets: one range, cut all the same, then polled."""
    customer = table(spark, folder, "customer")
    root = scratch_dir(spark, "load")
    first = customer.where(F.col("c_name") <= _middle(customer, "c_name"))
    _loader(spark, first, "c_name", root, share=3).load_available()
    again = _loader(spark, customer, "c_name", root, share=3)
    again.run(max_polls=1)
    return again.output()


@query("SELECT event_id, ts, value FROM events WHERE value >= 20")
def incremental_custom_reader(spark, folder):
    """The reader applies the range itself and adds a filter of its own."""

    def reader(session, predicate):
        rows = session.read.parquet(f"{folder}/events.parquet").where("value >= 20")
        return rows if predicate is None else rows.where(predicate)

    rows = offset_stats(reader(spark, None), "ts").rows
    loader = _loader(spark, reader, "ts", rows=rows, share=6, columns=["event_id", "ts", "value"])
    loader.load_available()
    return loader.output()


@query("SELECT count(*) AS rows, max(ts) AS last_offset FROM events")
def incremental_progress(spark, folder):
    loader = _loader(spark, table(spark, folder, "events"), "ts", share=6)
    loader.load_available()
    return loader.progress().agg(F.sum("rows").alias("rows"), F.max("cursor").alias("last_offset"))
