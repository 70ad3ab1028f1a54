"""Order, limits, offsets and counts."""

from pyspark.sql import functions as F

from rangeload.catalog.registry import query, table
from rangeload.functions.durations import format_duration
from rangeload.operators.ordering import order_output, top_k
from rangeload.operators.stats import count_new, first_last, first_last_of_files
from rangeload.plans.offsets import OffsetType


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM lineitem ORDER BY l_returnflag, l_shipdate")
def order_by_user_then_offset(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return order_output(lines, ["l_returnflag"], "l_shipdate")


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id LIMIT 100")
def top_k_by_offset(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return top_k(events, 100, F.col("ts").desc(), "event_id")


@query("SELECT min(ts) AS first_offset, max(ts) AS last_offset FROM events")
def first_last_offset(spark, folder):
    return first_last(table(spark, folder, "events"), "ts")


@query("SELECT min(event_id) AS first_offset, max(event_id) AS last_offset FROM events")
def first_last_offset_of_files(spark, folder):
    """From the footers of the files."""
    return first_last_of_files(spark, f"{folder}/events.parquet", "event_id")


@query("""
SELECT count(*) FILTER (WHERE event_type = 'click') AS new_rows, max(ts) AS last_offset
FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
""")
def count_new_rows(spark, folder):
    events = table(spark, folder, "events")
    return count_new(events, "ts", OffsetType.of(events, "ts").parse("2024-01-20"), "event_type = 'click'")


@query("SELECT count(*) AS rows FROM lineitem")
def count_rows(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_count(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("rows"))


@query("""
WITH spans AS (
  SELECT event_type, epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 AS ms
  FROM events GROUP BY event_type
)
SELECT event_type, ms,
  CASE WHEN ms >= 86400000 THEN (ms // 86400000) || 'd ' ELSE '' END
  || CASE WHEN ms >= 3600000 THEN (ms // 3600000 % 24) || 'h ' ELSE '' END
  || CASE WHEN ms >= 60000 THEN (ms // 60000 % 60) || 'min ' ELSE '' END
  || CASE WHEN ms >= 1000 THEN (ms // 1000 % 60) || 'sec ' ELSE '' END
  || (ms % 1000) || 'millis' AS took,
  CASE WHEN ms >= 3600000 THEN (ms // 3600000) || 'h ' ELSE '' END
  || CASE WHEN ms >= 60000
     THEN (CASE WHEN ms >= 3600000 THEN ms // 60000 % 60 ELSE ms // 60000 END) || 'min ' ELSE '' END
  || (ms // 1000 % 60) || 'sec' AS took_hours
FROM spans
""")
def progress_duration(spark, folder):
    spans = (
        table(spark, folder, "events")
        .groupBy("event_type")
        .agg(F.min("ts").cast("timestamp").alias("first"), F.max("ts").cast("timestamp").alias("last"))
        .select("event_type", (F.unix_millis("last") - F.unix_millis("first")).alias("ms"))
    )
    return spans.select(
        "event_type",
        "ms",
        format_duration(F.col("ms")).alias("took"),
        format_duration(F.col("ms"), ("h", "min", "sec")).alias("took_hours"),
    )
