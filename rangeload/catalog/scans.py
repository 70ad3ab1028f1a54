"""Scans, schemas, casts and batch sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeload.catalog.registry import query, table
from rangeload.functions.casts import format_iso_timestamp, parse_iso_timestamp, utc_clock
from rangeload.operators.conform import apply_schema, conform, drop_compound
from rangeload.operators.scan import scan
from rangeload.session import scratch_dir
from rangeload.sources.sinks import read_csv, write_csv, write_parquet
from rangeload.sources.tables import load, read_table, typed_load

# What marks a deleted row in the test tables.
DELETED = "event_type = 'error'"


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'purchase' AND value > 50")
def scan_select_where(spark, folder):
    events = table(spark, folder, "events")
    return scan(events, ["event_id", "ts", "value"], ["event_type = 'purchase'", "value > 50"])


@query("SELECT * FROM orders")
def scan_all(spark, folder):
    return scan(table(spark, folder, "orders"), ["*"])


@query("SELECT * FROM customer")
def scan_bare_table(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("rangeload_customer")
    return load(spark, "rangeload_customer")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000")
def scan_query_text(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("rangeload_orders")
    return load(
        spark,
        "SELECT o_orderkey, o_totalprice FROM rangeload_orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000",
    )


@query("SELECT event_id, ts FROM events WHERE value < 0")
def scan_empty(spark, folder):
    return scan(table(spark, folder, "events"), ["event_id", "ts"], "value < 0")


@query("SELECT event_id, event_type FROM events")
def include_deleted(spark, folder):
    return scan(table(spark, folder, "events"), ["event_id", "event_type"], include_deleted=True, deleted=DELETED)


@query("SELECT event_id, event_type FROM events WHERE NOT (event_type = 'error')")
def exclude_deleted(spark, folder):
    return scan(table(spark, folder, "events"), ["event_id", "event_type"], include_deleted=False, deleted=DELETED)


@query("SELECT event_id, event_type FROM events")
def prune_columns(spark, folder):
    return scan(table(spark, folder, "events")).select("event_id", "event_type")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
def prune_keeps_offset_filter(spark, folder):
    return scan(table(spark, folder, "events"), ["event_id"], "ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")


_DECLARED = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query("SELECT event_type, CAST(NULL AS INTEGER) AS age, event_id, value FROM events")
def apply_schema_null_fill(spark, folder):
    return apply_schema(table(spark, folder, "events"), _DECLARED)


@query("SELECT event_id, CAST(NULL AS INTEGER) AS age FROM events")
def apply_schema_then_select(spark, folder):
    return apply_schema(table(spark, folder, "events"), _DECLARED).select("event_id", "age")


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def conform_to_record_type(spark, folder):
    record = T.StructType(
        [
            T.StructField("p_partkey", T.LongType(), False),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    )
    return conform(table(spark, folder, "part"), record)


@query("SELECT vec_id, label FROM embeddings", name="drop_compound")
def drop_compound_columns(spark, folder):
    return drop_compound(table(spark, folder, "embeddings"))


@query("""
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice AS price,
       o_totalprice, o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS day,
       o_orderstatus = 'O' AS open, CAST(NULL AS VARCHAR) AS remark
FROM orders
""", name="typed_load")
def typed_load_from_text(spark, folder):
    orders = table(spark, folder, "orders")
    text = orders.select(
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.format_number("o_totalprice", 2).alias("price"),
        F.col("o_totalprice").cast("string"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")).alias("o_orderdate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        (F.col("o_orderstatus") == "O").cast("string").alias("open"),
    )
    declared = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.IntegerType()),
            T.StructField("price", T.DecimalType(18, 2)),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampType()),
            T.StructField("day", T.DateType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("remark", T.StringType()),
        ]
    )
    typed = typed_load(text, declared)
    # Plain result types, so that the comparison is exact.
    return typed.withColumns(
        {
            "price": F.col("price").cast("double"),
            "o_orderdate": utc_clock(F.col("o_orderdate")),
            "day": F.col("day").cast("string"),
        }
    )


@query("SELECT event_id, ts FROM events")
def cast_iso_timestamp(spark, folder):
    events = table(spark, folder, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.select("event_id", utc_clock(parse_iso_timestamp(text)).alias("ts"))


@query("SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def cast_iso_timestamp_seconds(spark, folder):
    events = table(spark, folder, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.select("event_id", utc_clock(parse_iso_timestamp(text, True)).alias("ts"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts_text FROM events", name="format_iso_timestamp")
def format_iso_timestamp_text(spark, folder):
    return table(spark, folder, "events").select("event_id", format_iso_timestamp(F.col("ts")).alias("ts_text"))


@query("SELECT * FROM events")
def sink_parquet_roundtrip(spark, folder):
    events = table(spark, folder, "events")
    path = f"{scratch_dir(spark, 'parquet')}/out"
    write_parquet(events, path)
    return read_table(spark, path, schema=events.schema)


@query("SELECT event_id, ts, user_id, nullif(event_type, 'view') AS event_type, value, props FROM events")
def sink_csv_roundtrip(spark, folder):
    events = table(spark, folder, "events").withColumn("event_type", F.expr("nullif(event_type, 'view')"))
    path = f"{scratch_dir(spark, 'csv')}/out"
    write_csv(events, path)
    return read_csv(spark, path, events.schema)
