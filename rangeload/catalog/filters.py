"""Every predicate a scan takes."""

from pyspark.sql import functions as F

from rangeload.catalog.registry import query, table
from rangeload.operators.filters import apply_filters
from rangeload.plans.offsets import OffsetType


def _events(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", "ts", F.expr("nullif(event_type, 'view')").alias("kind"), "value", "props"
    )


_FROM = "SELECT event_id, kind FROM (SELECT *, nullif(event_type, 'view') AS kind FROM events)"


def _keep(spark, folder, *conditions):
    return apply_filters(_events(spark, folder), *conditions).select("event_id", "kind")


@query(f"{_FROM} WHERE kind = 'click'")
def filter_eq(spark, folder):
    return _keep(spark, folder, F.col("kind") == "click")


@query(f"{_FROM} WHERE kind IS DISTINCT FROM 'click'")
def filter_eq_null_safe(spark, folder):
    return _keep(spark, folder, ~F.col("kind").eqNullSafe("click"))


@query(f"""{_FROM} WHERE value < 400 AND value > 5
AND ts <= TIMESTAMP '2024-01-28 00:00:00' AND ts >= TIMESTAMP '2024-01-02 00:00:00'""")
def filter_range_ops(spark, folder):
    value, ts = F.col("value"), F.col("ts")
    low, high = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-02", "2024-01-28"))
    return _keep(spark, folder, value < 400, value > 5, ts <= high, ts >= low)


@query(f"{_FROM} WHERE kind IS NULL")
def filter_is_null(spark, folder):
    return _keep(spark, folder, F.col("kind").isNull())


@query(f"{_FROM} WHERE kind IS NOT NULL")
def filter_is_not_null(spark, folder):
    return _keep(spark, folder, F.col("kind").isNotNull())


@query(f"{_FROM} WHERE starts_with(kind, 'pur')")
def filter_prefix(spark, folder):
    return _keep(spark, folder, F.col("kind").startswith("pur"))


@query(f"{_FROM} WHERE ends_with(kind, 'up')")
def filter_suffix(spark, folder):
    return _keep(spark, folder, F.col("kind").endswith("up"))


@query(f"""{_FROM} WHERE contains(props, '"k": 4')""")
def filter_contains(spark, folder):
    return _keep(spark, folder, F.col("props").contains('"k": 4'))


@query(f"{_FROM} WHERE kind IN ('click', 'error')")
def filter_in(spark, folder):
    return _keep(spark, folder, F.col("kind").isin("click", "error"))


@query(f"{_FROM} WHERE FALSE")
def filter_in_empty(spark, folder):
    return _keep(spark, folder, F.col("kind").isin([]))


@query(f"{_FROM} WHERE NOT (kind = 'click')")
def filter_not(spark, folder):
    return _keep(spark, folder, ~(F.col("kind") == "click"))


@query(f"{_FROM} WHERE kind = 'click' OR value >= 100")
def filter_or(spark, folder):
    return _keep(spark, folder, (F.col("kind") == "click") | (F.col("value") >= 100))


@query(f"{_FROM} WHERE kind = 'click' AND value >= 100")
def filter_and(spark, folder):
    return _keep(spark, folder, (F.col("kind") == "click") & (F.col("value") >= 100))


@query(f"""{_FROM} WHERE (kind = 'click' OR kind = 'error') AND value > 20
AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-25 00:00:00'""")
def filter_conjunction(spark, folder):
    events = _events(spark, folder)
    ts = OffsetType.of(events, "ts")
    window = (F.col("ts") >= ts.literal(ts.parse("2024-01-05"))) & (F.col("ts") < ts.literal(ts.parse("2024-01-25")))
    return apply_filters(events, "kind = 'click' OR kind = 'error'", F.col("value") > 20, window).select(
        "event_id", "kind"
    )


@query(f"{_FROM} WHERE ts < TIMESTAMP '2024-01-15 12:34:56.789012'")
def filter_timestamp_literal(spark, folder):
    events = _events(spark, folder)
    ts = OffsetType.of(events, "ts")
    bound = ts.literal(ts.parse("2024-01-15T12:34:56.789012Z"))
    return apply_filters(events, F.col("ts") < bound).select("event_id", "kind")


@query(f"{_FROM} WHERE length(props) > 8 AND value > 10")
def filter_left_to_spark(spark, folder):
    return _keep(spark, folder, F.length("props") > 8, F.col("value") > 10)
