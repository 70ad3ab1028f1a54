"""Range splits and range scans."""

from dataclasses import replace

from pyspark.sql import functions as F

from rangeload.catalog.registry import query, table
from rangeload.operators.ranges import quantile_ranges, range_scan, ranges_frame
from rangeload.operators.stats import count_new, offset_stats
from rangeload.plans.bounds import planned_ranges, rebuild_ranges, recreate_ranges, split_range
from rangeload.plans.offsets import OffsetType


def _bounds_sql(tbl, column, n, lower, upper, lo_op=">="):
    """SQL of ``n`` ranges; ``lower`` and ``upper`` are expressions in lo, hi and i."""
    return f"""
    WITH b AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {tbl})
    SELECT CAST(i AS INTEGER) AS range_id, {lower} AS lower,
           CASE WHEN i = {n - 1} THEN hi ELSE {upper} END AS upper,
           CASE WHEN i = 0 THEN '{lo_op}' ELSE '>=' END AS lo_op,
           CASE WHEN i = {n - 1} THEN '<=' ELSE '<' END AS hi_op
    FROM b, range({n}) r(i)
    """


@query(_bounds_sql("events", "event_id", 7, "lo + (hi - lo) // 7 * i", "lo + (hi - lo) // 7 * (i + 1)"))
def bounds_int(spark, folder):
    return range_scan(table(spark, folder, "events"), "event_id", 7).frame(spark)


@query(_bounds_sql("events", "value", 5, "lo + ((hi - lo) / 5) * i", "lo + ((hi - lo) / 5) * (i + 1)"))
def bounds_double(spark, folder):
    return range_scan(table(spark, folder, "events"), "value", 5).frame(spark)


def _micros(i, n):
    return f"make_timestamp(epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) // {n} * {i})"


@query(_bounds_sql("events", "ts", 4, _micros("i", 4), _micros("(i + 1)", 4)))
def bounds_timestamp(spark, folder):
    return range_scan(table(spark, folder, "events"), "ts", 4).frame(spark)


@query(_bounds_sql("customer", "c_name", 1, "lo", "hi"))
def bounds_string_single(spark, folder):
    return range_scan(table(spark, folder, "customer"), "c_name", 6).frame(spark)


@query("""
WITH ranked AS (SELECT value, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM events),
cuts AS (
  SELECT value AS edge FROM ranked, range(1, 8) r(i) WHERE rn = (i * n + 7) // 8
  UNION SELECT min(value) FROM events UNION SELECT max(value) FROM events
),
numbered AS (SELECT edge, lead(edge) OVER (ORDER BY edge) AS following, row_number() OVER (ORDER BY edge) - 1 AS i FROM cuts)
SELECT CAST(i AS INTEGER) AS range_id, edge AS lower, following AS upper, '>=' AS lo_op,
       CASE WHEN i = (SELECT max(i) FROM numbered WHERE following IS NOT NULL) THEN '<=' ELSE '<' END AS hi_op
FROM numbered WHERE following IS NOT NULL
""")
def bounds_quantile(spark, folder):
    return quantile_ranges(table(spark, folder, "events"), "value", 8, tolerance=0.0).frame(spark)


@query(_bounds_sql("orders", "o_orderkey", 3, "lo + (hi - lo) // 3 * i", "lo + (hi - lo) // 3 * (i + 1)", ">"))
def ranges_with_ops(spark, folder):
    orders = table(spark, folder, "orders")
    kind = OffsetType.of(orders, "o_orderkey")
    stats = offset_stats(orders, "o_orderkey")
    return ranges_frame(spark, split_range(stats.first, stats.last, 3, kind, lo_op=">"), kind)


@query("""
WITH b AS (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // 7 AS step FROM events)
SELECT event_id, event_type, CAST(least(6, (event_id - lo) // step) AS INTEGER) AS range_id
FROM events, b WHERE event_type = 'click'
""")
def range_scan_int(spark, folder):
    events = table(spark, folder, "events")
    found = range_scan(events, "event_id", 7, where="event_type = 'click'")
    return found.rows().select("event_id", "event_type", "range_id")


@query("""
WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 5 AS step FROM events)
SELECT event_id, value, CAST(
  (value >= lo + step * 1)::INT + (value >= lo + step * 2)::INT
  + (value >= lo + step * 3)::INT + (value >= lo + step * 4)::INT AS INTEGER) AS range_id
FROM events, b
""")
def range_scan_double(spark, folder):
    found = range_scan(table(spark, folder, "events"), "value", 5)
    return found.rows().select("event_id", "value", "range_id")


@query("""
WITH b AS (
  SELECT epoch_us(min(ts)) AS lo, (epoch_us(max(ts)) - epoch_us(min(ts))) // 4 AS step FROM events
)
SELECT event_id, ts, event_type, value, CAST(least(3, (epoch_us(ts) - lo) // step) AS INTEGER) AS range_id
FROM events, b WHERE event_type = 'purchase'
""")
def range_scan_timestamp(spark, folder):
    events = table(spark, folder, "events")
    found = range_scan(events, "ts", 4, where="event_type = 'purchase'")
    return found.rows().select("event_id", "ts", "event_type", "value", "range_id")


@query("""
WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 100 AS step FROM orders),
edges AS (SELECT i, lo + step * i AS edge FROM b, range(1, 100) r(i))
SELECT o_orderkey, o_totalprice, CAST(coalesce(max(i), 0) AS INTEGER) AS range_id
FROM orders LEFT JOIN edges ON o_totalprice >= edge GROUP BY o_orderkey, o_totalprice
""")
def range_scan_many(spark, folder):
    found = range_scan(table(spark, folder, "orders"), "o_totalprice", 100)
    return found.rows().select("o_orderkey", "o_totalprice", "range_id")


@query("""
WITH b AS (SELECT min(l_linenumber) AS lo, (max(l_linenumber) - min(l_linenumber)) // 3 AS step FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(least(2, (l_linenumber - lo) // step) AS INTEGER) AS range_id FROM lineitem, b
""")
def range_scan_ordered(spark, folder):
    found = range_scan(table(spark, folder, "lineitem"), "l_linenumber", 3)
    return found.ordered().select("l_orderkey", "l_linenumber", "range_id")


@query("""
WITH b AS (
  SELECT epoch_us(TIMESTAMP '1996-01-01 00:00:00') AS lo,
         (epoch_us(TIMESTAMP '2000-12-31 12:00:00') - epoch_us(TIMESTAMP '1996-01-01 00:00:00')) // 4 AS step
)
SELECT o_orderkey, o_orderdate, CAST(least(3, (epoch_us(o_orderdate) - lo) // step) AS INTEGER) AS range_id
FROM orders, b WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '2000-12-31 12:00:00'
""")
def bounded_scan(spark, folder):
    """Both bounds are given, so none is looked up."""
    orders = table(spark, folder, "orders")
    found = range_scan(orders, "o_orderdate", 4, lower="1996-01-01", upper="2000-12-31T12:00:00Z")
    return found.rows().select("o_orderkey", "o_orderdate", "range_id")


@query("""
WITH b AS (
  SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi, (epoch_us(max(ts)) - epoch_us(min(ts))) // 4 AS step
  FROM events
),
counted AS (
  SELECT least(3, (epoch_us(ts) - lo) // step) AS i, count(*) AS rows, max(ts) AS last_offset
  FROM events, b WHERE event_type = 'error' GROUP BY 1
)
SELECT CAST(r.i AS INTEGER) AS range_id, make_timestamp(lo + step * r.i) AS lower,
       CASE WHEN r.i = 3 THEN make_timestamp(hi) ELSE make_timestamp(lo + step * (r.i + 1)) END AS upper,
       coalesce(rows, 0) AS rows, last_offset
FROM b, range(4) r(i) LEFT JOIN counted ON counted.i = r.i
""")
def range_progress(spark, folder):
    return range_scan(table(spark, folder, "events"), "ts", 4, where="event_type = 'error'").progress()


@query("""
WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi, (max(event_id) - min(event_id)) // 4 AS s FROM events),
e AS (SELECT lo + 2 * s AS e0, lo + 2 * s + s // 2 AS e1, lo + 3 * s AS e2, hi, (hi - lo - 3 * s) // 3 AS t FROM b)
SELECT CAST(0 AS INTEGER) AS range_id, e0 AS lower, e1 AS upper, '>=' AS lo_op, '<' AS hi_op FROM e
UNION ALL SELECT 1, e1, e2, '>=', '<' FROM e
UNION ALL SELECT 2, e2, e2 + t, '>=', '<' FROM e
UNION ALL SELECT 3, e2 + t, e2 + t * 2, '>=', '<' FROM e
UNION ALL SELECT 4, e2 + t * 2, hi, '>=', '<=' FROM e
""", name="rebuild_ranges")
def rebuild_ranges_left(spark, folder):
    """The last two of four ranges, re-split into five."""
    events = table(spark, folder, "events")
    kind = OffsetType.of(events, "event_id")
    return ranges_frame(spark, rebuild_ranges(range_scan(events, "event_id", 4).ranges[2:], 5, kind), kind)


@query("""
WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
c AS (SELECT max(event_id) AS seen FROM events, b WHERE event_id <= lo + (hi - lo) * 5 // 6),
e AS (SELECT seen, hi, (hi - seen) // 3 AS t FROM b, c)
SELECT CAST(0 AS INTEGER) AS range_id, seen AS lower, seen + t AS upper, '>' AS lo_op, '<' AS hi_op FROM e
UNION ALL SELECT 1, seen + t, seen + t * 2, '>=', '<' FROM e
UNION ALL SELECT 2, seen + t * 2, hi, '>=', '<=' FROM e
""", name="recreate_ranges")
def recreate_ranges_after_step(spark, folder):
    """Three ranges of which five sixths are loaded: what the next step loads."""
    events = table(spark, folder, "events")
    kind = OffsetType.of(events, "event_id")
    found = range_scan(events, "event_id", 3)
    low, high = found.ranges[0].lower, found.ranges[-1].upper
    loaded = range_scan(events, "event_id", 3, where=F.col("event_id") <= low + (high - low) * 5 // 6)
    seen = {r.range_id: r for r in loaded.progress().collect()}
    total = {r.range_id: r.rows for r in found.progress().collect()}
    stepped = [
        replace(r, done=True) if seen[r.id].rows == total[r.id] else r.moved_to(seen[r.id].last_offset)
        for r in found.ranges
    ]
    return ranges_frame(spark, recreate_ranges(stepped, 3, kind), kind)


@query("""
WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi, count(*) AS n FROM events),
c AS (SELECT lo + (hi - lo) * 3 // 4 AS seen, hi, n // 10 AS cap FROM b),
f AS (
  SELECT least(8, (count(*) + any_value(cap) - 1) // any_value(cap)) AS parts, any_value(seen) AS seen, any_value(hi) AS hi
  FROM events, c WHERE epoch_us(ts) > seen AND event_type <> 'view'
)
SELECT CAST(i AS INTEGER) AS range_id, make_timestamp(seen + (hi - seen) // parts * i) AS lower,
       CASE WHEN i = parts - 1 THEN make_timestamp(hi) ELSE make_timestamp(seen + (hi - seen) // parts * (i + 1)) END AS upper,
       CASE WHEN i = 0 THEN '>' ELSE '>=' END AS lo_op, CASE WHEN i = parts - 1 THEN '<=' ELSE '<' END AS hi_op
FROM f, range(8) r(i) WHERE i < parts
""")
def plan_new_ranges(spark, folder):
    """Ranges for the last quarter of the table, as a poll would plan them."""
    events = table(spark, folder, "events")
    kind = OffsetType.of(events, "ts")
    stats = offset_stats(events, "ts")
    after = stats.first + (stats.last - stats.first) * 3 // 4
    new = count_new(events, "ts", after, "event_type <> 'view'").first()
    n = planned_ranges(new.new_rows, stats.rows // 10, 8, kind)
    return ranges_frame(spark, split_range(after, stats.last, n, kind, lo_op=">"), kind)
