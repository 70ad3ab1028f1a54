"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from rangeload.catalog.incremental import _loader
from rangeload.operators.filters import apply_filters
from rangeload.operators.ranges import quantile_ranges, range_scan
from rangeload.operators.scan import scan
from rangeload.session import scratch_dir, spark_session
from rangeload.streaming.streams import load_once, read_stream

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(df) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def queries(spark):
    def table(name):
        return spark.read.parquet(f"{FOLDER}/{name}.parquet")

    def filtered():
        lines = scan(table("lineitem"), ["l_orderkey", "l_extendedprice"], "l_quantity > 45")
        consume(apply_filters(lines, F.col("l_extendedprice") > 10_000))

    def ranges(n):
        return lambda: consume(range_scan(table("lineitem"), "l_shipdate", n).rows())

    def streamed():
        schema = table("events").schema
        root = scratch_dir(spark, "bench")
        load_once(read_stream(spark, f"{FOLDER}/events.parquet", schema), f"{root}/out", f"{root}/checkpoint")

    def capped(offset, name):
        return lambda: _loader(spark, table(name), offset, ranges=4, share=12).load_available()

    def scattered():
        path = f"{scratch_dir(spark, 'bench')}/events"
        table("events").repartition(40).write.parquet(path)
        return lambda: _loader(spark, path, "ts", ranges=4, share=12, rows=table("events").count()).load_available()

    def quantiles(tolerance):
        return lambda: consume(quantile_ranges(table("lineitem"), "l_extendedprice", 16, tolerance=tolerance).rows())

    return {
        "full_scan": lambda: consume(scan(table("lineitem"))),
        "pruned_filtered_scan": filtered,
        "range_scan_1": ranges(1),
        "range_scan_4": ranges(4),
        "range_scan_16": ranges(16),
        "range_scan_256": ranges(256),
        "range_scan_ordered": lambda: consume(range_scan(table("lineitem"), "l_shipdate", 4).ordered()),
        "quantile_ranges": quantiles(None),
        "quantile_ranges_exact": quantiles(0.0),
        "range_progress": lambda: consume(range_scan(table("lineitem"), "l_shipdate", 16).progress()),
        "stream_load_once": streamed,
        "incremental_capped": capped("ts", "events"),
        "incremental_skewed": capped("value", "events"),
        "incremental_lineitem": capped("l_orderkey", "lineitem"),
        "incremental_text": lambda: _loader(spark, table("customer"), "c_name", ranges=1, share=3).load_available(),
        "incremental_scattered": scattered(),
    }


def main() -> None:
    spark = spark_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    consume(spark.read.parquet(f"{FOLDER}/orders.parquet"))
    seconds = {}
    for name, run in queries(spark).items():
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
