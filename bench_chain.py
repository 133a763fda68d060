"""Cost of one refresh of the processed tables, by how the events are read.

Writes the sensor events of a folder, repeated a number of times, as JSON lines and as the typed layer, and times:
  separate   schema inference, then one job per processed table over the JSON lines
  sweep      fixed schema, one scan of the JSON lines for all tables
  typed      one scan of the typed layer
  days       partials of the last day recomputed and merged with the stored ones

Usage: python bench_chain.py <scratch folder> [times] [input folder]
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowmart.functions.events import encode
from flowmart.operators import aggregates as agg
from flowmart.plans import batch
from flowmart.schema import RAW_EVENT, columns_of
from flowmart.sources import raw
from flowmart.sources.sensor_table import sensor_events

RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)


def separate(spark, path, out):
    """The plain way: each table on its own."""
    events = spark.read.option("recursiveFileLookup", "true").json(path)
    means = agg.zone_means(events)
    tables = {"t": agg.traffic_by_zone(means), "s": agg.road_means(events), "c": agg.congestion_by_zone(means)}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")


def main() -> None:
    scratch, times = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 50
    folder = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = sensor_events(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    events = events.repartition(int(cpus) * 4)
    iso = F.translate(F.col("event_time").cast("string"), " ", "T")
    lines, typed, stored = f"{scratch}/json", f"{scratch}/typed", f"{scratch}/partials"
    events.withColumn("event_time", iso).select(encode(columns_of(RAW_EVENT))).write.text(lines)
    layer = raw.dated(events.drop("event_id", "event_type", "copy")).hint("rebalance", "date")
    layer.write.partitionBy("date").parquet(typed)
    agg.store_partials(agg.daily_sweep(raw.read_typed(spark, typed)), stored)

    def days():
        layer = raw.read_typed(spark, typed)
        last = layer.where(F.col("date") == "2024-01-30")
        agg.refresh_partials(layer, last, stored)
        merged = agg.merge_partials(spark.read.parquet(stored))
        for name, table in agg.processed_tables(merged).items():
            table.write.mode("overwrite").parquet(f"{scratch}/days/{name}")

    ways = {
        "separate": lambda: separate(spark, lines, f"{scratch}/separate"),
        "sweep": lambda: batch.write_processed(raw.read_raw(spark, lines), f"{scratch}/sweep", RUN),
        "typed": lambda: batch.write_processed(raw.read_typed(spark, typed), f"{scratch}/from-typed", RUN),
        "days": days,
    }
    seconds = {}
    for name, way in ways.items():
        taken = []
        for _ in range(4):
            started = time.perf_counter()
            way()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(sorted(taken[1:])[1], 3)
    print(json.dumps({"events": events.count(), "cpus": int(cpus), "seconds": seconds}))


if __name__ == "__main__":
    main()
