"""The batch chain: raw to processed, processed to analytics, analytics to published tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flowmart.operators.aggregates import (
    daily_sweep,
    merge_partials,
    processed_tables,
    refresh_partials,
    sweep,
)
from flowmart.operators.marts import analytics_tables, stamped
from flowmart.sinks.lake import replace_table
from flowmart.sinks.publish import publish
from flowmart.sources.tables import read_analytics, read_processed


def write_processed(events: DataFrame, root: str, run_ts: datetime) -> None:
    """The three processed tables. The events are read once, into a fourth table with one row per zone and road;
    unlike a cached frame it outlives lost executors and has as few files as it needs."""
    spark = events.sparkSession
    swept = f"{root}/group_means"
    replace_table(sweep(events), swept)
    for name, table in processed_tables(spark.read.parquet(swept)).items():
        replace_table(stamped(table, run_ts), f"{root}/{name}")


def write_analytics(spark: SparkSession, processed_root: str, root: str, run_ts: datetime) -> None:
    """The four marts from the processed tables; speed_by_road has a directory per road type."""
    for name, mart in analytics_tables(read_processed(spark, processed_root), run_ts).items():
        layout = ("road_type",) if name == "speed_by_road" else ()
        replace_table(mart, f"{root}/{name}", partition_by=layout)


def publish_analytics(spark: SparkSession, analytics_root: str, target, run_ts: datetime) -> list[str]:
    """Current and history tables from the marts in the lake; a mart that was never written counts as empty."""
    return publish(read_analytics(spark, analytics_root), target, run_ts)


def run_incremental(events: DataFrame, touched: DataFrame, partials: str, target, run_ts: datetime) -> list[str]:
    """The chain for a long history: recompute the touched days, merge the stored partials of all days, publish.

    Gives the same tables as run_chain over all events, but reads only the days that got new or late events.
    """
    spark = events.sparkSession
    refresh_partials(events, touched, partials)
    stored = spark.read.schema(daily_sweep(events).schema).parquet(partials)
    swept = f"{partials}_merged"
    replace_table(merge_partials(stored), swept)
    return publish(analytics_tables(processed_tables(spark.read.parquet(swept)), run_ts), target, run_ts)


def run_chain(events: DataFrame, lake: str, target, run_ts: datetime) -> list[str]:
    """All three stages under one run time."""
    spark = events.sparkSession
    write_processed(events, f"{lake}/processed", run_ts)
    write_analytics(spark, f"{lake}/processed", f"{lake}/analytics", run_ts)
    return publish_analytics(spark, f"{lake}/analytics", target, run_ts)
