"""Means and counts per zone and per road, in one pass, and as mergeable daily partials.

Averages skip NULLs, the row count does not, and NULL is a group of its own. All group-bys pre-aggregate before
they shuffle, so a zone with a third of all events still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions.numbers import mean, merged_sum, numeric2, partial_mean, partial_sum

# grouping_id of (zone, road_id, road_type): a set bit marks a column that is not part of the group.
_BY_ZONE, _BY_ROAD = 0b011, 0b100

ZONE_METRICS = ("vehicle_count", "occupancy_rate")
ROAD_METRICS = ("average_speed",)
ROAD_KEYS = ("road_id", "road_type")


def zone_means(events: DataFrame) -> DataFrame:
    """Everything the zone tables need from one aggregate."""
    return events.groupBy("zone").agg(
        numeric2(mean("vehicle_count")).alias("avg_vehicle_count"),
        numeric2(mean("occupancy_rate")).alias("avg_occupancy_rate"),
        F.count("*").alias("measurements_count"),
    )


def road_means(events: DataFrame) -> DataFrame:
    return events.groupBy(*ROAD_KEYS).agg(numeric2(mean("average_speed")).alias("avg_speed"))


def _grain():
    return F.when(F.grouping_id() == _BY_ZONE, "zone").when(F.grouping_id() == _BY_ROAD, "road").alias("grain")


def sweep(events: DataFrame) -> DataFrame:
    """Zone rows and road rows from a single scan; works on a batch and on a stream in complete mode.

    Each event counts once per grouping set. The second copy exists only between the scan and the partial
    aggregate of the same task, which is cheaper than reading and parsing the events twice.
    """
    return events.groupingSets([["zone"], list(ROAD_KEYS)], "zone", *ROAD_KEYS).agg(
        _grain(),
        numeric2(mean("vehicle_count")).alias("avg_vehicle_count"),
        numeric2(mean("occupancy_rate")).alias("avg_occupancy_rate"),
        numeric2(mean("average_speed")).alias("avg_speed"),
        F.count("*").alias("measurements_count"),
    )


def traffic_by_zone(means: DataFrame) -> DataFrame:
    """Processed zone table from zone_means."""
    return means.select("zone", "avg_vehicle_count", "avg_occupancy_rate")


def congestion_by_zone(means: DataFrame) -> DataFrame:
    """Processed congestion table from zone_means. The status is read off the rounded rate."""
    rate = F.col("avg_occupancy_rate")
    return means.select(
        "zone",
        rate.alias("global_congestion_rate"),
        "measurements_count",
        bands.status(rate).alias("status"),
    )


def processed_tables(swept: DataFrame) -> dict[str, DataFrame]:
    """The three processed tables out of one sweep."""
    zones = swept.where(F.col("grain") == "zone")
    roads = swept.where(F.col("grain") == "road")
    return {
        "traffic_by_zone": traffic_by_zone(zones),
        "speed_by_road": roads.select(*ROAD_KEYS, "avg_speed"),
        "congestion_alerts": congestion_by_zone(zones),
    }


def daily_partials(events: DataFrame, keys: tuple, metrics: tuple) -> DataFrame:
    """Sums and counts per day and key, from which means over any set of days follow."""
    sums = [column for metric in metrics for column in partial_sum(metric)]
    return events.groupBy("date", *keys).agg(*sums, F.count("*").alias("measurements_count"))


def daily_zone_partials(events: DataFrame) -> DataFrame:
    return daily_partials(events, ("zone",), ZONE_METRICS)


def daily_road_partials(events: DataFrame) -> DataFrame:
    return daily_partials(events, ROAD_KEYS, ROAD_METRICS)


def daily_sweep(events: DataFrame) -> DataFrame:
    """Zone partials and road partials of each day from a single scan; the rows of one grain have its keys."""
    sums = [column for metric in ZONE_METRICS + ROAD_METRICS for column in partial_sum(metric)]
    return events.groupingSets(
        [["date", "zone"], ["date", *ROAD_KEYS]], "date", "zone", *ROAD_KEYS
    ).agg(_grain(), *sums, F.count("*").alias("measurements_count"))


def store_partials(partials: DataFrame, path: str) -> None:
    """Write partials, replacing exactly the days they contain. Writing the same days again changes nothing."""
    (
        partials.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def on_days_of(events: DataFrame, touched: DataFrame) -> DataFrame:
    """Events of the days that occur in another frame, both with a text column `date`.

    The days are gathered in a subquery (at most as many as the calendar has) instead of joined: on a table with a
    directory per day the condition is a partition filter, and Spark lists and reads the touched days only.
    """
    days = touched.agg(F.collect_set("date")).scalar()
    return events.where(F.array_contains(days, F.col("date")))


def refresh_partials(events: DataFrame, touched: DataFrame, path: str) -> None:
    """Recompute the stored partials of the days that late events touched; events is the whole dated table."""
    store_partials(daily_sweep(on_days_of(events, touched)), path)


def merge_partials(stored: DataFrame) -> DataFrame:
    """All-time means from the stored partials of all days: the rows of a sweep over all events."""
    sums = [column for metric in ZONE_METRICS + ROAD_METRICS for column in merged_sum(metric)]
    keys = ("grain", "zone", *ROAD_KEYS)
    return (
        stored.groupBy(*keys)
        .agg(*sums, F.sum("measurements_count").alias("measurements_count"))
        .select(
            *keys,
            numeric2(partial_mean("vehicle_count")).alias("avg_vehicle_count"),
            numeric2(partial_mean("occupancy_rate")).alias("avg_occupancy_rate"),
            numeric2(partial_mean("average_speed")).alias("avg_speed"),
            "measurements_count",
        )
    )
