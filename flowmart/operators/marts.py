"""Analytics marts: rounding, renaming, classification, and the mobility summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions.numbers import round2


def run_time(run_ts: datetime | Column) -> Column:
    """The time of a run as a column. One value serves all tables of the run, so they can be matched later."""
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")


def stamped(frame: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """The frame with its processed_date in the last place."""
    return frame.withColumn("processed_date", run_time(run_ts))


def traffic_mart(processed: DataFrame) -> DataFrame:
    occupancy = round2(F.col("avg_occupancy_rate"))
    return processed.select(
        "zone",
        round2(F.col("avg_vehicle_count")).alias("vehicle_count_avg"),
        occupancy.alias("occupancy_rate_avg"),
        bands.traffic_level(occupancy).alias("traffic_level"),
    )


def speed_mart(processed: DataFrame) -> DataFrame:
    speed = round2(F.col("avg_speed"))
    return processed.select(
        "road_id",
        "road_type",
        speed.alias("speed_avg_kmh"),
        bands.speed_category(speed).alias("speed_category"),
    )


def congestion_mart(processed: DataFrame) -> DataFrame:
    rate = round2(F.col("global_congestion_rate"))
    return processed.select(
        "zone",
        rate.alias("congestion_rate_pct"),
        "measurements_count",
        "status",
        bands.congestion_priority(rate).alias("congestion_priority"),
    )


def mobility_summary(traffic: DataFrame, congestion: DataFrame) -> DataFrame:
    """Full outer join of the two zone marts on the zone name.

    A NULL zone equals nothing, so it gives one half row from each side; the alert of a row without a rate is
    NORMAL. Columns of the traffic mart come first, in their order.
    """
    rates = congestion.select("zone", "congestion_rate_pct", "congestion_priority")
    return traffic.join(rates, on="zone", how="outer").withColumn(
        "alert_status", bands.alert_status(F.col("congestion_rate_pct"))
    )


def analytics_tables(processed: dict[str, DataFrame], run_ts: datetime | Column) -> dict[str, DataFrame]:
    """The four stamped marts from the three processed tables."""
    traffic = stamped(traffic_mart(processed["traffic_by_zone"]), run_ts)
    speed = stamped(speed_mart(processed["speed_by_road"]), run_ts)
    congestion = stamped(congestion_mart(processed["congestion_alerts"]), run_ts)
    # The stamp is set again after the join: a zone known to one side only has none yet.
    summary = stamped(mobility_summary(traffic, congestion), run_ts)
    return {
        "traffic_by_zone": traffic,
        "speed_by_road": speed,
        "congestion_alerts": congestion,
        "mobility_summary": summary,
    }
