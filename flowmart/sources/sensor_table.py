"""Sensor events derived from a generic event table (event_id, user_id, ts).

Lets the engine run on a table that has no sensor readings: every reading follows from the ids by integer
arithmetic and one division, chosen so that every label of every classification occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowmart.schema import ROADS, ZONES

EVENT_TABLE = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Offsets per road and per zone, in the order of schema.ROADS and schema.ZONES.
SPEED_BASE = (900, 700, 400, 150, 450)
OCCUPANCY_BASE = (8400, 6200, 3900, 1000, 2500)


def _pick(number: str, values) -> str:
    """SQL choice of the value at the position a number gives."""
    return f"CASE {number} " + " ".join(f"WHEN {at} THEN {value!r}" for at, value in enumerate(values)) + " END"


def sensor_events(spark: SparkSession, folder: str) -> DataFrame:
    zone, road = "user_id % 5", "event_id % 5"
    return spark.read.schema(EVENT_TABLE).parquet(f"{folder}/events.parquet").selectExpr(
        "event_id",
        "'s' || CAST(user_id % 25 AS string) AS sensor_id",
        f"{_pick(road, ROADS)} AS road_id",
        f"{_pick(road, ROADS.values())} AS road_type",
        f"{_pick(zone, ZONES)} AS zone",
        "(event_id * 37 + user_id * 11) % 101 AS vehicle_count",
        f"CAST({_pick(road, SPEED_BASE)} + event_id * 53 % 101 AS double) / 10 AS average_speed",
        f"CAST({_pick(zone, OCCUPANCY_BASE)} + event_id * 7919 % 1601 AS double) / 100 AS occupancy_rate",
        "ts AS event_time",
        "event_type",
    )
