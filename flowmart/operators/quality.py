"""Profiles and contract checks of the events, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions.numbers import mean
from flowmart.schema import ROAD_TYPES, ROADS, ZONES


def time_band_profile(events: DataFrame) -> DataFrame:
    """Means and counts per zone in peak, medium and calm hours."""
    return events.groupBy("zone", bands.time_band(F.col("event_time")).alias("time_band")).agg(
        mean("vehicle_count").alias("avg_vehicle_count"),
        mean("occupancy_rate").alias("avg_occupancy_rate"),
        mean("average_speed").alias("avg_speed"),
        F.count("*").alias("measurements_count"),
    )


def flow_regime_profile(events: DataFrame) -> DataFrame:
    """Counts and mean speed per road type in critical, dense and free flow."""
    return events.groupBy("road_type", bands.flow_regime(F.col("occupancy_rate")).alias("regime")).agg(
        mean("average_speed").alias("avg_speed"),
        F.count("*").alias("measurements_count"),
    )


def road_limits(events: DataFrame) -> DataFrame:
    """The road type dimension: one row per type, a fixed list, so it is always small enough to broadcast."""
    rows = [(name, speed, capacity) for name, (speed, capacity, _) in ROAD_TYPES.items()]
    return events.sparkSession.createDataFrame(rows, "road_type string, max_speed int, capacity int")


def road_load(events: DataFrame) -> DataFrame:
    """Events with the limits of their road type and the load ratio; unknown types keep their row, without limits."""
    return events.join(F.broadcast(road_limits(events)), "road_type", "left").withColumn(
        "load_ratio", F.col("vehicle_count") / F.col("capacity")
    )


def _rules() -> dict[str, Column]:
    """What a sound event satisfies. A missing value breaks its rule. Limits of an unknown road type are not known,
    so only its type is reported."""
    vehicles, speed, occupancy = F.col("vehicle_count"), F.col("average_speed"), F.col("occupancy_rate")
    capacity, top_speed = bands.capacity(F.col("road_type")), bands.top_speed(F.col("road_type"))
    return {
        "occupancy_range": occupancy.between(0, 100),
        "vehicle_capacity": (vehicles >= 0) & (capacity.isNull() | (vehicles <= capacity)),
        "speed_limit": (speed >= 0) & (top_speed.isNull() | (speed <= top_speed)),
        "known_zone": F.col("zone").isin(*ZONES),
        "known_road": F.col("road_id").isin(*ROADS),
        "known_road_type": F.col("road_type").isin(*ROAD_TYPES),
        "event_time": F.col("event_time").isNotNull(),
    }


def _broken(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def observed(rows: DataFrame, is_event: Column, name: str = "contract") -> DataFrame:
    """The same rows; whatever query reads them counts the events among them and the violations of each rule on the way, in
    the same pass. A stream reports them with the progress of every batch."""
    counts = [F.count_if(is_event & _broken(holds)).alias(rule) for rule, holds in _rules().items()]
    return rows.observe(name, F.count_if(is_event).alias("checked"), *counts)


def observed_violations(progress: list, name: str = "contract") -> dict[str, int]:
    """Events checked and violations by rule, added up over progress reports of a stream (Spark keeps the last 100)."""
    total: dict[str, int] = {}
    for report in progress:
        counted = report.observedMetrics.get(name)
        for rule, count in counted.asDict().items() if counted else ():
            total[rule] = total.get(rule, 0) + (count or 0)
    return total


def contract_violations(events: DataFrame) -> DataFrame:
    """Violations per rule and road type, zero included. Rules are counted side by side in one aggregate and turned
    into rows afterwards."""
    rules = _rules()
    counted = events.groupBy("road_type").agg(
        F.count("*").alias("checked"),
        *[F.count_if(_broken(holds)).alias(rule) for rule, holds in rules.items()],
    )
    return counted.unpivot(["road_type", "checked"], list(rules), "rule", "violations")
