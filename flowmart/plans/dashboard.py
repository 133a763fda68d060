"""All dashboard queries over one publishing target."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from flowmart.operators import panels


def dashboard(target, to: datetime | None = None) -> dict[str, DataFrame]:
    """The eight panels. With `to`, the series panels read the last six hours up to it, without it all history.
    All current tables are those of one moment, also while a run is published."""
    target = target.pinned()
    traffic, speed = target.current("traffic_by_zone"), target.current("speed_by_road")
    zone_history, road_history = target.history("traffic_by_zone", to), target.history("speed_by_road", to)
    return {
        "zone_table": panels.zone_table(traffic),
        "speed_series": panels.speed_series(road_history),
        "vehicle_series": panels.vehicle_series(zone_history),
        "occupancy_series": panels.occupancy_series(zone_history),
        "vehicles": panels.global_mean(traffic, "vehicle_count_avg"),
        "occupancy": panels.global_mean(traffic, "occupancy_rate_avg"),
        "speed": panels.global_mean(speed, "speed_avg_kmh"),
        "alert_zones": panels.alert_zones(target.current("congestion_alerts")),
    }
