"""Schemas and fixed values of the traffic domain."""

from __future__ import annotations

# Raw event as it travels in JSON. event_time stays text until a typed read, so an odd value never loses a line.
RAW_EVENT = (
    "sensor_id string, road_id string, road_type string, zone string, vehicle_count bigint, "
    "average_speed double, occupancy_rate double, event_time string"
)

# Event of the typed layer: a naive local time, and the day as text (`undated` where there is no time).
TYPED_EVENT = RAW_EVENT.replace("event_time string", "event_time timestamp_ntz") + ", date string"

PROCESSED = {
    "traffic_by_zone": "zone string, avg_vehicle_count double, avg_occupancy_rate double, processed_date timestamp",
    "speed_by_road": "road_id string, road_type string, avg_speed double, processed_date timestamp",
    "congestion_alerts": (
        "zone string, global_congestion_rate double, measurements_count bigint, status string, "
        "processed_date timestamp"
    ),
}

# Counts are bigint everywhere, also in the empty fallback tables: an integer column created by an empty export
# would refuse counts above 2^31-1 later on.
ANALYTICS = {
    "traffic_by_zone": (
        "zone string, vehicle_count_avg double, occupancy_rate_avg double, traffic_level string, "
        "processed_date timestamp"
    ),
    "speed_by_road": (
        "road_id string, road_type string, speed_avg_kmh double, speed_category string, processed_date timestamp"
    ),
    "congestion_alerts": (
        "zone string, congestion_rate_pct double, measurements_count bigint, status string, "
        "congestion_priority string, processed_date timestamp"
    ),
    "mobility_summary": (
        "zone string, vehicle_count_avg double, occupancy_rate_avg double, traffic_level string, "
        "processed_date timestamp, congestion_rate_pct double, congestion_priority string, alert_status string"
    ),
}

# Key columns of each published table: one row per key and run.
MART_KEYS = {
    "traffic_by_zone": ("zone",),
    "speed_by_road": ("road_id", "road_type"),
    "congestion_alerts": ("zone",),
    "mobility_summary": ("zone",),
}

# Zone names, roads with their type, and limits per road type.
ZONES = ("Centre Ville", "Zone Industrielle", "Quartier Residentiel", "Aeroport", "Quartier Commercial")
ROADS = {
    "A1": "Autoroute",
    "A86": "Autoroute",
    "Av. des Champs": "Avenue",
    "Rue de la Republique": "Rue",
    "Bd de la Resistance": "Avenue",
}
# road_type: (max_speed, capacity, highest speed a sensor may report)
ROAD_TYPES = {"Autoroute": (130, 100, 140), "Avenue": (60, 50, 60), "Rue": (30, 20, 30)}


def columns_of(ddl: str) -> list[str]:
    """Column names of one of the flat schemas above."""
    return [field.split()[0] for field in ddl.split(",")]
