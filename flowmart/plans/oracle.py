"""The registered queries once more, in plain SQL over the given tables, for comparison in another engine."""

from __future__ import annotations

# Sensor events as a view: the same arithmetic as sources.sensor_table.
_EVENTS = """
traffic_events AS (
  SELECT event_id, 's' || CAST(user_id % 25 AS varchar) AS sensor_id,
    CASE user_id % 5 WHEN 0 THEN 'Centre Ville' WHEN 1 THEN 'Zone Industrielle' WHEN 2 THEN 'Quartier Residentiel'
      WHEN 3 THEN 'Aeroport' WHEN 4 THEN 'Quartier Commercial' END AS zone,
    CASE event_id % 5 WHEN 0 THEN 'A1' WHEN 1 THEN 'A86' WHEN 2 THEN 'Av. des Champs'
      WHEN 3 THEN 'Rue de la Republique' WHEN 4 THEN 'Bd de la Resistance' END AS road_id,
    CASE event_id % 5 WHEN 0 THEN 'Autoroute' WHEN 1 THEN 'Autoroute' WHEN 3 THEN 'Rue' ELSE 'Avenue' END AS road_type,
    (event_id * 37 + user_id * 11) % 101 AS vehicle_count,
    CAST(CASE event_id % 5 WHEN 0 THEN 900 WHEN 1 THEN 700 WHEN 2 THEN 400 WHEN 3 THEN 150 ELSE 450 END
      + (event_id * 53) % 101 AS double) / 10 AS average_speed,
    CAST(CASE user_id % 5 WHEN 0 THEN 8400 WHEN 1 THEN 6200 WHEN 2 THEN 3900 WHEN 3 THEN 1000 WHEN 4 THEN 2500 END
      + (event_id * 7919) % 1601 AS double) / 100 AS occupancy_rate,
    ts AS event_time, event_type
  FROM events)"""


def _round2(value: str) -> str:
    return f"CAST(round(CAST({value} AS decimal(38,10)), 2) AS double)"


_ZONES = f"""
zone_means AS (
  SELECT zone, {_round2('avg(vehicle_count)')} AS vehicles, {_round2('avg(occupancy_rate)')} AS occupancy,
    count(*) AS measurements_count
  FROM traffic_events GROUP BY zone),
traffic AS (
  SELECT zone, vehicles AS vehicle_count_avg, occupancy AS occupancy_rate_avg,
    CASE WHEN occupancy < 20 THEN 'FAIBLE' WHEN occupancy < 50 THEN 'MODERÉ' WHEN occupancy < 80 THEN 'ÉLEVÉ'
      ELSE 'CRITIQUE' END AS traffic_level
  FROM zone_means),
congestion AS (
  SELECT zone, occupancy AS congestion_rate_pct, measurements_count,
    CASE WHEN occupancy > 80 THEN 'CRITICAL CONGESTION' WHEN occupancy > 50 THEN 'HIGH CONGESTION'
      ELSE 'MODERATE CONGESTION' END AS status,
    CASE WHEN occupancy > 80 THEN 'URGENTE' WHEN occupancy > 50 THEN 'HAUTE' WHEN occupancy > 30 THEN 'MODERÉE'
      ELSE 'FAIBLE' END AS congestion_priority
  FROM zone_means),
summary AS (
  SELECT zone, vehicle_count_avg, occupancy_rate_avg, traffic_level, congestion_rate_pct, congestion_priority,
    CASE WHEN congestion_rate_pct > 50 THEN 'ALERTE' ELSE 'NORMAL' END AS alert_status
  FROM traffic FULL JOIN congestion USING (zone))"""

_LEVEL = """CASE WHEN occupancy_rate_avg < 20 THEN 'FAIBLE' WHEN occupancy_rate_avg < 50 THEN 'MODERÉ'
    WHEN occupancy_rate_avg < 80 THEN 'ÉLEVÉ' ELSE 'CRITIQUE' END"""

_CATEGORY = """CASE WHEN speed_avg_kmh > 80 THEN 'RAPIDE' WHEN speed_avg_kmh > 50 THEN 'NORMALE'
      WHEN speed_avg_kmh > 30 THEN 'LENTE' ELSE 'TRÈS_LENTE' END AS speed_category"""

_ROADS = f"""
road_means AS (
  SELECT road_id, road_type, {_round2('avg(average_speed)')} AS speed_avg_kmh
  FROM traffic_events GROUP BY road_id, road_type),
speed AS (SELECT road_id, road_type, speed_avg_kmh, {_CATEGORY} FROM road_means)"""


def _replay(keys: str, metrics: dict[str, str]) -> str:
    """For each day of the calendar, the means over all events up to it."""
    means = ", ".join(f"{_round2(f'avg(e.{metric})')} AS {name}" for metric, name in metrics.items())
    listed = ", ".join(f"e.{key}" for key in keys.split(", "))
    return f"""
days AS (
  SELECT unnest(generate_series(min(event_time)::date, max(event_time)::date, INTERVAL 1 DAY))::date AS day
  FROM traffic_events),
replayed AS (
  SELECT {listed}, {means}, CAST(day + INTERVAL 1 DAY AS timestamp) AS "timestamp"
  FROM days JOIN traffic_events e ON e.event_time::date <= day OR e.event_time IS NULL GROUP BY {listed}, day)"""


def _replay_runs(keys: str, metrics: dict[str, str]) -> str:
    """The same for every minute of a day."""
    means = ", ".join(f"{_round2(f'avg(e.{metric})')} AS {name}" for metric, name in metrics.items())
    listed = ", ".join(f"e.{key}" for key in keys.split(", "))
    return f"""
runs AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-21', INTERVAL 60 SECOND)) AS "timestamp"),
replayed AS (
  SELECT {listed}, {means}, "timestamp"
  FROM runs JOIN traffic_events e ON e.event_time <= "timestamp" OR e.event_time IS NULL GROUP BY {listed}, "timestamp")"""


_ZONE_HISTORY = _replay("zone", {"vehicle_count": "vehicle_count_avg", "occupancy_rate": "occupancy_rate_avg"})
_ROAD_HISTORY = _replay("road_id, road_type", {"average_speed": "speed_avg_kmh"})


def _sql(select: str, *parts: str) -> str:
    return "WITH " + ",".join((_EVENTS, *parts)) + "\n" + select


_CENSUS = f"""SELECT zone, count(*) AS events, {_round2('avg(occupancy_rate)')} AS avg_occupancy_rate
FROM traffic_events GROUP BY zone"""
# Events without a zone or a time are kept under another outcome and are not among the landed ones.
_LANDED = "FROM traffic_events WHERE zone IS NOT NULL AND event_time IS NOT NULL"
_PARTITIONS = """SELECT strftime(event_time, '%Y-%m-%d') AS date, replace(zone, ' ', '_') AS zone, count(*) AS events"""
_BAND = "CASE WHEN {0} >= 80 THEN 'red' WHEN {0} >= 60 THEN 'orange' WHEN {0} >= 30 THEN 'yellow' ELSE 'green' END"
_TIME_BAND = """CASE WHEN hour(event_time) BETWEEN 7 AND 9 OR hour(event_time) BETWEEN 17 AND 19 THEN 'peak'
  WHEN hour(event_time) BETWEEN 10 AND 16 THEN 'medium' ELSE 'calm' END"""
_REGIME = "CASE WHEN occupancy_rate >= 90 THEN 'critical' WHEN occupancy_rate >= 70 THEN 'dense' ELSE 'free' END"
_CAPACITY = "CASE road_type WHEN 'Autoroute' THEN 100 WHEN 'Avenue' THEN 50 WHEN 'Rue' THEN 20 END"
_MAX_SPEED = "CASE road_type WHEN 'Autoroute' THEN 130 WHEN 'Avenue' THEN 60 WHEN 'Rue' THEN 30 END"
_TOP_SPEED = "CASE road_type WHEN 'Autoroute' THEN 140 WHEN 'Avenue' THEN 60 WHEN 'Rue' THEN 30 END"
_BREACHES = {
    "occupancy_range": "occupancy_rate IS NULL OR occupancy_rate < 0 OR occupancy_rate > 100",
    "vehicle_capacity": f"vehicle_count IS NULL OR vehicle_count < 0 OR vehicle_count > {_CAPACITY}",
    "speed_limit": f"average_speed < 0 OR average_speed > {_TOP_SPEED}",
    "known_zone": (
        "zone IS NULL OR zone NOT IN ('Centre Ville', 'Zone Industrielle', 'Quartier Residentiel', 'Aeroport', 'Quartier Commercial')"
    ),
    "known_road": (
        "road_id NOT IN ('A1', 'A86', 'Av. des Champs', 'Rue de la Republique', 'Bd de la Resistance')"
    ),
    "known_road_type": "road_type NOT IN ('Autoroute', 'Avenue', 'Rue')",
    "event_time": "event_time IS NULL",
}
_MART = "SELECT zone, congestion_rate_pct, measurements_count, status, congestion_priority"

ORACLE = {
    "zone_traffic_processed": _sql(
        "SELECT zone, vehicles AS avg_vehicle_count, occupancy AS avg_occupancy_rate FROM zone_means", _ZONES
    ),
    "road_speed_processed": _sql("SELECT road_id, road_type, speed_avg_kmh AS avg_speed FROM road_means", _ROADS),
    "zone_congestion_processed": _sql(
        "SELECT zone, congestion_rate_pct AS global_congestion_rate, measurements_count, status FROM congestion", _ZONES
    ),
    "zone_traffic_analytics": _sql("SELECT * FROM traffic", _ZONES),
    "road_speed_analytics": _sql("SELECT * FROM speed", _ROADS),
    "zone_congestion_analytics": _sql("SELECT * FROM congestion", _ZONES),
    "mobility_summary": _sql("SELECT * FROM summary", _ZONES),
    "single_sweep": _sql(
        f"""SELECT 'zone' AS grain, zone, NULL AS road_id, NULL AS road_type,
  {_round2('avg(vehicle_count)')} AS avg_vehicle_count, {_round2('avg(occupancy_rate)')} AS avg_occupancy_rate,
  {_round2('avg(average_speed)')} AS avg_speed, count(*) AS measurements_count
FROM traffic_events GROUP BY zone
UNION ALL
SELECT 'road', NULL, road_id, road_type, {_round2('avg(vehicle_count)')}, {_round2('avg(occupancy_rate)')},
  {_round2('avg(average_speed)')}, count(*)
FROM traffic_events GROUP BY road_id, road_type"""
    ),
    "panel_zone_table": _sql(
        f"""SELECT zone, {_round2('vehicle_count_avg')} AS vehicules_moyens,
  {_round2('occupancy_rate_avg')} AS taux_occupation, traffic_level
FROM traffic ORDER BY vehicle_count_avg DESC""",
        _ZONES,
    ),
    "kpi_vehicles": _sql(f"SELECT {_round2('avg(vehicle_count_avg)')} AS \"avg\" FROM traffic", _ZONES),
    "kpi_occupancy": _sql(f"SELECT {_round2('avg(occupancy_rate_avg)')} AS \"avg\" FROM traffic", _ZONES),
    "kpi_speed": _sql(f"SELECT {_round2('avg(speed_avg_kmh)')} AS \"avg\" FROM speed", _ROADS),
    "kpi_alert_zones": _sql('SELECT count(*) AS "count" FROM congestion WHERE congestion_rate_pct > 50', _ZONES),
    "kpi_weighted": _sql(
        f"""SELECT {_round2('sum(vehicle_count)::double / count(vehicle_count)')} AS vehicles,
  {_round2('sum(occupancy_rate) / count(occupancy_rate)')} AS occupancy,
  {_round2('sum(average_speed) / count(average_speed)')} AS speed, count(*) AS measurements
FROM traffic_events"""
    ),
    "kpi_bands": _sql(
        f"""SELECT 'zone_occupancy' AS kpi, zone AS label, occupancy_rate_avg AS "value",
  {_BAND.format('occupancy_rate_avg')} AS band FROM traffic
UNION ALL
SELECT 'zone_level', zone, occupancy_rate_avg, CASE traffic_level WHEN 'CRITIQUE' THEN 'red'
  WHEN 'ÉLEVÉ' THEN 'orange' WHEN 'MODERÉ' THEN 'yellow' WHEN 'FAIBLE' THEN 'green' END FROM traffic
UNION ALL
SELECT 'congestion', 'all', v, {_BAND.format('v')}
FROM (SELECT {_round2('avg(occupancy_rate_avg)')} AS v FROM traffic)
UNION ALL
SELECT 'speed', 'all', v, CASE WHEN v >= 50 THEN 'green' WHEN v >= 30 THEN 'yellow' ELSE 'red' END
FROM (SELECT {_round2('avg(speed_avg_kmh)')} AS v FROM speed)
UNION ALL
SELECT 'alert_zones', 'all', CAST(n AS double), CASE WHEN n >= 3 THEN 'red' WHEN n >= 2 THEN 'orange'
  WHEN n >= 1 THEN 'yellow' ELSE 'green' END
FROM (SELECT count(*) AS n FROM congestion WHERE congestion_rate_pct > 50)""",
        _ZONES,
        _ROADS,
    ),
    "history_replay_zone": _sql(
        """SELECT zone, vehicle_count_avg, occupancy_rate_avg,
  CASE WHEN occupancy_rate_avg < 20 THEN 'FAIBLE' WHEN occupancy_rate_avg < 50 THEN 'MODERÉ'
    WHEN occupancy_rate_avg < 80 THEN 'ÉLEVÉ' ELSE 'CRITIQUE' END AS traffic_level, "timestamp"
FROM replayed""",
        _ZONE_HISTORY,
    ),
    "history_replay_road": _sql(
        f'SELECT road_id, road_type, speed_avg_kmh, {_CATEGORY}, "timestamp" FROM replayed', _ROAD_HISTORY
    ),
    "history_replay_zone_runs": _sql(
        f"""SELECT zone, vehicle_count_avg, occupancy_rate_avg, {_LEVEL} AS traffic_level, "timestamp" FROM replayed""",
        _replay_runs("zone", {"vehicle_count": "vehicle_count_avg", "occupancy_rate": "occupancy_rate_avg"}),
    ),
    "history_replay_road_runs": _sql(
        f'SELECT road_id, road_type, speed_avg_kmh, {_CATEGORY}, "timestamp" FROM replayed',
        _replay_runs("road_id, road_type", {"average_speed": "speed_avg_kmh"}),
    ),
    "history_by_arrival": _sql(
        f"""SELECT run, zone, vehicle_count_avg, occupancy_rate_avg, {_LEVEL} AS traffic_level, true AS appended
FROM (SELECT run, zone, {_round2('avg(vehicle_count)')} AS vehicle_count_avg, {_round2('avg(occupancy_rate)')} AS occupancy_rate_avg
  FROM traffic_events, (SELECT unnest([1, 2]) AS run)
  WHERE zone IS NOT NULL AND event_time IS NOT NULL AND (run = 2 OR event_time >= TIMESTAMP '2024-01-16')
  GROUP BY run, zone)"""
    ),
    "panel_speed_ts": _sql(
        'SELECT "timestamp" AS "time", road_type, speed_avg_kmh AS vitesse_moyenne FROM replayed ORDER BY 1',
        _ROAD_HISTORY,
    ),
    "panel_vehicles_ts": _sql(
        'SELECT "timestamp" AS "time", zone, vehicle_count_avg AS vehicules_moyens FROM replayed ORDER BY 1',
        _ZONE_HISTORY,
    ),
    "panel_occupancy_ts": _sql(
        'SELECT "timestamp" AS "time", zone, occupancy_rate_avg AS taux_occupation FROM replayed ORDER BY 1',
        _ZONE_HISTORY,
    ),
    "panel_occupancy_wide": _sql(
        """SELECT "timestamp" AS "time",
  avg(occupancy_rate_avg) FILTER (WHERE zone = 'Centre Ville') AS "Centre Ville",
  avg(occupancy_rate_avg) FILTER (WHERE zone = 'Zone Industrielle') AS "Zone Industrielle",
  avg(occupancy_rate_avg) FILTER (WHERE zone = 'Quartier Residentiel') AS "Quartier Residentiel",
  avg(occupancy_rate_avg) FILTER (WHERE zone = 'Aeroport') AS "Aeroport",
  avg(occupancy_rate_avg) FILTER (WHERE zone = 'Quartier Commercial') AS "Quartier Commercial"
FROM replayed GROUP BY 1 ORDER BY 1""",
        _ZONE_HISTORY,
    ),
    "panel_occupancy_map": _sql(
        """SELECT "timestamp" AS "time", list(zone ORDER BY zone) FILTER (WHERE zone IS NOT NULL) AS zones,
  list(occupancy_rate_avg ORDER BY zone) FILTER (WHERE zone IS NOT NULL) AS taux_occupation,
  max(occupancy_rate_avg) FILTER (WHERE zone IS NULL) AS no_zone
FROM replayed GROUP BY 1 ORDER BY 1""",
        _ZONE_HISTORY,
    ),
    "panel_speed_by_type": _sql(
        f"""SELECT "timestamp" AS "time", road_type, {_round2('avg(speed_avg_kmh)')} AS vitesse_moyenne
FROM replayed GROUP BY 1, 2 ORDER BY 1""",
        _ROAD_HISTORY,
    ),
    "panel_range_filter": _sql(
        """SELECT "timestamp" AS "time", zone, occupancy_rate_avg AS taux_occupation FROM replayed
WHERE "timestamp" >= TIMESTAMP '2024-01-20 03:00:00' - INTERVAL 6 HOUR
  AND "timestamp" <= TIMESTAMP '2024-01-20 03:00:00' ORDER BY 1""",
        _ZONE_HISTORY,
    ),
    "kpi_last_not_null": _sql(
        """SELECT zone, max("timestamp") FILTER (WHERE occupancy_rate_avg IS NOT NULL) AS "time",
  arg_max(occupancy_rate_avg, "timestamp") FILTER (WHERE occupancy_rate_avg IS NOT NULL) AS "value"
FROM replayed GROUP BY zone""",
        _ZONE_HISTORY,
    ),
    "incremental_zone_means": _sql(
        """SELECT zone, vehicles AS avg_vehicle_count, occupancy AS avg_occupancy_rate, measurements_count
FROM zone_means""",
        _ZONES,
    ),
    "time_band_profile": _sql(
        f"""SELECT zone, {_TIME_BAND} AS time_band, {_round2('avg(vehicle_count)')} AS avg_vehicle_count,
  {_round2('avg(occupancy_rate)')} AS avg_occupancy_rate, {_round2('avg(average_speed)')} AS avg_speed,
  count(*) AS measurements_count
FROM traffic_events GROUP BY 1, 2"""
    ),
    "flow_regime_profile": _sql(
        f"""SELECT road_type, {_REGIME} AS regime, {_round2('avg(average_speed)')} AS avg_speed,
  count(*) AS measurements_count
FROM traffic_events GROUP BY 1, 2"""
    ),
    "road_load_ratio": _sql(
        f"""SELECT event_id, road_type, {_MAX_SPEED} AS max_speed, {_CAPACITY} AS capacity, vehicle_count,
  CAST(vehicle_count AS double) / {_CAPACITY} AS load_ratio
FROM traffic_events"""
    ),
    "contract_violations": _sql(
        "\nUNION ALL\n".join(
            f"""SELECT road_type, count(*) AS checked, '{rule}' AS rule, count(*) FILTER (WHERE {breach}) AS violations
FROM traffic_events GROUP BY road_type"""
            for rule, breach in _BREACHES.items()
        )
    ),
    "landing_violations": _sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{rule}' AS rule, count(*) AS checked, count(*) FILTER (WHERE {breach}) AS violations FROM traffic_events"""
            for rule, breach in _BREACHES.items()
        )
    ),
    "landing_partitions": _sql(f"{_PARTITIONS} FROM traffic_events GROUP BY 1, 2"),
    "landing_stream_roundtrip": _sql(_CENSUS),
    "late_event_roundtrip": _sql(_CENSUS.replace("FROM traffic_events", _LANDED)),
    "quarantine_split": _sql(
        """SELECT CASE WHEN event_type = 'view' THEN 'malformed' WHEN event_type = 'error' OR zone IS NULL THEN 'no_zone'
  WHEN event_type = 'signup' OR event_time IS NULL THEN 'no_time' ELSE 'landed' END AS outcome, count(*) AS events
FROM traffic_events GROUP BY 1"""
    ),
    "compacted_counts": _sql(f"{_PARTITIONS} {_LANDED} GROUP BY 1, 2"),
    "late_compaction_counts": _sql(f"{_PARTITIONS} {_LANDED} GROUP BY 1, 2"),
    "typed_layer_roundtrip": _sql(
        f"""SELECT strftime(event_time, '%Y-%m-%d') AS date, count(*) AS events, max(event_time) AS last_event
{_LANDED} GROUP BY 1"""
    ),
    "processed_roundtrip": _sql(
        """SELECT zone, congestion_rate_pct AS global_congestion_rate, measurements_count, status,
  '2024-02-01 00:00:00' AS processed_date
FROM congestion""",
        _ZONES,
    ),
    "road_partition_roundtrip": _sql("SELECT * FROM speed", _ROADS),
    "tolerant_scan": _sql(
        "SELECT zone, vehicles AS avg_vehicle_count, occupancy AS avg_occupancy_rate FROM zone_means", _ZONES
    ),
    "tolerant_scan_audit": _sql(
        """SELECT 'rows' AS fact, count(*) AS "value" FROM traffic_events UNION ALL SELECT 'txt', 1"""
    ),
    "read_or_empty": _sql(
        """SELECT 'rows_present' AS fact, count(*) AS "value" FROM traffic
UNION ALL SELECT 'rows_missing', 0
UNION ALL SELECT 'exported_if_all_empty', 0
UNION ALL SELECT 'exported_if_one_empty', 4""",
        _ZONES,
    ),
    "publish_current_roundtrip": _sql(f"{_MART}, '2024-02-01 00:01:00' AS \"timestamp\" FROM congestion", _ZONES),
    "publish_history_roundtrip": _sql(
        f"""{_MART}, '2024-02-01 00:00:00' AS "timestamp" FROM congestion
UNION ALL {_MART}, '2024-02-01 00:01:00' FROM congestion""",
        _ZONES,
    ),
    "dashboard_published": _sql(
        f"""SELECT 'zone_table' AS panel, zone AS label, {_round2('vehicle_count_avg')} AS "value" FROM traffic
UNION ALL SELECT 'speed_series', road_type, speed_avg_kmh FROM speed, range(2)
UNION ALL SELECT 'vehicle_series', zone, vehicle_count_avg FROM traffic, range(2)
UNION ALL SELECT 'occupancy_series', zone, occupancy_rate_avg FROM traffic, range(2)
UNION ALL SELECT 'vehicles', 'all', {_round2('avg(vehicle_count_avg)')} FROM traffic
UNION ALL SELECT 'occupancy', 'all', {_round2('avg(occupancy_rate_avg)')} FROM traffic
UNION ALL SELECT 'speed', 'all', {_round2('avg(speed_avg_kmh)')} FROM speed
UNION ALL SELECT 'alert_zones', 'all', CAST(count(*) AS double) FROM congestion WHERE congestion_rate_pct > 50""",
        _ZONES,
        _ROADS,
    ),
    "continuous_refresh": _sql("SELECT * FROM summary", _ZONES),
    "incremental_chain": _sql("SELECT *, '2024-02-01 00:01:00' AS \"timestamp\" FROM speed", _ROADS),
    "batch_chain": _sql("SELECT *, '2024-02-01 00:00:00' AS \"timestamp\" FROM summary", _ZONES),
}

_FIRST, _SECOND = "2024-02-01 00:00:00", "2024-02-01 00:01:00"


def _beside(parts: list[tuple[str, str, str]], moment: str) -> str:
    """All rows of several statements, each given as table name, key of its SQL and time."""
    return "\nUNION ALL BY NAME\n".join(
        f"SELECT '{table}' AS table_name, '{time}' AS \"{moment}\", * FROM ({ORACLE[key]})" for table, key, time in parts
    )


_MART_SQL = {
    "traffic_by_zone": "zone_traffic_analytics",
    "speed_by_road": "road_speed_analytics",
    "congestion_alerts": "zone_congestion_analytics",
    "mobility_summary": "mobility_summary",
}
_PROCESSED_SQL = {
    "traffic_by_zone": "zone_traffic_processed",
    "speed_by_road": "road_speed_processed",
    "congestion_alerts": "zone_congestion_processed",
}
ORACLE["processed_tables"] = _beside([(name, key, _FIRST) for name, key in _PROCESSED_SQL.items()], "processed_date")
ORACLE["published_tables"] = _beside(
    [(name, key, _SECOND) for name, key in _MART_SQL.items()]
    + [(f"{name}_ts", key, time) for name, key in _MART_SQL.items() for time in (_FIRST, _SECOND)],
    "timestamp",
)
