"""Registered queries: name -> function of (session, folder of the input tables).

All of them start from the sensor events of the folder. Operators that read or write files, streams and tables are
registered as round trips: the events go in, the rows read back come out. Published times are fixed values, so that
results do not depend on the clock.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.functions import events as ev
from flowmart.functions.numbers import numeric2
from flowmart.operators import aggregates as agg
from flowmart.operators import compaction, history, marts, panels, quality
from flowmart.plans import batch
from flowmart.plans.dashboard import dashboard
from flowmart.schema import ANALYTICS, PROCESSED, RAW_EVENT, ZONES, columns_of
from flowmart.sinks.lake import LakeTarget
from flowmart.sinks.publish import publish
from flowmart.sources import raw, tables
from flowmart.sources.sensor_table import sensor_events
from flowmart.streaming.landing import land, routed
from flowmart.streaming.refresh import refresh
from flowmart.workspace import new_folder, written

FIRST_RUN = datetime(2024, 2, 1, 0, 0, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 2, 1, 0, 1, tzinfo=timezone.utc)
RANGE_END = datetime(2024, 1, 20, 3, 0)
ONCE = {"availableNow": True}


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    return agg.zone_means(sensor_events(spark, folder))


def zone_traffic_analytics(spark: SparkSession, folder: str) -> DataFrame:
    return marts.traffic_mart(agg.traffic_by_zone(_zones(spark, folder)))


def zone_congestion_analytics(spark: SparkSession, folder: str) -> DataFrame:
    return marts.congestion_mart(agg.congestion_by_zone(_zones(spark, folder)))


def road_speed_analytics(spark: SparkSession, folder: str) -> DataFrame:
    return marts.speed_mart(agg.road_means(sensor_events(spark, folder)))


# --- processed and analytics tables


def zone_traffic_processed(spark, folder):
    return agg.traffic_by_zone(_zones(spark, folder))


def road_speed_processed(spark, folder):
    return agg.road_means(sensor_events(spark, folder))


def zone_congestion_processed(spark, folder):
    return agg.congestion_by_zone(_zones(spark, folder))


def mobility_summary(spark, folder):
    """Both zone marts come from one written aggregate, so the events are read once."""
    zones = written(_zones(spark, folder), "zone-means")
    return marts.mobility_summary(
        marts.traffic_mart(agg.traffic_by_zone(zones)),
        marts.congestion_mart(agg.congestion_by_zone(zones)),
    )


def single_sweep(spark, folder):
    """All group means of zones and roads from one scan."""
    return agg.sweep(sensor_events(spark, folder))


# --- current panels


def panel_zone_table(spark, folder):
    return panels.zone_table(zone_traffic_analytics(spark, folder))


def kpi_vehicles(spark, folder):
    return panels.global_mean(zone_traffic_analytics(spark, folder), "vehicle_count_avg")


def kpi_occupancy(spark, folder):
    return panels.global_mean(zone_traffic_analytics(spark, folder), "occupancy_rate_avg")


def kpi_speed(spark, folder):
    return panels.global_mean(road_speed_analytics(spark, folder), "speed_avg_kmh")


def kpi_alert_zones(spark, folder):
    return panels.alert_zones(zone_congestion_analytics(spark, folder))


def kpi_weighted(spark, folder):
    return panels.weighted_means(sensor_events(spark, folder))


def kpi_bands(spark, folder):
    processed = agg.processed_tables(written(agg.sweep(sensor_events(spark, folder)), "sweep"))
    return panels.kpi_bands(
        marts.traffic_mart(processed["traffic_by_zone"]),
        marts.speed_mart(processed["speed_by_road"]),
        marts.congestion_mart(processed["congestion_alerts"]),
    )


# --- history and series panels


def _zone_partials(spark, folder):
    return written(agg.daily_zone_partials(raw.dated(sensor_events(spark, folder))), "zone-days")


def _road_partials(spark, folder):
    return written(agg.daily_road_partials(raw.dated(sensor_events(spark, folder))), "road-days")


def history_replay_zone(spark, folder):
    return history.replay_zones(_zone_partials(spark, folder))


def history_replay_road(spark, folder):
    return history.replay_roads(_road_partials(spark, folder))


def _runs(spark: SparkSession) -> DataFrame:
    """The cut-offs of a day of runs, one a minute."""
    first, last = (F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in (20, 21))
    every = F.sequence(first, last, F.expr("INTERVAL 60 SECONDS"))
    return spark.range(1).select(F.explode(every).alias("timestamp"))


def history_replay_zone_runs(spark, folder):
    """The zone history of a day as runs every 60 seconds would have appended it, over all events."""
    return history.replay_zones_at(sensor_events(spark, folder), _runs(spark))


def history_replay_road_runs(spark, folder):
    return history.replay_roads_at(sensor_events(spark, folder), _runs(spark))


def history_by_arrival(spark, folder):
    """The second half of the month lands and is published, then the older days. The runs replayed by the time of landing
    stand beside what the refresh job appended; `appended` says that its history has just this row."""
    events = sensor_events(spark, folder)
    older = F.coalesce(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    root, state = new_folder(spark, "landed"), new_folder(spark, "refresh-state")
    inbox, landing = new_folder(spark, "inbox"), new_folder(spark, "landing-state")
    target = LakeTarget(spark, new_folder(spark, "published"))
    for arrived in (events.where(~older), events.where(older)):
        _as_message(arrived).write.mode("append").text(inbox)
        land(raw.file_lines(spark, inbox), root, landing, ONCE).awaitTermination()
        refresh(raw.landed_stream(spark, root), target, state, ONCE).awaitTermination()
    appended = written(target.history("traffic_by_zone"), "appended")
    replayed = history.replay_zones_at(raw.read_arrivals(spark, root), appended.select("timestamp"), "landed_at")
    columns = ["zone", "vehicle_count_avg", "occupancy_rate_avg", "traffic_level"]
    runs = appended.select("timestamp").distinct()
    number = F.count("*").over(Window.orderBy("timestamp")).alias("run")  # two runs
    both = replayed.withColumn("r", F.lit(1)).unionByName(appended.withColumn("r", F.lit(0)))
    same = both.groupBy("timestamp", *columns).agg(F.sum("r").alias("replayed"), (F.count("*") - F.sum("r")).alias("appended"))
    return same.join(runs.select("timestamp", number), "timestamp").select(
        "run", *columns, ((F.col("replayed") == 1) & (F.col("appended") == 1)).alias("appended")
    )


def panel_speed_ts(spark, folder):
    return panels.speed_series(history_replay_road(spark, folder))


def panel_vehicles_ts(spark, folder):
    return panels.vehicle_series(history_replay_zone(spark, folder))


def panel_occupancy_ts(spark, folder):
    return panels.occupancy_series(history_replay_zone(spark, folder))


def panel_occupancy_wide(spark, folder):
    """A column for each zone of the schema."""
    return panels.occupancy_wide(history_replay_zone(spark, folder), ZONES)


def panel_occupancy_map(spark, folder):
    """All zones of a time in one row, whatever their names: labels and rates side by side."""
    series = panels.occupancy_map(history_replay_zone(spark, folder))
    return series.select(
        "time", F.map_keys("zones").alias("zones"), F.map_values("zones").alias("taux_occupation"), "no_zone"
    )


def panel_speed_by_type(spark, folder):
    return panels.speed_by_type(history_replay_road(spark, folder))


def panel_range_filter(spark, folder):
    """The range is cut out of a published history, where it prunes directories and row groups."""
    target = LakeTarget(spark, new_folder(spark, "published"))
    target.append("traffic_by_zone", history_replay_zone(spark, folder), FIRST_RUN, "replay")
    return panels.occupancy_series(target.history("traffic_by_zone", RANGE_END))


def kpi_last_not_null(spark, folder):
    return panels.last_not_null(history_replay_zone(spark, folder), "occupancy_rate_avg", "zone")


def incremental_zone_means(spark, folder):
    """Partials of the events without errors first; then the error events arrive and their days are recomputed."""
    events = raw.dated(sensor_events(spark, folder))
    late = F.col("event_type").eqNullSafe("error")
    stored = new_folder(spark, "partials")
    agg.store_partials(agg.daily_sweep(events.where(~late)), stored)
    agg.refresh_partials(events, events.where(late).select("date"), stored)
    means = agg.merge_partials(spark.read.parquet(stored)).where(F.col("grain") == "zone")
    return means.select("zone", "avg_vehicle_count", "avg_occupancy_rate", "measurements_count")


# --- profiles and checks of the events


def time_band_profile(spark, folder):
    return _rounded(quality.time_band_profile(sensor_events(spark, folder)))


def flow_regime_profile(spark, folder):
    return _rounded(quality.flow_regime_profile(sensor_events(spark, folder)))


def _rounded(profile: DataFrame) -> DataFrame:
    means = [name for name in profile.columns if name.startswith("avg_")]
    return profile.withColumns({name: numeric2(F.col(name)) for name in means})


def road_load_ratio(spark, folder):
    loaded = quality.road_load(sensor_events(spark, folder))
    return loaded.select("event_id", "road_type", "max_speed", "capacity", "vehicle_count", "load_ratio")


def contract_violations(spark, folder):
    return quality.contract_violations(sensor_events(spark, folder))


# --- landing and files


def _message() -> Column:
    """An event as JSON text, its time in ISO form."""
    iso = F.translate(F.col("event_time").cast("string"), " ", "T").alias("event_time")
    return ev.encode([iso if name == "event_time" else name for name in columns_of(RAW_EVENT)])


def _as_message(events: DataFrame) -> DataFrame:
    return events.select(_message().alias("value"))


def _landed(spark: SparkSession, *inboxes: DataFrame) -> str:
    """Land message tables through the stream, one run after the other on one checkpoint; returns the lake root."""
    inbox, root, checkpoint = (new_folder(spark, label) for label in ("inbox", "landed", "landing-state"))
    for messages in inboxes:
        messages.write.mode("append").text(inbox)
        land(raw.file_lines(spark, inbox), root, checkpoint, ONCE).awaitTermination()
    return root


def _zone_census(events: DataFrame) -> DataFrame:
    return events.groupBy("zone").agg(
        F.count("*").alias("events"), F.round(F.avg("occupancy_rate"), 2).alias("avg_occupancy_rate")
    )


def landing_partitions(spark, folder):
    messages = _as_message(sensor_events(spark, folder))
    return routed(messages).groupBy("date", "zone").agg(F.count("*").alias("events"))


def landing_stream_roundtrip(spark, folder):
    root = _landed(spark, _as_message(sensor_events(spark, folder)))
    return _zone_census(raw.read_raw(spark, root))


def late_event_roundtrip(spark, folder):
    """The second half of the month lands first, the older days come in a second run."""
    events = sensor_events(spark, folder)
    older = F.coalesce(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    root = _landed(spark, _as_message(events.where(~older)), _as_message(events.where(older)))
    return _zone_census(raw.read_landed(spark, root))


def quarantine_split(spark, folder):
    """Error events lose their zone, signups their time, views their closing brace; the others are sound."""

    def unless(kind: str, value: Column) -> Column:
        return F.when(~F.col("event_type").eqNullSafe(kind), value)

    spoiled = sensor_events(spark, folder).withColumns(
        {"zone": unless("error", F.col("zone")), "event_time": unless("signup", F.col("event_time"))}
    )
    cut = F.regexp_replace(_message(), r"\}$", "")
    root = _landed(spark, spoiled.select(F.coalesce(unless("view", _message()), cut).alias("value")))
    return raw.landed_lines(spark, root).groupBy("outcome").agg(F.count("*").alias("events"))


def landing_violations(spark, folder):
    """Violations by rule as the landing counted them in its one pass."""
    inbox, root, checkpoint = (new_folder(spark, label) for label in ("inbox", "landed", "landing-state"))
    _as_message(sensor_events(spark, folder)).write.text(inbox)
    query = land(raw.file_lines(spark, inbox), root, checkpoint, ONCE, checked=True)
    query.awaitTermination()
    counted = quality.observed_violations(query.recentProgress)
    checked = counted.pop("checked", 0)
    return spark.createDataFrame([(rule, checked, n) for rule, n in counted.items()], "rule string, checked bigint, violations bigint")


def compacted_counts(spark, folder):
    root = _landed(spark, _as_message(sensor_events(spark, folder)))
    target = new_folder(spark, "compacted")
    compaction.compact(spark, root, target)
    return compaction.read_compacted(spark, target).groupBy("date", "zone").agg(F.count("*").alias("events"))


def late_compaction_counts(spark, folder):
    """Compacted after the second half of the month, and again after the older days: only bins with new files are written
    anew, and the tree holds every event once."""
    events = sensor_events(spark, folder)
    older = F.coalesce(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    inbox, root, checkpoint = (new_folder(spark, label) for label in ("inbox", "landed", "landing-state"))
    target = new_folder(spark, "compacted")
    for arrived in (events.where(~older), events.where(older)):
        _as_message(arrived).write.mode("append").text(inbox)
        land(raw.file_lines(spark, inbox), root, checkpoint, ONCE).awaitTermination()
        compaction.compact(spark, root, target, 4 * compaction.OPEN_BYTES)
    return compaction.read_compacted(spark, target).groupBy("date", "zone").agg(F.count("*").alias("events"))


def typed_layer_roundtrip(spark, folder):
    root = _landed(spark, _as_message(sensor_events(spark, folder)))
    target = new_folder(spark, "typed")
    compaction.build_typed_layer(spark, root, target)
    days = raw.read_typed(spark, target).groupBy("date")
    return days.agg(F.count("*").alias("events"), F.max("event_time").alias("last_event"))


def processed_roundtrip(spark, folder):
    root = new_folder(spark, "processed")
    batch.write_processed(sensor_events(spark, folder), root, FIRST_RUN)
    back = tables.read_table(spark, f"{root}/congestion_alerts", PROCESSED["congestion_alerts"])
    return back.withColumn("processed_date", _utc_text("processed_date"))


def _beside(named: dict[str, DataFrame], moment: str) -> DataFrame:
    """All rows of several tables, columns that a table lacks as NULL, the moment as text in UTC."""
    marked = [
        frame.withColumn(moment, _utc_text(moment)).withColumn("table_name", F.lit(name))
        for name, frame in named.items()
    ]
    return reduce(lambda upper, lower: upper.unionByName(lower, allowMissingColumns=True), marked)


def processed_tables(spark, folder):
    """The three processed tables as they were written."""
    root = new_folder(spark, "processed")
    batch.write_processed(sensor_events(spark, folder), root, FIRST_RUN)
    return _beside(tables.read_processed(spark, root), "processed_date")


def _utc_text(column: str):
    """A moment as text in UTC, whatever the time zone of the session."""
    return F.to_utc_timestamp(F.col(column), F.current_timezone()).cast("string")


def road_partition_roundtrip(spark, folder):
    lake = new_folder(spark, "lake")
    batch.write_processed(sensor_events(spark, folder), f"{lake}/processed", FIRST_RUN)
    batch.write_analytics(spark, f"{lake}/processed", f"{lake}/analytics", FIRST_RUN)
    back = tables.read_table(spark, f"{lake}/analytics/speed_by_road", ANALYTICS["speed_by_road"])
    return back.drop("processed_date")


def tolerant_scan(spark, folder):
    """Events beside a text file that is no Parquet."""
    path = new_folder(spark, "events-and-junk")
    events = sensor_events(spark, folder)
    events.write.parquet(path)
    events.select(F.col("zone").alias("value")).write.mode("append").text(path)
    readable = tables.tolerant_scan(spark, path, events.schema)
    return agg.traffic_by_zone(agg.zone_means(readable))


def tolerant_scan_audit(spark, folder):
    """Events beside a text file and an intact file without rows: rows read, and files passed over by their ending."""
    path = new_folder(spark, "events-and-junk")
    events = sensor_events(spark, folder)
    events.write.parquet(path)
    events.select(F.col("zone").alias("value")).coalesce(1).write.mode("append").text(path)
    events.limit(0).coalesce(1).write.mode("append").parquet(path)
    ending = F.regexp_extract("file", "[.]([a-z]+)$", 1).alias("fact")
    skipped = tables.skipped_files(spark, path, events.schema).groupBy(ending).agg(F.count("*").alias("value"))
    read = tables.tolerant_scan(spark, path, events.schema).agg(F.lit("rows").alias("fact"), F.count("*").alias("value"))
    return read.unionByName(skipped)


def read_or_empty(spark, folder):
    """Rows of a written and of a missing mart, and the tables an export of both, and of the missing one, writes."""
    root = new_folder(spark, "analytics")
    schema = ANALYTICS["traffic_by_zone"]
    marts.stamped(zone_traffic_analytics(spark, folder), FIRST_RUN).write.parquet(f"{root}/traffic_by_zone")
    present = tables.read_or_empty(spark, f"{root}/traffic_by_zone", schema)
    missing = tables.read_or_empty(spark, f"{root}/congestion_alerts", ANALYTICS["congestion_alerts"])
    target = LakeTarget(spark, new_folder(spark, "published"))
    nothing = publish({"congestion_alerts": missing}, target, FIRST_RUN)
    both = publish({"traffic_by_zone": present, "congestion_alerts": missing}, target, FIRST_RUN)

    def fact(name, value):
        return value.select(F.lit(name).alias("fact"), F.col("value").cast("bigint").alias("value"))

    return (
        fact("rows_present", present.agg(F.count("*").alias("value")))
        .unionByName(fact("rows_missing", missing.agg(F.count("*").alias("value"))))
        .unionByName(fact("exported_if_all_empty", spark.range(1).select(F.lit(len(nothing)).alias("value"))))
        .unionByName(fact("exported_if_one_empty", spark.range(1).select(F.lit(len(both)).alias("value"))))
    )


# --- publishing


def _publish_runs(spark, folder, target, runs) -> None:
    """The events are swept once; every run publishes marts of its own time from that."""
    processed = agg.processed_tables(written(agg.sweep(sensor_events(spark, folder)), "sweep"))
    for run in runs:
        publish(marts.analytics_tables(processed, run), target, run)


def publish_current_roundtrip(spark, folder):
    """Published twice: the current table holds the mart once."""
    target = LakeTarget(spark, new_folder(spark, "published"))
    _publish_runs(spark, folder, target, (FIRST_RUN, SECOND_RUN))
    return target.current("congestion_alerts").withColumn("timestamp", _utc_text("timestamp"))


def publish_history_roundtrip(spark, folder):
    """Two runs, the second published twice: the history holds each run once."""
    target = LakeTarget(spark, new_folder(spark, "published"))
    _publish_runs(spark, folder, target, (FIRST_RUN, SECOND_RUN, SECOND_RUN))
    return target.history("congestion_alerts").withColumn("timestamp", _utc_text("timestamp"))


def published_tables(spark, folder):
    """All eight published tables after two runs, the second published twice."""
    target = LakeTarget(spark, new_folder(spark, "published"))
    _publish_runs(spark, folder, target, (FIRST_RUN, SECOND_RUN, SECOND_RUN))
    shown = target.pinned()
    current = {name: shown.current(name) for name in ANALYTICS}
    history = {f"{name}_ts": shown.history(name) for name in ANALYTICS}
    return _beside(current | history, "timestamp")


def dashboard_published(spark, folder):
    """The eight panels over published tables, as one list of points."""
    target = LakeTarget(spark, new_folder(spark, "published"))
    _publish_runs(spark, folder, target, (FIRST_RUN - 2 * panels.DASHBOARD_RANGE, FIRST_RUN, SECOND_RUN))
    shown = dashboard(target, SECOND_RUN)
    labels = {"zone_table": "zone", "speed_series": "road_type", "vehicle_series": "zone", "occupancy_series": "zone"}
    values = {
        "zone_table": "vehicules_moyens",
        "speed_series": "vitesse_moyenne",
        "vehicle_series": "vehicules_moyens",
        "occupancy_series": "taux_occupation",
        "alert_zones": "count",
    }
    points = [
        panel.select(
            F.lit(name).alias("panel"),
            (F.col(labels[name]) if name in labels else F.lit("all")).alias("label"),
            F.col(values.get(name, "avg")).cast("double").alias("value"),
        )
        for name, panel in shown.items()
    ]
    return reduce(DataFrame.unionByName, points)


def continuous_refresh(spark, folder):
    """Events as JSON files, streamed through the refresh; the published summary comes back."""
    inbox = new_folder(spark, "raw")
    _as_message(sensor_events(spark, folder)).write.text(inbox)
    target = LakeTarget(spark, new_folder(spark, "published"))
    refresh(raw.raw_stream(spark, inbox), target, new_folder(spark, "refresh-state"), ONCE).awaitTermination()
    return target.current("mobility_summary").drop("timestamp")


def batch_chain(spark, folder):
    """Raw JSON to published marts through all three stages; the published summary comes back."""
    lake = new_folder(spark, "lake")
    _as_message(sensor_events(spark, folder)).write.text(f"{lake}/raw")
    target = LakeTarget(spark, f"{lake}/published")
    batch.run_chain(raw.read_raw(spark, f"{lake}/raw"), lake, target, FIRST_RUN)
    return target.current("mobility_summary").withColumn("timestamp", _utc_text("timestamp"))


def incremental_chain(spark, folder):
    """Typed events stored by day; the second half of the month is published first, then the older days are added.
    The published road marts come back."""
    events = raw.dated(sensor_events(spark, folder)).drop("event_id", "event_type")
    typed, partials = new_folder(spark, "typed"), new_folder(spark, "partials")
    target = LakeTarget(spark, new_folder(spark, "published"))
    older = F.col("date") < "2024-01-16"
    for arrived, run in ((events.where(~older), FIRST_RUN), (events.where(older), SECOND_RUN)):
        arrived.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(typed)
        batch.run_incremental(raw.read_typed(spark, typed), arrived, partials, target, run)
    return target.current("speed_by_road").withColumn("timestamp", _utc_text("timestamp"))


REGISTERED = (
    zone_traffic_processed,
    road_speed_processed,
    zone_congestion_processed,
    zone_traffic_analytics,
    road_speed_analytics,
    zone_congestion_analytics,
    mobility_summary,
    single_sweep,
    panel_zone_table,
    kpi_vehicles,
    kpi_occupancy,
    kpi_speed,
    kpi_alert_zones,
    kpi_weighted,
    kpi_bands,
    history_replay_zone,
    history_replay_road,
    history_replay_zone_runs,
    history_replay_road_runs,
    history_by_arrival,
    panel_speed_ts,
    panel_vehicles_ts,
    panel_occupancy_ts,
    panel_occupancy_wide,
    panel_occupancy_map,
    panel_speed_by_type,
    panel_range_filter,
    kpi_last_not_null,
    incremental_zone_means,
    time_band_profile,
    flow_regime_profile,
    road_load_ratio,
    contract_violations,
    landing_partitions,
    landing_stream_roundtrip,
    late_event_roundtrip,
    quarantine_split,
    landing_violations,
    compacted_counts,
    late_compaction_counts,
    typed_layer_roundtrip,
    processed_roundtrip,
    processed_tables,
    road_partition_roundtrip,
    tolerant_scan,
    tolerant_scan_audit,
    read_or_empty,
    publish_current_roundtrip,
    publish_history_roundtrip,
    published_tables,
    dashboard_published,
    continuous_refresh,
    batch_chain,
    incremental_chain,
)
QUERIES = {query.__name__: query for query in REGISTERED}
