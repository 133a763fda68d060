"""Dashboard queries over the published tables.

Current panels take a current table, series panels take a history table. Series panels accept the dashboard's time
range: the filter is applied before everything else and reaches the source.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions.numbers import mean, numeric2

# Fixed values of the dashboard.
ALERT_RATE = 50
DASHBOARD_RANGE = timedelta(hours=6)


def in_range(history: DataFrame, to: datetime, span: timedelta = DASHBOARD_RANGE) -> DataFrame:
    """History rows of the last span up to and including `to`; a `to` without zone is a wall-clock time of the
    session."""
    kind = history.schema["timestamp"].dataType

    def bound(moment: datetime) -> Column:
        return F.lit(moment if moment.tzinfo else moment.isoformat(sep=" ")).cast(kind)

    return history.where(F.col("timestamp").between(bound(to - span), bound(to)))


def zone_table(traffic: DataFrame) -> DataFrame:
    """Zones with rounded metrics, busiest first; a zone without a mean comes before all others."""
    return traffic.orderBy(F.desc_nulls_first("vehicle_count_avg")).select(
        "zone",
        numeric2(F.col("vehicle_count_avg")).alias("vehicules_moyens"),
        numeric2(F.col("occupancy_rate_avg")).alias("taux_occupation"),
        "traffic_level",
    )


def _series(history: DataFrame, label: str, metric: str, name: str) -> DataFrame:
    return history.select(F.col("timestamp").alias("time"), label, F.col(metric).alias(name)).orderBy(
        F.asc_nulls_last("time")
    )


def speed_series(history: DataFrame) -> DataFrame:
    """One point per road and time, labelled with the type of the road."""
    return _series(history, "road_type", "speed_avg_kmh", "vitesse_moyenne")


def vehicle_series(history: DataFrame) -> DataFrame:
    return _series(history, "zone", "vehicle_count_avg", "vehicules_moyens")


def occupancy_series(history: DataFrame) -> DataFrame:
    return _series(history, "zone", "occupancy_rate_avg", "taux_occupation")


def occupancy_map(history: DataFrame) -> DataFrame:
    """Occupancy of all zones at a time in one row: time, `zones`, a map from zone to rate, and `no_zone`, the rate of events
    without a zone. The labels are data, so their number is not limited and nobody has to know them before."""
    at = history.groupBy(F.col("timestamp").alias("time"), "zone").agg(F.avg("occupancy_rate_avg").alias("rate"))
    named = F.when(F.col("zone").isNotNull(), F.struct("zone", "rate"))
    return (
        at.groupBy("time")
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(named))).alias("zones"),
            F.max(F.when(F.col("zone").isNull(), F.col("rate"))).alias("no_zone"),
        )
        .orderBy(F.asc_nulls_last("time"))
    )


def occupancy_wide(history: DataFrame, zones: tuple) -> DataFrame:
    """Occupancy with one column for each of the given zones; occupancy_map has all."""
    rates = [F.try_element_at("zones", F.lit(zone)).alias(zone) for zone in zones]
    return occupancy_map(history).select("time", *rates)


def speed_by_type(history: DataFrame) -> DataFrame:
    """Mean speed per road type and time: one line per type."""
    return (
        history.groupBy(F.col("timestamp").alias("time"), "road_type")
        .agg(numeric2(mean("speed_avg_kmh")).alias("vitesse_moyenne"))
        .orderBy(F.asc_nulls_last("time"))
    )


def global_mean(mart: DataFrame, metric: str) -> DataFrame:
    """Unweighted mean of the group means, the figure of the stat panels."""
    return mart.agg(numeric2(mean(metric)).alias("avg"))


def alert_zones(congestion: DataFrame) -> DataFrame:
    return congestion.where(F.col("congestion_rate_pct") > ALERT_RATE).agg(F.count("*").alias("count"))


def weighted_means(events: DataFrame) -> DataFrame:
    """Global means over all measurements: large zones count more, unlike in global_mean."""
    return events.agg(
        numeric2(mean("vehicle_count")).alias("vehicles"),
        numeric2(mean("occupancy_rate")).alias("occupancy"),
        numeric2(mean("average_speed")).alias("speed"),
        F.count("*").alias("measurements"),
    )


def last_not_null(history: DataFrame, metric: str, *labels: str) -> DataFrame:
    """Latest value of a metric that is not NULL, per series. Of several values at one time the greatest counts,
    so the result does not depend on row order."""
    # First one value per time, then the last time: both steps aggregate by hash, before and after their shuffle.
    moments = history.groupBy(*labels, F.col("timestamp").alias("_time")).agg(F.max(metric).alias("_value"))
    filled = F.when(F.col("_value").isNotNull(), F.col("_time"))
    return moments.groupBy(*labels).agg(F.max(filled).alias("time"), F.max_by("_value", filled).alias("value"))


def _figure(frame: DataFrame, kpi: str, label, value, band) -> DataFrame:
    return frame.select(
        F.lit(kpi).alias("kpi"), label.alias("label"), value.cast("double").alias("value"), band.alias("band")
    )


def kpi_bands(traffic: DataFrame, speed: DataFrame, congestion: DataFrame) -> DataFrame:
    """All coloured figures of the dashboard with their severity: the zone table and the stat panels."""
    occupancy, overall, count = numeric2(F.col("occupancy_rate_avg")), F.col("avg"), F.col("count")
    everywhere = F.lit("all")
    figures = [
        _figure(traffic, "zone_occupancy", F.col("zone"), occupancy, bands.occupancy_band(occupancy)),
        _figure(traffic, "zone_level", F.col("zone"), occupancy, bands.level_colour(F.col("traffic_level"))),
        _figure(
            global_mean(traffic, "occupancy_rate_avg"), "congestion", everywhere, overall, bands.occupancy_band(overall)
        ),
        _figure(global_mean(speed, "speed_avg_kmh"), "speed", everywhere, overall, bands.speed_band(overall)),
        _figure(alert_zones(congestion), "alert_zones", everywhere, count, bands.alert_count_band(count)),
    ]
    return reduce(DataFrame.unionByName, figures)
