"""Classification of metrics into labels.

All rules are ordered threshold lists. A NULL metric fails every comparison and takes the last label of its list;
NaN compares above every number, so it takes the highest band. Classify rounded values: 80.004 is shown as 80.0
and must be labelled as 80.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmart.schema import ROAD_TYPES

# Fixed values: (limit, label) in test order, then the label of the rest.
STATUS = (((80, "CRITICAL CONGESTION"), (50, "HIGH CONGESTION")), "MODERATE CONGESTION")
TRAFFIC_LEVEL = (((20, "FAIBLE"), (50, "MODERÉ"), (80, "ÉLEVÉ")), "CRITIQUE")
SPEED_CATEGORY = (((80, "RAPIDE"), (50, "NORMALE"), (30, "LENTE")), "TRÈS_LENTE")
CONGESTION_PRIORITY = (((80, "URGENTE"), (50, "HAUTE"), (30, "MODERÉE")), "FAIBLE")
ALERT_STATUS = (((50, "ALERTE"),), "NORMAL")
OCCUPANCY_BAND = (((80, "red"), (60, "orange"), (30, "yellow")), "green")
SPEED_BAND = (((50, "green"), (30, "yellow")), "red")
ALERT_COUNT_BAND = (((3, "red"), (2, "orange"), (1, "yellow")), "green")
FLOW_REGIME = (((90, "critical"), (70, "dense")), "free")
LEVEL_COLOUR = {"CRITIQUE": "red", "ÉLEVÉ": "orange", "MODERÉ": "yellow", "FAIBLE": "green"}
PEAK_HOURS = ((7, 9), (17, 19))
MEDIUM_HOURS = ((10, 16),)


def _label(value: Column, bands: tuple, test) -> Column:
    steps, rest = bands
    label = F
    for limit, name in steps:
        label = label.when(test(value, limit), name)
    return label.otherwise(rest)


def _above(value: Column, bands: tuple) -> Column:
    return _label(value, bands, lambda v, limit: v > limit)


def _below(value: Column, bands: tuple) -> Column:
    return _label(value, bands, lambda v, limit: v < limit)


def _from(value: Column, bands: tuple) -> Column:
    return _label(value, bands, lambda v, limit: v >= limit)


def status(rate: Column) -> Column:
    return _above(rate, STATUS)


def traffic_level(occupancy: Column) -> Column:
    return _below(occupancy, TRAFFIC_LEVEL)


def speed_category(speed: Column) -> Column:
    return _above(speed, SPEED_CATEGORY)


def congestion_priority(rate: Column) -> Column:
    return _above(rate, CONGESTION_PRIORITY)


def alert_status(rate: Column) -> Column:
    return _above(rate, ALERT_STATUS)


def occupancy_band(value: Column) -> Column:
    """Severity colour of an occupancy or congestion percentage."""
    return _from(value, OCCUPANCY_BAND)


def speed_band(value: Column) -> Column:
    return _from(value, SPEED_BAND)


def alert_count_band(value: Column) -> Column:
    return _from(value, ALERT_COUNT_BAND)


def level_colour(level: Column) -> Column:
    """Colour of a traffic level label; NULL for a label that has none."""
    colour = F
    for name, shade in LEVEL_COLOUR.items():
        colour = colour.when(level == name, shade)
    return colour


def flow_regime(occupancy: Column) -> Column:
    return _from(occupancy, FLOW_REGIME)


def _within(hour: Column, ranges: tuple) -> Column:
    hit = F.lit(False)
    for first, last in ranges:
        hit = hit | hour.between(first, last)
    return hit


def time_band(event_time: Column) -> Column:
    """peak 7-9 h and 17-19 h, medium 10-16 h, else calm; both ends of a range belong to it."""
    hour = F.hour(event_time)
    return F.when(_within(hour, PEAK_HOURS), "peak").when(_within(hour, MEDIUM_HOURS), "medium").otherwise("calm")


def _limit(road_type: Column, position: int) -> Column:
    value = F
    for name, limits in ROAD_TYPES.items():
        value = value.when(road_type == name, limits[position])
    return value


def capacity(road_type: Column) -> Column:
    """Vehicle capacity of a road type, NULL for an unknown one."""
    return _limit(road_type, 1)


def top_speed(road_type: Column) -> Column:
    """Highest speed a sensor of that road type may report, NULL for an unknown one."""
    return _limit(road_type, 2)
