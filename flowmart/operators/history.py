"""Replay of the history tables for past cut-offs.

The history tables grow by one row per key and run, holding the mean over everything seen up to that run. There are
two replays. replay_zones and replay_roads rebuild daily cut-offs from daily partials. replay_zones_at and
replay_roads_at rebuild any given cut-offs, such as the moments of the runs, along any time axis: along the event time an
event that came late is counted from its own time on; along the time of landing (sources.raw.read_arrivals) from when it
came, as the runs themselves saw it.

Give the daily replay partials that are stored (store_partials, workspace.written): they are read twice, once for the last day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions import bands
from flowmart.functions.numbers import PARTS, merged_sum, numeric2, partial_mean, partial_sum
from flowmart.operators.aggregates import ROAD_KEYS, ROAD_METRICS, ZONE_METRICS
from flowmart.workspace import written

CHUNK = 1440  # cut-offs whose running sums are made by one task for a key: a day of runs a minute apart


def _cumulative(
    partials: DataFrame, keys: tuple, metrics: tuple, first: date | None, through: date | None
) -> DataFrame:
    """Running sums per key with one row for each calendar day from the key's first day to the last day of all.

    Running sums exist for days with events; each is then repeated up to the day before the next one. So days
    without events get their row without joining days with keys. The window sorts one row per day and key, a
    number bounded by the calendar. Events without a day count in every cut-off, as if they were of the first day
    of all: a key that has no others is seen from then on.
    """
    dated = partials.withColumn("day", F.col("date").try_cast("date"))
    last_day = dated.agg(F.max("day")).scalar() if through is None else F.lit(through)
    first_day = dated.agg(F.min("day")).scalar()
    added = [column for metric in metrics for column in merged_sum(metric)]
    daily = dated.groupBy(*keys, F.coalesce("day", first_day).alias("day")).agg(*added)
    in_order = Window.partitionBy(*keys).orderBy("day")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [column for metric in metrics for column in merged_sum(metric, so_far)]
    running = daily.select(*keys, "day", *sums, F.lead("day").over(in_order).alias("next_day"))
    start = F.col("day") if first is None else F.greatest("day", F.lit(first))
    until = F.least(F.date_sub("next_day", 1), last_day)
    shown = running.where(F.col("day").isNotNull() & (start <= until))
    return shown.withColumn("cutoff_day", F.explode(F.sequence(start, until))).withColumn(
        "timestamp", F.date_add("cutoff_day", 1).cast("timestamp_ntz")
    )


def _zone_rows(sums: DataFrame) -> DataFrame:
    """Rows of traffic_by_zone_ts from running sums."""
    occupancy = F.col("occupancy_rate_avg")
    means = sums.select(
        "zone",
        numeric2(partial_mean("vehicle_count")).alias("vehicle_count_avg"),
        numeric2(partial_mean("occupancy_rate")).alias("occupancy_rate_avg"),
        "timestamp",
    )
    level = bands.traffic_level(occupancy).alias("traffic_level")
    return means.select("zone", "vehicle_count_avg", "occupancy_rate_avg", level, "timestamp")


def _road_rows(sums: DataFrame) -> DataFrame:
    """Rows of speed_by_road_ts from running sums."""
    speed = F.col("speed_avg_kmh")
    means = sums.select(*ROAD_KEYS, numeric2(partial_mean("average_speed")).alias("speed_avg_kmh"), "timestamp")
    return means.select(*ROAD_KEYS, speed, bands.speed_category(speed).alias("speed_category"), "timestamp")


def replay_zones(partials: DataFrame, first: date | None = None, through: date | None = None) -> DataFrame:
    """Rows of traffic_by_zone_ts at the end of each day, from daily_zone_partials.

    first and through limit the cut-offs that are shown, not what they count; give them where a single event with an
    absurd year would stretch the calendar.
    """
    return _zone_rows(_cumulative(partials, ("zone",), ZONE_METRICS, first, through))


def replay_roads(partials: DataFrame, first: date | None = None, through: date | None = None) -> DataFrame:
    """Rows of speed_by_road_ts at the end of each day, from daily_road_partials; limits as in replay_zones."""
    return _road_rows(_cumulative(partials, ROAD_KEYS, ROAD_METRICS, first, through))


def replay_zones_at(events: DataFrame, cutoffs: DataFrame, moment: str = "event_time") -> DataFrame:
    """Rows of traffic_by_zone_ts at given cut-offs (column `timestamp`): means over the events whose `moment` is not
    later. Zones have rows from the first cut-off on that counts an event of theirs."""
    return _zone_rows(_running_at(events, ("zone",), ZONE_METRICS, cutoffs, moment))


def replay_roads_at(events: DataFrame, cutoffs: DataFrame, moment: str = "event_time") -> DataFrame:
    """Rows of speed_by_road_ts at given cut-offs, as replay_zones_at."""
    return _road_rows(_running_at(events, ROAD_KEYS, ROAD_METRICS, cutoffs, moment))


def _days_before(counts: DataFrame) -> DataFrame:
    """(day, before): how many cut-offs lie before each day. One row per day, as many as the calendar has."""
    in_order = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return counts.groupBy("day").agg(F.sum("marks").alias("here")).select(
        "day", F.coalesce(F.sum("here").over(in_order), F.lit(0)).alias("before")
    )


def _slots(events: DataFrame, keys: tuple, metrics: tuple, marks: DataFrame, moment: str) -> DataFrame:
    """Sums per key and slot, the number of the first cut-off that counts an event.

    Each event only needs the cut-offs of its own minute, few of many; then it is summed by key, minute and place among
    these. What cut-offs lie before the minute is found by an as-of merge: both tables in one, in the order of time, with
    the count carried over. The merge is split by day, so no task holds more than the minutes and keys of one.
    """
    in_minute = marks.groupBy("minute").agg(F.collect_list("timestamp").alias("here"))
    minute = F.date_trunc("minute", F.col(moment)).cast(marks.schema["minute"].dataType)
    earlier = F.size(F.filter("here", lambda mark: mark < F.col(moment)))
    sums = [column for metric in metrics for column in partial_sum(metric)]
    used = events.select(*keys, *metrics, moment).withColumn("minute", minute)
    reduced = (
        used.join(in_minute, "minute", "left")
        .withColumn("place", F.when(F.col("here").isNotNull(), earlier).otherwise(0))
        .groupBy(*keys, "minute", "place")
        .agg(*sums)
    )
    counted = marks.groupBy("minute").agg(F.count("*").alias("marks"))
    merged = reduced.withColumn("marks", F.lit(0).cast("bigint")).unionByName(
        counted.withColumn("is_mark", F.lit(1)), allowMissingColumns=True
    )
    merged = merged.withColumn("day", F.col("minute").cast("date"))
    in_order = Window.partitionBy("day").orderBy("minute", F.asc_nulls_first("is_mark"))
    carried = F.sum("marks").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = _days_before(merged.select("day", "marks"))
    placed = merged.withColumn("carried", carried).where("is_mark IS NULL").join(before, "day", "left")
    # Events without a moment count in every cut-off.
    slot = F.when(F.col("minute").isNull(), F.lit(0)).otherwise(F.col("before") + F.col("carried") + F.col("place"))
    added = [column for metric in metrics for column in merged_sum(metric)]
    return placed.groupBy(*keys, slot.cast("bigint").alias("slot")).agg(*added)


def _running_at(events: DataFrame, keys: tuple, metrics: tuple, cutoffs: DataFrame, moment: str) -> DataFrame:
    """Running sums per key at every cut-off from the key's first one on, with its `timestamp`.

    Cut-offs are numbered, and cut into chunks. Sums run over the chunks of a key, then within each chunk, so a key is
    split over as many tasks as there are chunks, and each sum is repeated up to the next slot that changes it. The rows that come out
    are those of the history: one per key and cut-off.
    """
    marks = cutoffs.select("timestamp").distinct().where(F.col("timestamp").isNotNull())
    marks = marks.withColumn("minute", F.date_trunc("minute", "timestamp").cast(marks.schema["timestamp"].dataType))
    marks = written(marks.withColumn("day", F.col("minute").cast("date")), "cutoffs")
    nth = F.row_number().over(Window.partitionBy("day").orderBy("timestamp")) - 1
    before = _days_before(marks.select("day", F.lit(1).alias("marks")))
    numbered = marks.withColumn("nth", nth).join(before, "day").select((F.col("before") + F.col("nth")).alias("slot"), "timestamp")
    last = marks.agg(F.count("*") - 1).scalar()

    def added(over=None):
        return [column for metric in metrics for column in merged_sum(metric, over)]

    names = [f"{metric}_{part}" for metric in metrics for part in PARTS]
    slots = _slots(events, keys, metrics, marks, moment).where(F.col("slot") <= last)
    slots = written(slots.withColumn("chunk", F.floor(F.col("slot") / CHUNK)), "slots")
    by_chunk = Window.partitionBy(*keys).orderBy("chunk")
    sums = slots.groupBy(*keys, "chunk").agg(*added())
    # What a chunk hands on goes to every chunk up to the next one with events, as its first slot.
    handed = sums.select(
        *keys,
        *added(by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        (F.col("chunk") + 1).alias("first"),
        F.least(F.lead("chunk").over(by_chunk), F.floor(last / CHUNK)).alias("final"),
    ).where("first <= final")
    handed = handed.withColumn("chunk", F.explode(F.sequence("first", "final"))).withColumn("slot", F.col("chunk") * CHUNK)
    every = slots.select(*keys, "chunk", "slot", *names).unionByName(handed.select(*keys, "chunk", "slot", *names))
    in_chunk = Window.partitionBy(*keys, "chunk").orderBy("slot")
    running = (
        every.groupBy(*keys, "chunk", "slot")
        .agg(*added())
        .select(
            *keys,
            *added(in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "slot",
            F.coalesce(F.lead("slot").over(in_chunk) - 1, F.least(F.col("chunk") * CHUNK + CHUNK - 1, last)).alias("until"),
        )
    )
    shown = running.withColumn("slot", F.explode(F.sequence("slot", "until")))
    return shown.join(numbered, "slot").drop("slot", "until")
