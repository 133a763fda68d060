from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowmart.operators import aggregates as agg
from flowmart.operators import history, marts, panels
from flowmart.sources.raw import dated
from flowmart.sources.sensor_table import sensor_events
from tests.conftest import SMALL, rows


def small_history(spark, **limits):
    events = spark.createDataFrame(
        [
            ("a", 10, 10.0, date(2024, 1, 1)),
            ("a", 20, 30.0, date(2024, 1, 4)),
            ("b", 5, 50.0, date(2024, 1, 3)),
            (None, 1, None, date(2024, 1, 5)),
            ("a", 0, 80.0, None),
        ],
        "zone string, vehicle_count bigint, occupancy_rate double, event_time date",
    )
    return history.replay_zones(agg.daily_zone_partials(dated(events)), **limits)


def test_every_zone_seen_has_a_row_at_every_later_cutoff(spark):
    def end_of(day):
        return datetime(2024, 1, day + 1)

    # The undated event of zone a counts from the first cut-off on.
    assert rows(small_history(spark)) == sorted(
        [
            *[("a", 5.0, 45.0, "MODERÉ", end_of(day)) for day in (1, 2, 3)],
            *[("a", 10.0, 40.0, "MODERÉ", end_of(day)) for day in (4, 5)],
            *[("b", 5.0, 50.0, "ÉLEVÉ", end_of(day)) for day in (3, 4, 5)],
            (None, 1.0, None, "CRITIQUE", end_of(5)),
        ],
        key=repr,
    )


def test_limits_cut_the_calendar_and_not_the_sums(spark):
    whole = small_history(spark)
    for first, through in ((2, 3), (4, 9), (None, 1), (5, None)):
        limits = {name: day and date(2024, 1, day) for name, day in (("first", first), ("through", through))}
        got = rows(small_history(spark, **limits))
        days = range(first or 1, (through or 5) + 1)
        inside = [row for row in rows(whole) if row[-1].day - 1 in days]
        # A calendar that goes on after the last event repeats the last means.
        assert [row for row in got if row[-1].day - 1 <= 5] == inside


def _at(text):
    return datetime.fromisoformat(f"2024-01-{text}")


def _moments(spark):
    return spark.createDataFrame(
        [("a", 10, 10.0, _at("01T10:00:30")), ("a", 20, 30.0, _at("01T10:01:00")), ("a", 60, 30.0, _at("03T00:00:00")),
         ("b", 5, 50.0, _at("01T10:01:00.000001")), ("b", 7, 50.0, _at("09T00:00:00")), (None, 1, None, _at("01T10:00:59"))],
        "zone string, vehicle_count bigint, occupancy_rate double, event_time timestamp_ntz",
    )


def _brute_runs(events, cutoffs):
    out = []
    for cut in sorted(set(cutoffs)):
        for zone in {row[0] for row in events}:
            seen = [row for row in events if row[0] == zone and (row[3] is None or row[3] <= cut)]
            rates = [row[2] for row in seen if row[2] is not None]
            if seen:
                means = sum(row[1] for row in seen) / len(seen), sum(rates) / len(rates) if rates else None
                out.append((zone, round(means[0], 2), means[1] and round(means[1], 2), cut))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1440, 2, 1])
def test_replay_at_given_cutoffs(spark, monkeypatch, chunk):
    """Irregular cut-offs, some in one minute, repeated ones, days without any, and events before, on and after them."""
    monkeypatch.setattr(history, "CHUNK", chunk)
    cutoffs = [_at(t) for t in ("01T10:00:00", "01T10:00:30", "01T10:00:45", "01T10:01:00", "01T10:01:00", "01T10:01:01",
                                "02T00:00:00", "05T12:00:00", "05T12:00:01", "07T00:00:00")]
    events = [tuple(row) for row in _moments(spark).collect()] + [("b", 100, 1.0, None)]
    frame = spark.createDataFrame(events, _moments(spark).schema)
    got = history.replay_zones_at(frame, spark.createDataFrame([(c,) for c in cutoffs], "timestamp timestamp_ntz"))
    assert rows(got.drop("traffic_level")) == _brute_runs(events, cutoffs)


def test_replay_at_no_cutoff_and_of_no_events(spark):
    none = spark.createDataFrame([], "timestamp timestamp_ntz")
    assert history.replay_zones_at(_moments(spark), none).isEmpty()
    one = spark.createDataFrame([(_at("01T00:00:00"),)], "timestamp timestamp_ntz")
    assert history.replay_zones_at(_moments(spark).limit(0), one).isEmpty()
    assert history.replay_zones_at(_moments(spark), one).isEmpty()


def test_replay_at_the_ends_of_days_equals_the_daily_replay(spark):
    events = dated(sensor_events(spark, SMALL))
    daily = history.replay_roads(agg.daily_road_partials(events))
    assert rows(history.replay_roads_at(events, daily.select("timestamp"))) == rows(daily)


def test_the_last_cutoff_is_the_current_table(spark):
    events = dated(sensor_events(spark, SMALL))
    replayed = history.replay_zones(agg.daily_zone_partials(events))
    last = replayed.agg(F.max("timestamp")).first()[0]
    current = marts.traffic_mart(agg.traffic_by_zone(agg.zone_means(events)))
    assert rows(replayed.where(F.col("timestamp") == F.lit(last)).drop("timestamp")) == rows(current)
    roads = history.replay_roads(agg.daily_road_partials(events))
    assert rows(roads.where(F.col("timestamp") == F.lit(last)).drop("timestamp")) == rows(
        marts.speed_mart(agg.road_means(events))
    )


def test_panels_order_and_nulls(spark):
    traffic = spark.createDataFrame(
        [("a", 1.0, 2.0, "x"), ("b", None, 2.0, "x"), ("c", 9.0, None, "x")],
        "zone string, vehicle_count_avg double, occupancy_rate_avg double, traffic_level string",
    )
    assert [row["zone"] for row in panels.zone_table(traffic).collect()] == ["b", "c", "a"]
    series = spark.createDataFrame(
        [("a", 1.0, None), ("b", 2.0, datetime(2024, 1, 2)), ("c", 3.0, datetime(2024, 1, 1))],
        "zone string, vehicle_count_avg double, timestamp timestamp_ntz",
    )
    assert [row["zone"] for row in panels.vehicle_series(series).collect()] == ["c", "b", "a"]


def test_last_not_null_skips_nulls_and_ignores_row_order(spark):
    points = [("a", 1.0, datetime(2024, 1, 1)), ("a", 2.0, datetime(2024, 1, 2)), ("a", None, datetime(2024, 1, 3)),
              ("a", 1.5, datetime(2024, 1, 2)), ("b", None, datetime(2024, 1, 1))]
    for order in (points, points[::-1]):
        frame = spark.createDataFrame(order, "zone string, v double, timestamp timestamp_ntz").coalesce(1)
        assert rows(panels.last_not_null(frame, "v", "zone")) == [("a", datetime(2024, 1, 2), 2.0), ("b", None, None)]


def test_wide_series_and_its_map(spark):
    assert rows(panels.occupancy_wide(small_history(spark), ("a", "nowhere")).select("a", "nowhere")) == [
        (40.0, None), (40.0, None), (45.0, None), (45.0, None), (45.0, None),
    ]
    last = panels.occupancy_map(small_history(spark)).collect()[-1]
    assert last["zones"] == {"a": 40.0, "b": 50.0} and last["no_zone"] is None


def test_a_map_has_any_number_of_zones_and_any_names(spark):
    """More zones than a pivot allows, and one whose name could be taken for that of none."""
    many = spark.range(12_000).select(F.concat(F.lit("z"), "id").alias("zone"), F.col("id").cast("double").alias("occupancy_rate_avg"))
    odd = spark.createDataFrame([("no zone", 5.0), (None, 7.0), (None, 9.0), ("empty", None)], "zone string, occupancy_rate_avg double")
    series = panels.occupancy_map(many.union(odd).withColumn("timestamp", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")))
    one = series.first()
    assert len(one["zones"]) == 12_002 and one["zones"]["no zone"] == 5.0 and one["zones"]["empty"] is None
    assert one["no_zone"] == 8.0 and one["zones"]["z11999"] == 11999.0
    assert "pivot" not in series._jdf.queryExecution().logical().toString().lower()


def test_range_ends_belong_to_the_range(spark):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, hour),) for hour in range(12)], "timestamp timestamp_ntz")
    assert panels.in_range(frame, datetime(2024, 1, 1, 9)).count() == 7


def test_speed_per_type_is_the_mean_of_its_roads(spark):
    frame = spark.createDataFrame(
        [("A1", "Autoroute", 90.0), ("A86", "Autoroute", 70.0), ("r", "Rue", 20.0)],
        "road_id string, road_type string, speed_avg_kmh double",
    ).withColumn("timestamp", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert rows(panels.speed_by_type(frame).drop("time")) == [("Autoroute", 80.0), ("Rue", 20.0)]
    assert panels.speed_series(frame).count() == 3
