from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from flowmart.operators import aggregates as agg
from flowmart.operators import marts, quality
from flowmart.schema import ANALYTICS, PROCESSED, columns_of
from flowmart.sources.sensor_table import sensor_events
from tests.conftest import SMALL, rows

RUN = datetime(2024, 5, 1, 12, 0, tzinfo=timezone.utc)


def traffic(spark, *items):
    return spark.createDataFrame(list(items), "zone string, vehicle_count_avg double, occupancy_rate_avg double, traffic_level string")


def congestion(spark, *items):
    return spark.createDataFrame(list(items), "zone string, congestion_rate_pct double, measurements_count bigint, congestion_priority string")


def test_summary_keeps_zones_of_either_side_and_does_not_join_nulls(spark):
    got = marts.mobility_summary(
        traffic(spark, ("both", 1.0, 60.0, "ÉLEVÉ"), ("left", 2.0, 10.0, "FAIBLE"), (None, 3.0, 30.0, "MODERÉ")),
        congestion(spark, ("both", 60.0, 5, "HAUTE"), ("right", 90.0, 6, "URGENTE"), (None, 30.0, 7, "FAIBLE")),
    )
    assert rows(got) == sorted(
        [
            ("both", 1.0, 60.0, "ÉLEVÉ", 60.0, "HAUTE", "ALERTE"),
            ("left", 2.0, 10.0, "FAIBLE", None, None, "NORMAL"),
            ("right", None, None, None, 90.0, "URGENTE", "ALERTE"),
            (None, 3.0, 30.0, "MODERÉ", None, None, "NORMAL"),
            (None, None, None, None, 30.0, "FAIBLE", "NORMAL"),
        ],
        key=repr,
    )


def test_tables_have_their_declared_columns_and_types(spark):
    processed = agg.processed_tables(agg.sweep(sensor_events(spark, SMALL)))
    for name, frame in processed.items():
        stamped = marts.stamped(frame, RUN)
        assert stamped.dtypes == spark.createDataFrame([], PROCESSED[name]).dtypes
    for name, frame in marts.analytics_tables(processed, RUN).items():
        assert frame.dtypes == spark.createDataFrame([], ANALYTICS[name]).dtypes
        assert frame.columns == columns_of(ANALYTICS[name])
        assert frame.where(F.col("processed_date").isNull()).isEmpty()
        assert frame.select("processed_date").distinct().count() == 1


def test_the_sweep_equals_the_separate_aggregates(spark):
    events = sensor_events(spark, SMALL).union(
        sensor_events(spark, SMALL).limit(7).withColumns({name: F.lit(None) for name in ("zone", "road_id", "road_type")})
    ).persist()
    processed = agg.processed_tables(agg.sweep(events))
    means = agg.zone_means(events)
    assert rows(processed["traffic_by_zone"]) == rows(agg.traffic_by_zone(means))
    assert rows(processed["congestion_alerts"]) == rows(agg.congestion_by_zone(means))
    assert rows(processed["speed_by_road"]) == rows(agg.road_means(events))
    # A NULL zone or road is a group, not to be mixed up with a column that is not grouped.
    assert sum(row[0] is None for row in rows(processed["traffic_by_zone"])) == 1
    assert sum(row[0] is None for row in rows(processed["speed_by_road"])) == 1
    events.unpersist()


def test_partials_replace_only_their_days_and_merge_to_the_full_means(spark, tmp_path):
    from flowmart.sources.raw import dated

    events = dated(sensor_events(spark, SMALL))
    late = F.col("event_id") >= 900
    path = str(tmp_path / "partials")
    agg.store_partials(agg.daily_sweep(events.where(~late)), path)
    before = {f.name for f in (tmp_path / "partials" / "date=2024-01-01").iterdir()}
    agg.refresh_partials(events, events.where(late).select("date"), path)
    assert {f.name for f in (tmp_path / "partials" / "date=2024-01-01").iterdir()} == before
    full = agg.sweep(events)

    def merged():
        return agg.merge_partials(spark.read.parquet(path)).select(*full.columns)

    assert rows(merged()) == rows(full)
    # Once more: nothing is counted twice.
    agg.refresh_partials(events, events.select("date"), path)
    assert rows(merged()) == rows(full)


def test_undated_events_count_in_the_merged_means(spark, tmp_path):
    from flowmart.sources.raw import dated

    events = dated(sensor_events(spark, SMALL)).withColumn(
        "date", F.when(F.col("event_id") < 50, "undated").otherwise(F.col("date"))
    )
    path = str(tmp_path / "partials")
    agg.store_partials(agg.daily_sweep(events), path)
    agg.refresh_partials(events, spark.createDataFrame([("undated",), ("2024-01-02",)], "date string"), path)
    merged = agg.merge_partials(spark.read.parquet(path)).where("grain = 'zone'").collect()
    assert sum(row["measurements_count"] for row in merged) == events.count()


@pytest.mark.parametrize("change, rule", [
    ({"occupancy_rate": 100.01}, "occupancy_range"),
    ({"occupancy_rate": None}, "occupancy_range"),
    ({"occupancy_rate": float("nan")}, "occupancy_range"),
    ({"vehicle_count": 101}, "vehicle_capacity"),
    ({"vehicle_count": -1}, "vehicle_capacity"),
    ({"average_speed": 140.1}, "speed_limit"),
    ({"zone": "Plage"}, "known_zone"),
    ({"zone": None}, "known_zone"),
    ({"road_id": "A99"}, "known_road"),
    ({"road_type": "Piste", "vehicle_count": 1000, "average_speed": 500.0}, "known_road_type"),
    ({"event_time": None}, "event_time"),
])
def test_each_breach_is_counted_under_its_rule_only(spark, change, rule):
    sound = {"zone": "Aeroport", "road_id": "A1", "road_type": "Autoroute", "vehicle_count": 100, "average_speed": 140.0,
             "occupancy_rate": 100.0, "event_time": datetime(2024, 1, 1)}
    events = spark.createDataFrame(
        [tuple(sound.values()), tuple({**sound, **change}.values())],
        "zone string, road_id string, road_type string, vehicle_count bigint, average_speed double, occupancy_rate double, event_time timestamp_ntz",
    )
    found = quality.contract_violations(events).where("violations > 0").collect()
    assert [(row["rule"], row["violations"]) for row in found] == [(rule, 1)]


def test_unknown_road_types_keep_their_row(spark):
    events = spark.createDataFrame([("Rue", 10), ("Piste", 3), (None, 4)], "road_type string, vehicle_count bigint")
    assert rows(quality.road_load(events).select("road_type", "load_ratio")) == [("Piste", None), ("Rue", 0.5), (None, None)]
