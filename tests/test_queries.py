"""Every registered query against its SQL, in two time zones, and the plans of the important ones."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from flowmart.operators import aggregates as agg
from flowmart.operators import panels, quality
from flowmart.plans.oracle import ORACLE
from flowmart.plans.queries import QUERIES
from flowmart.sources import raw
from flowmart.sources.sensor_table import sensor_events
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def check(spark, database, name, folder=SMALL):
    frame = QUERIES[name](spark, folder)
    result = database.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.select(*[f"`{column}`" for column in columns])) == sorted(result.fetchall(), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    check(spark, database, name)


@pytest.fixture(scope="module")
def gaps(tmp_path_factory):
    """The small events with missing times, kinds and users, and a database over them."""
    folder = tmp_path_factory.mktemp("gaps")
    connection = duckdb.connect()
    columns = ["ts", "event_type", "user_id"]
    missing = ", ".join(f"CASE WHEN event_id % {k} <> 3 THEN {c} END AS {c}" for c, k in zip(columns, (10, 7, 11)))
    connection.execute(
        f"COPY (SELECT * REPLACE ({missing}) FROM '{SMALL}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)"
    )
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_with_missing_values(spark, gaps, name):
    folder, connection = gaps
    check(spark, connection, name, folder)


@pytest.mark.parametrize(
    "name",
    [
        "panel_range_filter", "publish_history_roundtrip", "dashboard_published", "landing_partitions",
        "time_band_profile", "typed_layer_roundtrip", "processed_roundtrip",
    ],
)
def test_results_do_not_depend_on_the_session_time_zone(spark, database, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check(spark, database, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_flagship(spark):
    assert entry(spark).count() == 5


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_the_sweep_scans_once_and_aggregates_before_the_shuffle(spark):
    plan = plan_of(agg.sweep(sensor_events(spark, SMALL)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "partial_sum" in plan.split("Exchange")[1]
    assert "event_type" not in plan and "props" not in plan


@pytest.mark.parametrize(
    "aggregate",
    [agg.zone_means, agg.road_means, agg.sweep, agg.daily_sweep, agg.daily_zone_partials, panels.weighted_means,
     quality.time_band_profile, quality.flow_regime_profile, quality.contract_violations],
    ids=lambda aggregate: aggregate.__name__,
)
def test_hot_groups_are_reduced_before_the_shuffle(spark, aggregate):
    plan = plan_of(aggregate(raw.dated(sensor_events(spark, SMALL))))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    before_shuffle = plan.split("Exchange")[1].splitlines()[1]
    assert "HashAggregate" in before_shuffle and "partial_" in before_shuffle
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_scans_read_the_columns_they_need(spark):
    plan = plan_of(agg.road_means(sensor_events(spark, SMALL)))
    assert "ReadSchema: struct<event_id:bigint>" in plan
    json_plan = plan_of(agg.traffic_by_zone(agg.zone_means(raw.read_raw(spark, SMALL))))
    assert "ReadSchema: struct<zone:string,vehicle_count:bigint,occupancy_rate:double>" in json_plan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "congestion")
    spark.sql("SELECT 'a' zone, 60.0D congestion_rate_pct").write.parquet(path)
    assert "PushedFilters: [IsNotNull(congestion_rate_pct), GreaterThan(congestion_rate_pct,50.0)]" in plan_of(
        panels.alert_zones(spark.read.parquet(path))
    )


def test_only_the_fixed_dimension_is_broadcast_and_nothing_runs_in_python(spark):
    assert "BroadcastHashJoin" in plan_of(quality.road_load(sensor_events(spark, SMALL)))
    for name in ("mobility_summary", "history_replay_zone", "contract_violations", "single_sweep", "kpi_bands"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_touched_days_prune_the_other_directories(spark, tmp_path):
    events = raw.dated(sensor_events(spark, SMALL)).drop("event_id", "event_type")
    path = str(tmp_path / "typed")
    events.write.partitionBy("date").parquet(path)
    touched = spark.createDataFrame([("2024-01-05",), ("2024-01-09",), ("2024-01-05",)], "date string")
    days = agg.on_days_of(raw.read_typed(spark, path), touched)
    plan = plan_of(days)
    assert "array_contains" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {row["date"] for row in days.select("date").distinct().collect()} == {"2024-01-05", "2024-01-09"}
    days.collect()
    scan = next(line for line in days._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines() if "PartitionFilters" in line)
    assert "Subquery" in scan
