import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowmart.operators import aggregates as agg
from flowmart.operators import marts
from flowmart.schema import ANALYTICS, PROCESSED, columns_of
from flowmart.sources import raw, tables
from tests.conftest import rows

GOOD = {
    "sensor_id": "ab12cd34", "road_id": "A1", "road_type": "Autoroute", "zone": "Centre Ville", "vehicle_count": 40,
    "average_speed": 90.5, "occupancy_rate": 40.25, "event_time": "2024-01-01T08:00:00.000001",
}


def event(**changes):
    return json.dumps({**GOOD, **changes})


def test_directories_do_not_replace_the_zone_of_the_body(spark, write_lines):
    got = raw.read_raw(spark, write_lines([event()]))
    assert got.columns == list(GOOD)
    assert got.first()["zone"] == "Centre Ville"


def test_a_malformed_line_is_a_row_of_nulls_and_a_zone_of_its_own(spark, write_lines):
    path = write_lines([event(), "{bad json", event(), event(occupancy_rate=41.0)])
    means = agg.zone_means(raw.read_raw(spark, path))
    assert rows(agg.congestion_by_zone(means)) == [
        ("Centre Ville", 40.5, 3, "MODERATE CONGESTION"),
        (None, None, 1, "MODERATE CONGESTION"),
    ]
    assert (None, None, None) in rows(agg.traffic_by_zone(means))


def test_integers_and_quoted_numbers(spark, write_lines):
    path = write_lines([event(occupancy_rate=0), event(occupancy_rate=100), event(occupancy_rate="12")])
    events = raw.read_raw(spark, path)
    assert dict(events.dtypes)["occupancy_rate"] == "double"
    # The quoted number is NULL and left out of the mean; the other values keep their type.
    assert agg.zone_means(events).first()["avg_occupancy_rate"] == 50.0
    assert agg.zone_means(events).first()["measurements_count"] == 3


def test_nan_and_null_metrics_take_the_outer_labels(spark, write_lines):
    path = write_lines([
        event(zone="nothing", occupancy_rate=None, average_speed=None, vehicle_count=None, road_id="r0"),
        event(zone="nan", road_id="r1").replace("40.25", "NaN").replace("90.5", "NaN"),
    ])
    processed = agg.processed_tables(agg.sweep(raw.read_raw(spark, path)))
    traffic = {row["zone"]: row for row in marts.traffic_mart(processed["traffic_by_zone"]).collect()}
    congestion = {row["zone"]: row for row in marts.congestion_mart(processed["congestion_alerts"]).collect()}
    speed = {row["road_id"]: row for row in marts.speed_mart(processed["speed_by_road"]).collect()}
    assert traffic["nothing"]["traffic_level"] == traffic["nan"]["traffic_level"] == "CRITIQUE"
    assert (congestion["nothing"]["status"], congestion["nothing"]["congestion_priority"]) == ("MODERATE CONGESTION", "FAIBLE")
    assert (congestion["nan"]["status"], congestion["nan"]["congestion_priority"]) == ("CRITICAL CONGESTION", "URGENTE")
    assert (speed["r0"]["speed_category"], speed["r1"]["speed_category"]) == ("TRÈS_LENTE", "RAPIDE")


def test_typed_events(spark, write_lines):
    path = write_lines([event(), event(event_time="yesterday")])
    got = raw.dated(raw.typed(raw.read_raw(spark, path)))
    assert dict(got.dtypes)["event_time"] == "timestamp_ntz"
    assert sorted(row["date"] for row in got.collect()) == ["2024-01-01", "undated"]


def test_the_classification_follows_the_rounding(spark):
    means = spark.createDataFrame(
        [("a", 80.004), ("b", 80.005), ("c", 80.0), ("d", 50.0), ("e", 20.0), ("f", 30.0)], "zone string, occupancy_rate double"
    ).withColumn("vehicle_count", F.lit(1))
    zones = agg.zone_means(means)
    status = {row["zone"]: row["status"] for row in agg.congestion_by_zone(zones).collect()}
    assert status["a"] == status["c"] == "HIGH CONGESTION" and status["b"] == "CRITICAL CONGESTION"
    assert status["d"] == "MODERATE CONGESTION"
    levels = {row["zone"]: row["traffic_level"] for row in marts.traffic_mart(agg.traffic_by_zone(zones)).collect()}
    assert (levels["a"], levels["c"], levels["d"], levels["e"]) == ("CRITIQUE", "CRITIQUE", "ÉLEVÉ", "MODERÉ")
    congestion = marts.congestion_mart(agg.congestion_by_zone(zones))
    priority = {row["zone"]: row["congestion_priority"] for row in congestion.collect()}
    assert (priority["c"], priority["d"], priority["f"]) == ("HAUTE", "MODERÉE", "FAIBLE")


def test_corrupt_and_missing_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    (tmp_path / "t" / "part-junk.parquet").write_text("this is no table")
    assert tables.tolerant_scan(spark, path, "id bigint").count() == 5
    with pytest.raises(AnalysisException):
        tables.tolerant_scan(spark, str(tmp_path / "nowhere"))


def test_skipped_files_are_named(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id bigint"
    spark.range(5).repartition(2).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)  # intact, without rows
    (tmp_path / "t" / "part-junk.parquet").write_text("this is no table")
    (tmp_path / "t" / "part-short.parquet").write_text("PA")
    cut = next(f for f in (tmp_path / "t").glob("part-*.parquet") if f.stat().st_size > 400)
    (tmp_path / "t" / "part-cut.parquet").write_bytes(cut.read_bytes()[:-9])
    skipped = {row["file"].rpartition("/")[2]: row["size"] for row in tables.skipped_files(spark, path, schema).collect()}
    assert skipped == {"part-junk.parquet": 16, "part-short.parquet": 2, "part-cut.parquet": cut.stat().st_size - 9}


def test_read_or_empty(spark, tmp_path):
    schema = ANALYTICS["congestion_alerts"]
    missing = tables.read_or_empty(spark, str(tmp_path / "nowhere"), schema)
    assert missing.columns == columns_of(schema) and missing.isEmpty()
    assert dict(missing.dtypes)["measurements_count"] == "bigint"
    (tmp_path / "bare").mkdir()
    assert tables.read_or_empty(spark, str(tmp_path / "bare"), schema).isEmpty()
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "part-0.parquet").write_text("junk")
    assert tables.read_or_empty(spark, str(tmp_path / "junk"), schema).isEmpty()
    with pytest.raises(Exception, match="(?i)scheme|FileSystem"):
        tables.read_or_empty(spark, "nosuchscheme://x/y", schema)


def test_processed_tables_come_back_with_their_schema(spark, tmp_path):
    for name, schema in PROCESSED.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    for name, frame in tables.read_processed(spark, str(tmp_path)).items():
        assert frame.columns == columns_of(PROCESSED[name])


class _Reader:
    """Stands for spark.readStream: records what a topic reader asks for."""

    def __init__(self, spark):
        self.spark, self.options, self.kind = spark, {}, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def load(self):
        return self.spark.createDataFrame([(bytearray("é{}".encode()),)], "value binary")


def test_topic_reader_waits_for_messages_or_time(spark):
    class Session:
        readStream = _Reader(spark)

    lines = raw.topic_lines(Session, "broker:9092", group="g", max_messages=1000, min_partitions=24)
    assert Session.readStream.kind == "kafka"
    assert Session.readStream.options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "traffic-events", "startingOffsets": "latest",
        "groupIdPrefix": "g",
        "minOffsetsPerTrigger": 50, "maxTriggerDelay": "30s", "maxOffsetsPerTrigger": 1000,
        "minPartitions": 24,
    }
    assert lines.first()["value"] == "é{}"
