import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowmart.operators import compaction, quality
from flowmart.schema import RAW_EVENT
from flowmart.sources import raw
from flowmart.streaming.landing import land, routed, write_batch
from tests.conftest import rows
from tests.test_sources import event

ONCE = {"availableNow": True}


@pytest.fixture
def lake(spark, tmp_path, write_lines):
    class Lake:
        root = str(tmp_path / "lake")

        def arrive(self, name, *lines):
            inbox = write_lines(lines, f"inbox/{name}.jsonl", "inbox")
            query = land(raw.file_lines(spark, inbox), self.root, str(tmp_path / "state"), ONCE)
            query.awaitTermination()

        def counts(self):
            lines = raw.landed_lines(spark, self.root)
            return rows(lines.groupBy("outcome", "date", "zone").agg(F.count("*")))

        def files(self):
            return sorted(str(f.relative_to(self.root)) for f in Path(self.root).rglob("part-*"))

    return Lake()


def test_directories_and_bodies(spark, lake):
    odd = '{"zone": "Centre Ville", "event_time": "2024-01-02T00:00:00", "extra": {"a": [1, null]}, "road_id": null}'
    lake.arrive("one", event(), odd)
    assert lake.counts() == [
        ("landed", "2024-01-01", "Centre_Ville", 1),
        ("landed", "2024-01-02", "Centre_Ville", 1),
    ]
    assert all("/batch=000000000000/landed_at=" in name for name in lake.files())
    assert all("/outcome=landed/date=2024-01-0" in name and "/zone=Centre_Ville/" in name for name in lake.files())
    assert not list(Path(lake.root).rglob("_spark_metadata"))
    bodies = sorted(row["value"] for row in raw.landed_lines(spark, lake.root).select("value").collect())
    assert bodies == sorted([event(), odd])
    assert {row["zone"] for row in raw.read_landed(spark, lake.root).collect()} == {"Centre Ville"}


def test_restart_adds_nothing_twice(lake):
    lake.arrive("one", event(), event())
    lake.arrive("two", event())
    before = lake.files()
    lake.arrive("two", event())
    assert lake.files() == before
    assert lake.counts() == [("landed", "2024-01-01", "Centre_Ville", 3)]


def test_a_stop_between_batches_loses_and_repeats_nothing(spark, tmp_path, write_lines):
    for number in range(5):
        inbox = write_lines([event(sensor_id=f"{number}-{n}") for n in range(20)], f"inbox/{number}.jsonl", "inbox")
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    query = land(raw.file_lines(spark, inbox, files_per_trigger=1), root, state, {"processingTime": "0 seconds"})
    while not query.recentProgress:
        query.awaitTermination(1)
    query.stop()
    land(raw.file_lines(spark, inbox, files_per_trigger=2), root, state, ONCE).awaitTermination()
    assert raw.read_landed(spark, root).select("sensor_id").distinct().count() == 100
    assert raw.read_landed(spark, root).count() == 100


def _first_try(spark, lake, tmp_path):
    """The directory of the batch that landed, and its rows once more as the stream gives them."""
    batch = next(Path(lake.root).glob("stream=*/span=*/batch=*"))
    stream = batch.parent.parent.name.partition("=")[2]
    rows_again = raw.landed_lines(spark, lake.root).select("value", "landed_at", "outcome", "date", "zone")
    kept = str(tmp_path / "kept")
    rows_again.write.parquet(kept)
    return batch, stream, spark.read.parquet(kept)


def test_leftovers_of_a_killed_batch_are_not_read_and_are_overwritten(spark, lake, tmp_path):
    lake.arrive("one", event(), event(zone="Aeroport"))
    batch, stream, content = _first_try(spark, lake, tmp_path)
    beside = Path(lake.root) / "_staging" / f"stream-{stream}" / "span-000000000" / "batch-000000000001"
    folder = beside / "landed_at=x" / "outcome=landed" / "date=2024-01-01" / "zone=Centre_Ville"
    folder.mkdir(parents=True)
    (folder / "part-00000-lost.txt").write_text(event() + "\n" + event())
    assert raw.read_landed(spark, lake.root).count() == raw.read_raw(spark, lake.root).count() == 2
    # The next try of that batch writes all of it.
    write_batch(content, 1, lake.root, stream)
    assert raw.read_landed(spark, lake.root).count() == 4
    assert not beside.exists()


def test_a_batch_repeated_after_it_had_landed_adds_nothing(spark, lake, tmp_path):
    """The driver is killed after the rename and before the checkpoint knows of it."""
    lake.arrive("one", event(), event(zone="Aeroport"))
    batch, stream, content = _first_try(spark, lake, tmp_path)
    before = lake.files()
    write_batch(content, 0, lake.root, stream)
    assert lake.files() == before
    for commit in list((tmp_path / "state" / "commits").iterdir()):
        commit.unlink()
    lake.arrive("two", event())
    assert raw.read_landed(spark, lake.root).count() == 3
    assert {row["batch"] for row in raw.read_arrivals(spark, lake.root).collect()} == {"000000000000", "000000000001"}


def test_a_new_checkpoint_does_not_touch_the_batches_of_the_old_one(spark, lake, tmp_path, write_lines):
    lake.arrive("one", event())
    inbox = write_lines([event(zone="Aeroport")], "other/x.jsonl", "other")
    land(raw.file_lines(spark, inbox), lake.root, str(tmp_path / "other-state"), ONCE).awaitTermination()
    assert rows(raw.read_landed(spark, lake.root).select("zone")) == [("Aeroport",), ("Centre Ville",)]


def test_spans_bound_directories(spark):
    assert raw.batch_directory(999) == "span=000000000/batch=000000000999"
    assert raw.batch_directory(12_000) == "span=000000012/batch=000000012000"


def test_arrivals_have_the_time_of_their_batch(spark, lake):
    lake.arrive("one", event(event_time="2024-01-03T10:00:00"))
    lake.arrive("two", event(event_time="2024-01-01T10:00:00"))
    first, second = sorted(raw.read_arrivals(spark, lake.root).collect(), key=lambda row: row["landed_at"])
    assert (first["date"], second["date"]) == ("2024-01-03", "2024-01-01")
    assert first["batch"] < second["batch"] and first["landed_at"] < second["landed_at"]


def test_late_events_go_to_their_own_day(spark, lake):
    lake.arrive("one", event(event_time="2024-01-03T10:00:00", occupancy_rate=10.0))
    first = lake.files()
    lake.arrive("two", event(event_time="2024-01-01T10:00:00", occupancy_rate=30.0))
    assert [name for name in lake.files() if name not in first][0].split("/outcome=landed/")[1].startswith("date=2024-01-01/")
    assert raw.read_landed(spark, lake.root).agg(F.avg("occupancy_rate")).first()[0] == 20.0


def test_unroutable_messages_are_kept_apart_and_the_stream_goes_on(spark, lake):
    bad = ["{bad json", "[1]", '"text"', "", event(zone=None), event(event_time=None), event(event_time="noon"),
           '{"event_time": "2024-01-01T00:00:00"}', f"[{event()}]"]
    lake.arrive("one", event(), *bad)
    lake.arrive("two", event())
    split = raw.landed_lines(spark, lake.root).groupBy("outcome").agg(F.count("*"))
    assert rows(split) == [("landed", 2), ("malformed", 5), ("no_time", 2), ("no_zone", 2)]
    assert raw.read_landed(spark, lake.root).count() == 2


def test_line_breaks_and_missing_bodies(spark):
    messages = spark.createDataFrame([(event().replace(", ", ",\r\n "),), (None,)], "value string")
    got = routed(messages).collect()
    assert got[0]["outcome"] == "landed" and "\n" not in got[0]["value"]
    assert json.loads(got[0]["value"]) == json.loads(event())
    assert got[1]["outcome"] == "malformed"
    bytes_of = spark.createDataFrame([(bytearray(event().encode().replace(b"Centre", b"C\xffntre")),)], "value binary")
    assert routed(bytes_of.select(F.col("value").cast("string"))).first()["outcome"] == "malformed"


@pytest.mark.parametrize("text, outcome", [
    ("%s", "landed"),
    ("  %s ", "landed"),
    ("%s %s", "malformed"),
    ("%s, %s", "malformed"),
    ("%s trailing", "malformed"),
    ("%s}", "malformed"),
    ("[%s]", "malformed"),
    ("null", "malformed"),
    ("5", "malformed"),
    ("   ", "malformed"),
    ("{'zone': 'a', 'event_time': '2024-01-01T00:00:00'}", "malformed"),
    ("{}", "no_zone"),
])
def test_a_message_is_one_object(spark, text, outcome):
    message = text.replace("%s", event())
    assert routed(spark.createDataFrame([(message,)], "value string")).first()["outcome"] == outcome


def test_land_and_scan_give_the_events_back(spark, lake, write_lines):
    lines = [event(sensor_id=f"s{n}", zone=zone, vehicle_count=n) for n, zone in enumerate(["a b", "c", "", "é/è", "a=b"] * 3)]
    lake.arrive("one", *lines)
    direct = spark.read.schema(RAW_EVENT).json(write_lines(lines, "direct/x.jsonl", "direct"))
    assert rows(raw.read_landed(spark, lake.root).drop("date")) == rows(direct)
    assert rows(raw.read_raw(spark, lake.root)) == rows(direct)


def test_streams_of_landed_events(spark, lake, tmp_path):
    lake.arrive("one", event(), event(zone=None), "{")
    query = (
        raw.landed_stream(spark, lake.root).writeStream.format("memory").queryName("landed_again")
        .option("checkpointLocation", str(tmp_path / "again")).trigger(**ONCE).start()
    )
    query.awaitTermination()
    assert [row["zone"] for row in spark.table("landed_again").collect()] == ["Centre Ville"]


def test_patterns_of_spans():
    import fnmatch

    for first in (0, 1, 9, 10, 19, 99, 12_345, 999_999_999):
        patterns = raw.spans_from(first)[6:-1].split(",")
        for number in {0, 1, 8, 9, 10, 11, 18, 19, 20, 98, 99, 100, 12_344, 12_345, 12_346, 13_000, 999_999_999}:
            assert any(fnmatch.fnmatch(f"{number:09d}", x) for x in patterns) == (number >= first)


def test_a_restarted_stream_goes_on_from_a_later_span(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "SPAN", 2)

    def taken(name, **options):
        stream = raw.landed_stream(spark, lake.root, **options).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        stream.option("checkpointLocation", str(tmp_path / "again")).trigger(**ONCE).start().awaitTermination()
        return sorted(row["sensor_id"] for row in spark.read.parquet(str(tmp_path / "out")).collect())

    for number in range(3):
        lake.arrive(f"f{number}", event(sensor_id=f"s{number}"))
    assert taken("one") == ["s0", "s1", "s2"]
    lake.arrive("f3", event(sensor_id="s3"))
    lake.arrive("f4", event(sensor_id="s4"))
    assert taken("two", first_span=1) == ["s0", "s1", "s2", "s3", "s4"]
    assert taken("three", first_span=2) == ["s0", "s1", "s2", "s3", "s4"]


def _bins(target):
    """Bin directories of a compacted tree and when their files were written."""
    return {str(f.parent.relative_to(target)): f.stat().st_mtime_ns for f in Path(target).glob("date=*/zone=*/bin=*/part-*")}


def test_compaction_brings_small_files_together(spark, lake, tmp_path):
    for number in range(3):
        lake.arrive(f"f{number}", event(), event(zone="Aeroport"), event(event_time="2024-01-05T00:00:00"), event(zone=None))
    target = str(tmp_path / "compacted")
    assert compaction.compact(spark, lake.root, target) == 3
    assert len(list(Path(target).rglob("part-*.txt"))) == 3 < len(lake.files())
    assert rows(raw.read_raw(spark, target)) == rows(raw.read_landed(spark, lake.root).drop("date"))
    assert rows(compaction.read_compacted(spark, target).groupBy("date", "zone", "bin").count()) == [
        ("2024-01-01", "Aeroport", 0, 3), ("2024-01-01", "Centre_Ville", 0, 3), ("2024-01-05", "Centre_Ville", 0, 3),
    ]


def test_a_late_event_rewrites_its_bin_and_not_its_day(spark, lake, tmp_path):
    target = str(tmp_path / "compacted")
    size = 3 * compaction.OPEN_BYTES  # about three tiny files a bin
    for number in range(7):
        lake.arrive(f"f{number}", event(sensor_id=f"s{number}"), event(zone="Aeroport"))
    assert compaction.compact(spark, lake.root, target, size) == 6
    before = _bins(target)
    assert compaction.compact(spark, lake.root, target, size) == 0
    lake.arrive("late", event(sensor_id="late"))
    assert compaction.compact(spark, lake.root, target, size) == 1
    after = _bins(target)
    assert [name for name in after if after[name] != before.get(name)] == ["date=2024-01-01/zone=Centre_Ville/bin=2"]
    assert rows(raw.read_raw(spark, target)) == rows(raw.read_landed(spark, lake.root).drop("date"))


def test_a_compaction_that_broke_off_is_repeated(spark, lake, tmp_path):
    target, size = str(tmp_path / "compacted"), 2 * compaction.OPEN_BYTES
    for number in range(3):
        lake.arrive(f"f{number}", event(sensor_id=f"s{number}"))
    compaction.compact(spark, lake.root, target, size)
    lake.arrive("more", event(sensor_id="more"))
    compaction.compact(spark, lake.root, target, size)
    # The driver was lost before the plan of the second run was written; more has arrived since.
    last = sorted((Path(target) / compaction._LEDGER).glob("through=*"))[-1]
    for file in list(last.iterdir()):
        file.unlink()
    last.rmdir()
    lake.arrive("yet more", event(sensor_id="yet more"), event(zone="a=b/é"))
    compaction.compact(spark, lake.root, target, size)
    assert rows(raw.read_raw(spark, target)) == rows(raw.read_landed(spark, lake.root).drop("date"))


def test_new_spans_only_are_listed(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "SPAN", 2)
    target = str(tmp_path / "compacted")
    for number in range(5):
        lake.arrive(f"f{number}", event(sensor_id=f"s{number}"))
    assert compaction.compact(spark, lake.root, target) == 1
    stream = next(Path(lake.root).glob("stream=*")).name
    assert compaction._new_places(spark, lake.root, target) == [f"{stream}/span=000000002"]
    lake.arrive("f5", event(sensor_id="s5"))
    compaction.compact(spark, lake.root, target)
    assert raw.read_raw(spark, target).select("sensor_id").distinct().count() == 6
    assert compaction.compact(spark, str(tmp_path / "nothing"), target) == 0


def test_a_directory_with_most_rows_is_split_over_tasks(spark, lake, tmp_path):
    """Two thirds of the rows share one day and zone; the advisory size stands for the memory of a task."""
    lake.arrive("one", *[event(sensor_id=f"{n * 7919:08x}", zone="hot" if n % 3 else f"z{n % 4}") for n in range(6000)])
    for number in range(4):
        lake.arrive(f"more{number}", *[event(sensor_id=f"{n * 104729:08x}", zone="hot") for n in range(2000)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        compaction.compact(spark, lake.root, str(tmp_path / "compacted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list((tmp_path / "compacted" / "date=2024-01-01" / "zone=hot").rglob("part-*"))
    assert len(hot) > 1
    assert raw.read_raw(spark, str(tmp_path / "compacted")).count() == 14000


def test_typed_layer_replaces_days(spark, lake, tmp_path):
    target = str(tmp_path / "typed")
    lake.arrive("one", event(), event(event_time="2024-01-02T00:00:00"))
    compaction.build_typed_layer(spark, lake.root, target, "2024-01-01", "2024-01-02")
    lake.arrive("two", event(zone="Aeroport"))
    compaction.build_typed_layer(spark, lake.root, target, "2024-01-01", "2024-01-01")
    typed = raw.read_typed(spark, target)
    assert dict(typed.dtypes)["event_time"] == "timestamp_ntz"
    assert rows(typed.select("date", "zone")) == [
        ("2024-01-01", "Aeroport"), ("2024-01-01", "Centre Ville"), ("2024-01-02", "Centre Ville"),
    ]


def test_violations_are_counted_in_the_pass_that_lands(spark, tmp_path, write_lines):
    bad = [event(occupancy_rate=101.0), event(zone="Nowhere", vehicle_count=-1), event(zone=None), event(event_time="noon"), "{", ""]
    inbox = write_lines([event(), *bad], "inbox/one.jsonl", "inbox")
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    query = land(raw.file_lines(spark, inbox), root, state, ONCE, checked=True)
    query.awaitTermination()
    counted = quality.observed_violations(query.recentProgress)
    assert counted.pop("checked") == 5
    lines = raw.landed_lines(spark, root).where("outcome <> 'malformed'")
    events = raw.typed(lines.select(F.from_json("value", RAW_EVENT).alias("e")).select("e.*"))
    expected = quality.contract_violations(events).groupBy("rule").agg(F.sum("violations")).collect()
    assert counted == {row[0]: row[1] for row in expected}
    assert counted["occupancy_range"] == 1 and counted["known_zone"] == 2 and counted["event_time"] == 1
    assert sorted(raw.landed_lines(spark, root).groupBy("outcome").count().collect()) == [
        ("landed", 3), ("malformed", 2), ("no_time", 1), ("no_zone", 1),
    ]
