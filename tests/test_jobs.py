"""The command line jobs, one after the other, on a small lake."""

from datetime import datetime, timezone

import pytest

from flowmart import __main__ as jobs
from flowmart.sinks.lake import LakeTarget
from tests.conftest import rows
from tests.test_landing import ONCE
from tests.test_sources import event


@pytest.fixture
def own_settings(spark):
    """Jobs set up the session for themselves; the other tests get theirs back."""
    names = (
        "spark.sql.shuffle.partitions",
        "spark.sql.maxConcurrentOutputFileWriters",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = {name: spark.conf.get(name, None) for name in names}
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_jobs_in_order(own_settings, spark, tmp_path, write_lines, monkeypatch):
    # Streams end when their input is used up, so that the test ends too.
    for name in ("land", "refresh"):
        start = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda *given, start=start: start(*given[:3], ONCE))
    inbox = write_lines([event(), event(zone="Aeroport", occupancy_rate=88.0), event(event_time="2023-12-31T01:00:00"), "{"], "inbox/a", "inbox")

    def run(job, **options):
        given = [part for name, value in options.items() for part in (f"--{name.replace('_', '-')}", str(value))]
        jobs.main([job, *given])

    lake, days = tmp_path / "lake", {"first": "2023-01-01", "last": "2024-12-31"}
    run("land", lake=lake, checkpoint=tmp_path / "c1", inbox=inbox)
    run("compact", lake=lake, target=tmp_path / "compacted")
    run("type", lake=lake, target=tmp_path / "typed", **days)
    run("process", raw=tmp_path / "compacted", processed=tmp_path / "processed")
    run("analyze", processed=tmp_path / "processed", analytics=tmp_path / "analytics")
    run("publish", analytics=tmp_path / "analytics", published=tmp_path / "p1")
    for moment in ("2024-05-01T12:00:00", "2024-05-01T14:00+02:00"):
        places = ["--analytics", f"{tmp_path}/analytics", "--published", f"{tmp_path}/p0"]
        jobs.main(["--run-time", moment, "publish", *places])
    repeated = LakeTarget(spark, str(tmp_path / "p0"))
    assert repeated.history("traffic_by_zone").count() == repeated.current("traffic_by_zone").count() == 2
    run("chain", raw=tmp_path / "typed", events_from="typed", lake=tmp_path / "l2", published=tmp_path / "p2")
    run("chain", raw=lake, events_from="landed", lake=tmp_path / "l3", published=tmp_path / "p3")
    run("refresh", raw=lake, checkpoint=tmp_path / "c2", published=tmp_path / "p4")
    run("incremental", typed=tmp_path / "typed", partials=tmp_path / "partials", published=tmp_path / "p5", **days)
    for name in ("mobility_summary", "speed_by_road", "congestion_alerts", "traffic_by_zone"):
        results = [rows(LakeTarget(spark, str(tmp_path / f"p{n}")).current(name).drop("timestamp")) for n in range(1, 6)]
        assert results[0] and all(result == results[0] for result in results)
    run("compact-history", published=tmp_path / "p1", table="speed_by_road", day=datetime.now(timezone.utc).date())
    assert LakeTarget(spark, str(tmp_path / "p1")).history("speed_by_road").count() == 1
