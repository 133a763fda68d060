import pytest

from flowmart.operators import aggregates as agg
from flowmart.operators import marts
from flowmart.schema import ANALYTICS
from flowmart.sinks.lake import LakeTarget
from flowmart.sinks.publish import PublishError
from flowmart.sources import raw
from flowmart.streaming.refresh import refresh
from tests.conftest import rows
from tests.test_publish import RUN
from tests.test_sources import event

ONCE = {"availableNow": True}


def _batch(events):
    return marts.analytics_tables(agg.processed_tables(agg.sweep(events)), RUN)


def test_refresh_follows_the_events_and_keeps_history(spark, tmp_path, write_lines):
    target = LakeTarget(spark, str(tmp_path / "published"))
    state = str(tmp_path / "state")

    def run():
        refresh(raw.raw_stream(spark, str(tmp_path / "raw")), target, state, ONCE).awaitTermination()

    write_lines([event(), event(zone="Aeroport", occupancy_rate=90.0), "{bad"], "raw/one.jsonl")
    run()
    # A late event of an old day, a new zone, and a NULL road.
    write_lines([event(event_time="2020-01-01T00:00:00", occupancy_rate=99.0), event(zone="Est", road_id=None)], "raw/two.jsonl")
    run()
    run()
    expected = _batch(raw.read_raw(spark, str(tmp_path / "raw")))
    for name in ANALYTICS:
        assert rows(target.current(name).drop("timestamp")) == rows(expected[name].drop("processed_date"))
        assert target.history(name).select("timestamp").distinct().count() == 2


def test_a_failed_batch_is_published_again_under_the_same_time(spark, tmp_path, write_lines):
    class BreaksOnce(LakeTarget):
        broken = False

        def append(self, table, *rest):
            super().append(table, *rest)
            if table == "congestion_alerts" and not self.broken:
                self.broken = True
                raise OSError("lost")

    target = BreaksOnce(spark, str(tmp_path / "published"))
    path = write_lines([event(), event(zone="Aeroport")], "raw/one.jsonl")
    state = str(tmp_path / "state")
    with pytest.raises(Exception, match="publishing stopped at congestion_alerts_ts"):
        refresh(raw.raw_stream(spark, path), target, state, ONCE).awaitTermination()
    refresh(raw.raw_stream(spark, path), target, state, ONCE).awaitTermination()
    for name in ANALYTICS:
        assert target.history(name).count() == target.current(name).count()
    assert issubclass(PublishError, RuntimeError)
