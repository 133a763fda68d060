"""Publishing the four marts: each to its current table and to its history table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from flowmart.operators.marts import run_time
from flowmart.schema import ANALYTICS, columns_of


class PublishError(RuntimeError):
    """A table could not be written. Says which ones had been written before; the scheduler sees the failure."""

    def __init__(self, table: str, written: list[str]):
        super().__init__(f"publishing stopped at {table}; already written: {', '.join(written) or 'none'}")
        self.table = table
        self.written = written


def export_rows(name: str, mart: DataFrame, run_ts: datetime) -> DataFrame:
    """Published columns of a mart: without processed_date, with the timestamp of the run in the last place."""
    kept = [column for column in columns_of(ANALYTICS[name]) if column != "processed_date"]
    return mart.select(*kept, run_time(run_ts).alias("timestamp"))


def run_name(run_ts: datetime) -> str:
    """Name of a run: its moment in UTC, however the time was written."""
    return f"{run_ts.astimezone(timezone.utc):%Y%m%dT%H%M%S%f}"


def publish(marts: dict[str, DataFrame], target, run_ts: datetime, run_id: str | None = None) -> list[str]:
    """Write current and history tables of all marts under one run time; returns the tables written.

    Nothing is written when all marts are empty. A single empty mart empties its current table. Publishing the same
    run again leaves the history as it is. A target that can commits the current tables together, as the last step:
    after a failure all of them are still those of the run before.
    """
    if all(mart.isEmpty() for mart in marts.values()):
        return []
    run_id = run_id or run_name(run_ts)
    # Each attempt has a version of its own, also of the same run.
    version = f"{run_id}-{uuid.uuid4().hex}"
    written: list[str] = []
    for name, mart in marts.items():
        rows = export_rows(name, mart, run_ts)
        try:
            target.replace(name, rows, run_ts, version)
            written.append(name)
            target.append(name, rows, run_ts, run_id)
            written.append(f"{name}_ts")
        except Exception as error:
            failed = f"{name}_ts" if name in written else name
            raise PublishError(failed, written) from error
    target.commit(version)
    return written
