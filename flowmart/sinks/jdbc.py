"""JDBC tables."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators.marts import run_time
from flowmart.operators.panels import DASHBOARD_RANGE, in_range
from flowmart.schema import MART_KEYS


def _wall_clock(moment: datetime) -> datetime:
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


class JdbcTarget:
    """Current tables `T` and history tables `T_ts` in a database.

    The driver jar comes with the Spark submission, user and password from the caller or from FLOWMART_JDBC_USER and
    FLOWMART_JDBC_PASSWORD. Each partition is one transaction; the tables of a run have no common one, and a current
    table whose insert breaks off stays empty until the run is repeated.

    History is read over several connections, each with a slice of time: of the range asked for, or for all history
    of `history_bounds`. The bounds only balance the slices, the first and the last take all rows outside. Whole
    history without them comes through one connection.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str] | None = None,
        connections: int = 8,
        history_bounds: tuple[datetime, datetime] | None = None,
    ):
        self.spark = spark
        self.url = url
        self.history_bounds = history_bounds
        # Spark opens a connection per partition written; this is the most it may have open.
        self.properties = {"numPartitions": str(connections), **(properties or {})}
        for name, variable in (("user", "FLOWMART_JDBC_USER"), ("password", "FLOWMART_JDBC_PASSWORD")):
            if name not in self.properties and variable in os.environ:
                self.properties[name] = os.environ[variable]

    def replace(self, table: str, rows: DataFrame, run_ts: datetime, version: str) -> None:
        """Truncate and insert, which keeps column types, indexes and grants of the table."""
        rows.write.mode("overwrite").option("truncate", "true").jdbc(self.url, table, properties=self.properties)

    def append(self, table: str, rows: DataFrame, run_ts: datetime, run_id: str) -> None:
        """Add the rows of a run that are not there yet, so publishing a run again, or after it broke off in the
        middle, adds what is missing. A run is known by its timestamp; that filter is evaluated in the database."""
        history = f"{table}_ts"
        # Appending no rows creates the table if need be, so that it can be read.
        rows.limit(0).write.mode("append").jdbc(self.url, history, properties=self.properties)
        present = self.read(history).where(F.col("timestamp") == run_time(run_ts)).alias("present")
        same_key = reduce(
            lambda both, one: both & one,
            [F.col(f"new.{key}").eqNullSafe(F.col(f"present.{key}")) for key in MART_KEYS[table]],
        )
        missing = rows.alias("new").join(present, same_key, "left_anti")
        missing.write.mode("append").jdbc(self.url, history, properties=self.properties)

    def commit(self, version: str) -> None:
        """Nothing to switch: each table was committed by its own insert."""

    def pinned(self) -> JdbcTarget:
        return self

    def read(self, table: str, bounds: tuple[datetime, datetime] | None = None) -> DataFrame:
        sliced = {}
        if bounds:
            first, last = (f"{_wall_clock(moment):%Y-%m-%d %H:%M:%S}" for moment in bounds)
            sliced = {"partitionColumn": "timestamp", "lowerBound": first, "upperBound": last}
        return self.spark.read.jdbc(self.url, table, properties=self.properties | sliced)

    def current(self, table: str) -> DataFrame:
        return self.read(table)

    def history(self, table: str, to: datetime | None = None, span: timedelta = DASHBOARD_RANGE) -> DataFrame:
        """History rows, optionally of the dashboard range that ends at `to`; the database evaluates the range."""
        bounds = self.history_bounds if to is None else (to - span, to)
        rows = self.read(f"{table}_ts", bounds)
        return rows if to is None else in_range(rows, to, span)
