"""Lake tables: replaced as a whole, or appended run by run."""

from __future__ import annotations

import copy
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from flowmart.operators.panels import DASHBOARD_RANGE, in_range


def replace_table(frame: DataFrame, path: str, form: str = "parquet", partition_by: tuple = ()) -> None:
    """Write a table beside the old one, then put it in its place.

    A job that fails midway leaves the old table as it was, and the frame may read from the very path it replaces.
    The swap is two renames of a directory: quick on HDFS, a copy on object stores.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    # Scans pass over names with a leading underscore, but not if they hold an equals sign.
    hidden = f"{parent}/_{name.replace('=', '-')}"
    following, previous = f"{hidden}.next", f"{hidden}.previous"
    spark = frame.sparkSession
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    files = as_path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(as_path(previous)) and not files.exists(as_path(path)):
        # A driver was lost between the two renames: the old table counts until the new one is written.
        files.rename(as_path(previous), as_path(path))

    frame.write.mode("overwrite").format(form).partitionBy(*partition_by).save(following)
    files.delete(as_path(previous), True)
    replaced = files.exists(as_path(path))
    if replaced and not files.rename(as_path(path), as_path(previous)):
        raise OSError(f"cannot move the old table away from {path}")
    if not files.rename(as_path(following), as_path(path)):
        if replaced:
            files.rename(as_path(previous), as_path(path))
        raise OSError(f"cannot move the new table to {path}")
    files.delete(as_path(previous), True)
    spark.catalog.refreshByPath(path)


class LakeTarget:
    """Current tables `T` and history tables `T_ts` as Parquet below one folder.

    The current tables of a run are written to a folder of their own, `runs/<version>/T`, and become visible together
    by one empty file, `commits/<number>-<version>`; the greatest name counts, and runs that commit at once get numbers
    of their own. So a reader that has opened a table can
    finish, runs published at once do not touch each other's files, and a run that breaks off is never seen. Versions
    that are no longer current, or were never committed, are deleted by later runs once they are older than `keep`,
    which has to be longer than any publishing or reading takes.
    """

    def __init__(self, spark: SparkSession, root: str, keep: timedelta = timedelta(days=1)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._seen: list[str] | None = None

    def replace(self, table: str, rows: DataFrame, run_ts: datetime, version: str) -> None:
        """Write the current table of a version; it is visible after the commit."""
        rows.write.mode("overwrite").parquet(f"{self.root}/runs/{version}/{table}")

    def commit(self, version: str) -> None:
        """Switch all current tables of a version at once."""
        files = self._files()
        number = max([int(name.partition("-")[0]) + 1 for name in (*self._listed("commits"), *self._listed("claims"))], default=0)
        # Creating a file that is there already fails, so of two runs that see the same number one goes on to the next.
        while not self._created(files, f"claims/{number:012d}"):
            number += 1
        files.createNewFile(self._path(f"commits/{number:012d}-{version}"))
        self._clean_up()

    def pinned(self) -> LakeTarget:
        """The same target as committed now: later commits do not change which current tables it reads."""
        target = copy.copy(self)
        target._seen = self._commits()
        return target

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("commits").getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _created(self, files, name: str) -> bool:
        """Creates an empty file; false if it is there already, also if another run created it just now."""
        path = files.makeQualified(self._path(name))
        if path.toUri().getScheme() == "file":
            # Hadoop looks for a local file before it creates it, and another run may come between; here it is one step.
            files.mkdirs(path.getParent())
            return self.spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            return files.createNewFile(path)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def _listed(self, folder: str) -> dict[str, datetime]:
        """Names in a folder and when they were last changed."""
        files, path = self._files(), self._path(folder)
        found = files.listStatus(path) if files.exists(path) else []
        return {
            entry.getPath().getName(): datetime.fromtimestamp(entry.getModificationTime() / 1000, timezone.utc)
            for entry in found
        }

    def _commits(self) -> list[str]:
        """Names of the commits, the newest first."""
        return sorted(self._listed("commits"), reverse=True)

    def _clean_up(self) -> None:
        files, commits = self._files(), self._listed("commits")
        oldest = datetime.now(timezone.utc) - self.keep
        newest = max(commits)
        # A run may publish some of the tables only; what the newest one lacks is still current in an older one.
        renewed = set(self._listed(f"runs/{newest.partition('-')[2]}"))
        for name, changed in commits.items():
            folder = f"runs/{name.partition('-')[2]}"
            if name != newest and changed < oldest and set(self._listed(folder)) <= renewed:
                files.delete(self._path(f"commits/{name}"), False)
                files.delete(self._path(folder), True)
        committed = {name.partition("-")[2] for name in commits}
        for claim, changed in self._listed("claims").items():
            if changed < oldest and claim < newest:
                files.delete(self._path(f"claims/{claim}"), False)
        for version, changed in self._listed("runs").items():
            if version not in committed and changed < oldest:
                files.delete(self._path(f"runs/{version}"), True)

    def append(self, table: str, rows: DataFrame, run_ts: datetime, run_id: str) -> None:
        """Add the rows of a run to the history, by day and hour. A run that is published again replaces its own rows
        only, also from a session in another time zone: day and hour are those of the moment in UTC."""
        (
            _by_hour(rows)
            .withColumn("run_id", F.lit(run_id))
            .hint("rebalance", "run_date", "run_hour")
            .sortWithinPartitions("run_date", "run_hour", "run_id", "timestamp")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_date", "run_hour", "run_id")
            .parquet(f"{self.root}/{table}_ts")
        )

    def compact_history(self, table: str, day: str) -> None:
        """Bring the runs of a past day together: a file per hour, sorted by time, instead of one per run. Only for days
        whose runs will not be published again."""
        rows = self._stored_history(table, f"run_date={day}").drop("run_date", "run_hour", "run_id")
        merged = _by_hour(rows).drop("run_date").withColumn("run_id", F.lit("compacted")).hint("rebalance", "run_hour")
        merged = merged.sortWithinPartitions("run_hour", "run_id", "timestamp")
        replace_table(merged, f"{self.root}/{table}_ts/run_date={day}", partition_by=("run_hour", "run_id"))

    def _stored_history(self, table: str, part: str | None = None) -> DataFrame:
        """History with its directory keys as text. With a part (a pattern below the table) only its directories are listed."""
        root = f"{self.root}/{table}_ts"
        stored = self.spark.read.option("basePath", root).parquet(f"{root}/{part}" if part else root)
        return stored.withColumns({key: F.col(key).cast("string") for key in ("run_date", "run_hour")})

    def current(self, table: str) -> DataFrame:
        """The table of the newest committed run that has it. Raises PATH_NOT_FOUND where there is none."""
        files = self._files()
        for name in self._commits() if self._seen is None else self._seen:
            folder = f"runs/{name.partition('-')[2]}/{table}"
            if files.exists(self._path(folder)):
                return self.spark.read.parquet(f"{self.root}/{folder}")
        return self.spark.read.parquet(f"{self.root}/runs/{table}")

    def history(self, table: str, to: datetime | None = None, span: timedelta = DASHBOARD_RANGE) -> DataFrame:
        """History rows, optionally of the dashboard range that ends at `to`: only the hours of the range are listed, and
        within their files, which are sorted by time, row groups outside are not read."""
        if to is None:
            return self._stored_history(table).drop("run_date", "run_hour", "run_id")
        try:
            rows = self._stored_history(table, _hours(self._readings(to), span))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self._stored_history(table).limit(0)
        return in_range(rows.drop("run_date", "run_hour", "run_id"), to, span)

    def _readings(self, to: datetime) -> set[datetime]:
        """The wall-clock times, in UTC, that a moment may stand for: tables with a time zone are laid out by the moment in UTC,
        tables without one by their own clock. Where Python does not know the session's zone, all zones there are count."""
        known = to.astimezone(timezone.utc).replace(tzinfo=None) if to.tzinfo else to
        try:
            zone = ZoneInfo(self.spark.conf.get("spark.sql.session.timeZone"))
        except (ZoneInfoNotFoundError, ValueError):
            return {known + timedelta(hours=shift) for shift in range(-18, 19)}
        if to.tzinfo:
            return {known, to.astimezone(zone).replace(tzinfo=None)}
        return {known, to.replace(tzinfo=zone).astimezone(timezone.utc).replace(tzinfo=None)}


def _by_hour(rows: DataFrame) -> DataFrame:
    """History rows with the day and hour of their time, that of moments in UTC."""
    moment = F.col("timestamp")
    if isinstance(rows.schema["timestamp"].dataType, TimestampType):
        moment = F.to_utc_timestamp(moment, F.current_timezone())
    # NULL times have a directory too, which no range reads.
    return rows.withColumns(
        {"run_date": moment.cast("date").cast("string"), "run_hour": F.lpad(F.hour(moment).cast("string"), 2, "0")}
    )


def _hours(ends: set[datetime], span: timedelta) -> str:
    """Pattern of the directories of all hours that a span up to one of the ends touches."""
    parts = set()
    for end in ends:
        hour = (end - span).replace(minute=0, second=0, microsecond=0)
        while hour <= end:
            parts.add(f"run_date={hour:%Y-%m-%d}/run_hour={hour:%H}")
            hour += timedelta(hours=1)
    return "{" + ",".join(sorted(parts)) + "}"
