"""Rewriting the landed lake: fewer files, or typed columns.

A flush leaves one small file per day and zone. Both writers shuffle with the rebalance hint: rows of one directory
are brought together, but a directory that is too large for one task, such as a zone with a third of all events, is
split over several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.sources.raw import LANDED, dated, landed_lines, read_landed, typed
from flowmart.workspace import written

BIN_BYTES = 256 << 20
OPEN_BYTES = 256 << 10
_LEDGER = "_ledger"
_PLAN = "stream string, span string, batch string, date string, zone string, path string, size bigint, bin bigint"


def _planned(spark: SparkSession, target: str) -> DataFrame:
    """Files that earlier runs have put into bins."""
    return spark.read.schema(_PLAN + ", through string").parquet(f"{target}/{_LEDGER}")


def _new_places(spark: SparkSession, landed_root: str, target: str) -> list[str]:
    """Directories of the landed lake that may hold batches no run has seen: of each stream the spans from the last
    planned one on. Older spans are not listed."""
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    files = as_path(landed_root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def below(folder: str) -> list[str]:
        path = as_path(folder)
        names = [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []
        return sorted(name for name in names if "=" in name and not name.startswith("_"))

    last: dict[str, str] = {}
    if below(f"{target}/{_LEDGER}"):
        newest = _planned(spark, target).groupBy("stream").agg(F.max("span"))
        last = {row[0]: row[1] for row in newest.collect()}
    streams = below(landed_root)
    return [
        f"{stream}/{span}"
        for stream in streams
        for span in below(f"{landed_root}/{stream}")
        if span.partition("=")[2] >= last.get(stream.partition("=")[2], "")
    ]


def _arrived(spark: SparkSession, landed_root: str, places: list[str]) -> DataFrame:
    """Landed files of these directories, by name and size; their content is not read."""
    listed = spark.read.format("binaryFile").option("basePath", landed_root).load([f"{landed_root}/{place}" for place in places])
    path = F.col("_metadata.file_path")

    def key(name: str):
        return F.regexp_extract(path, f"/{name}=([^/]*)/", 1).alias(name)

    names = ("stream", "span", "batch", "outcome", "date", "zone")
    rows = listed.select(*map(key, names), path.alias("path"), F.col("_metadata.file_size").alias("size"))
    return rows.where(F.col("outcome") == LANDED).drop("outcome")


def plan_bins(arrived: DataFrame, planned: DataFrame, bin_bytes: int) -> DataFrame:
    """Arrived files with their bin. The files of a day and zone stand in the order of their batches, and bin k takes
    those that begin between k and k + 1 times bin_bytes. Files never change, so neither do full bins: only the last one
    of a directory grows. Each file weighs OPEN_BYTES more than it has, so a bin of tiny files is bounded too."""
    before = planned.groupBy("date", "zone").agg(F.sum(F.col("size") + OPEN_BYTES).alias("before"))
    in_order = Window.partitionBy("date", "zone").orderBy("stream", "batch", "path")
    earlier = F.sum(F.col("size") + OPEN_BYTES).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce("before", F.lit(0)) + F.coalesce("earlier", F.lit(0))
    rows = arrived.withColumn("earlier", earlier).join(before, ["date", "zone"], "left")
    return rows.withColumn("bin", F.floor(start / bin_bytes).cast("bigint")).select(*[c.split()[0] for c in _PLAN.split(", ")])


def compact(spark: SparkSession, landed_root: str, target: str, bin_bytes: int = BIN_BYTES) -> int:
    """Bring the small landed files together in a second tree of JSON lines, `date=/zone=/bin=`; returns the number of
    bins written.

    Bins are planned from names and sizes of files alone. Only files that arrived since the last run are planned, and
    only bins that take some of them are written: a late event rewrites one bin of its day and zone, at most bin_bytes, not
    its day. The plan of every run is kept beside the tree and is written last, so a run that breaks off is repeated with
    the same bins, which replace what it had written. The landed lake is not touched.
    """
    landed_root, target = landed_root.rstrip("/"), target.rstrip("/")
    places = _new_places(spark, landed_root, target)
    if not places:
        return 0
    listed = _arrived(spark, landed_root, places)
    first = not _has_ledger(spark, target)
    planned = spark.createDataFrame([], _PLAN) if first else _planned(spark, target).drop("through")
    new = written(plan_bins(listed.join(planned.select("path"), "path", "left_anti"), planned, bin_bytes), "bins")
    through = new.agg(F.max(F.concat("stream", F.lit("-"), "batch"))).first()[0]
    if through is None:
        return 0
    touched = new.select("date", "zone", "bin").distinct()
    content = written(new.unionByName(planned.join(touched, ["date", "zone", "bin"], "left_semi")), "content")
    # Names of batch directories, as Spark's own listing holds them: the new ones, and those of bins that were not full.
    batches = [tuple(row) for row in content.select("stream", "span", "batch").distinct().collect()]
    lines = landed_lines(spark, landed_root, [f"stream={s}/span={x}/batch={b}" for s, x, b in sorted(batches)])
    lines = lines.where(F.col("outcome") == LANDED).select("value", "date", "zone", F.col("_metadata.file_path").alias("path"))
    (
        lines.join(content.select("path", "bin"), "path")
        .select("value", "date", "zone", "bin")
        .hint("rebalance", "date", "zone", "bin")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "zone", "bin")
        .text(target)
    )
    new.write.mode("overwrite").parquet(f"{target}/{_LEDGER}/through={through}")
    return touched.count()


def _has_ledger(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{_LEDGER}")
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def read_compacted(spark: SparkSession, target: str) -> DataFrame:
    """Lines of the compacted tree with their directory keys: value, date, zone, bin."""
    return spark.read.schema("value string, date string, zone string, bin bigint").text(target)


def build_typed_layer(
    spark: SparkSession, landed_root: str, target: str, first: str | None = None, last: str | None = None
) -> None:
    """Typed Parquet events of a range of days, one directory per day, zone as data.

    JSON is parsed once here instead of in every query; days written before are replaced, others stay.
    """
    events = dated(typed(read_landed(spark, landed_root, first, last).drop("date")))
    (
        events.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(target)
    )
