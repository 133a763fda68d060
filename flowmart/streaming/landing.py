"""Landing of message texts into a lake of JSON lines, one directory per day and zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowmart.functions import events as ev
from flowmart.operators import quality
from flowmart.schema import RAW_EVENT
from flowmart.sources.raw import LANDED, batch_directory, typed

EVERY_30_SECONDS = {"processingTime": "30 seconds"}
_ROUTING = "array<struct<zone: string, event_time: string>>"


def routed(lines: DataFrame) -> DataFrame:
    """Messages with their directory keys: value, outcome, date, zone.

    The body stays the text that came in, so unknown fields, nulls and the spaces of the zone name survive; only the
    two routing fields are decoded. A message that cannot be routed is kept under its own outcome (malformed,
    no_zone, no_time) instead of ending the job.
    """
    body = ev.one_line(F.coalesce(F.col("value"), F.lit("")))
    # A JSON parser stops after the first value of a text. Between brackets, anything but a single object shows: two
    # objects in one message, or text after the object, do not pass for one event.
    bracketed = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    decoded = lines.select(body.alias("value")).withColumn(
        "objects", F.from_json(bracketed, _ROUTING, {"allowSingleQuotes": "false"})
    )
    event = F.get("objects", F.lit(0))
    keys = decoded.select(
        "value",
        (F.is_valid_utf8("value") & (F.size("objects") == 1) & event.isNotNull()).alias("is_object"),
        event["zone"].alias("zone"),
        ev.event_day(ev.local_time(event["event_time"])).alias("date"),
    )
    outcome = (
        F.when(~F.coalesce("is_object", F.lit(False)), "malformed")
        .when(F.col("zone").isNull(), "no_zone")
        .when(F.col("date").isNull(), "no_time")
        .otherwise(LANDED)
    )
    return keys.select("value", outcome.alias("outcome"), "date", ev.zone_directory(F.col("zone")).alias("zone"))


def _stream_name(spark: SparkSession) -> str:
    """The id of the running stream: it lives in the checkpoint, so a restart keeps it and a new checkpoint has its own."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId").replace("-", "")


def write_batch(batch: DataFrame, number: int, root: str, stream: str) -> None:
    """Write the rows of a micro-batch to the directory of its number. They are written beside it and put in its place by
    one rename, so a batch is seen as a whole or not at all. A batch that is repeated after a failure overwrites what its
    first try left, or, if that had come into its place, leaves it: the same number holds the same messages."""
    place = f"stream={stream}/{batch_directory(number)}"
    as_path = batch.sparkSession._jvm.org.apache.hadoop.fs.Path
    there = as_path(f"{root}/{place}")
    files = there.getFileSystem(batch.sparkSession._jsparkSession.sessionState().newHadoopConf())
    if files.exists(there):
        return
    beside = f"{root}/_staging/{place.replace('=', '-')}"
    batch.write.mode("overwrite").partitionBy("landed_at", "outcome", "date", "zone").text(beside)
    files.mkdirs(there.getParent())
    if not files.rename(as_path(beside), there):
        raise OSError(f"cannot move batch {number} to {there}")


def _checked(landing: DataFrame) -> DataFrame:
    """The same rows, with the rules of the event contract counted over the messages that are events."""
    landed = F.struct(*landing.columns).alias("_landed")
    decoded = landing.select(landed, F.when(F.col("outcome") != "malformed", F.from_json("value", RAW_EVENT)).alias("_event"))
    is_event = F.col("_event").isNotNull().alias("_is_event")
    fields = typed(decoded.select("_landed", is_event, "_event.*"))
    return quality.observed(fields, F.col("_is_event")).select("_landed.*")


def land(
    lines: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, checked: bool = False
) -> StreamingQuery:
    """Start landing a stream of messages below `root/stream=/span=/batch=/landed_at=/outcome=/date=/zone=`.

    One pass, no shuffle and no state: each task writes the directories it has rows for, and nothing is held between
    micro-batches, so a stop loses nothing. Every batch has a directory of its own that appears at once, so each message
    lands exactly once, also after lost executors or a killed driver, and no log of the whole lake is kept or read. The
    time of landing is that of the batch in the checkpoint: a repeated batch has the same one. An event that comes late goes
    to the directory of its own day, in the batch that brought it. With `checked`, violations of the event contract are counted
    in the same pass; quality.observed_violations reads them from the progress of the query.
    """
    root = root.rstrip("/")
    landing = routed(lines).withColumn("landed_at", ev.utc_text(F.current_timestamp()))
    if checked:
        landing = _checked(landing)

    def put(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, root, _stream_name(batch.sparkSession))

    return (
        landing.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_30_SECONDS))
        .start()
    )
