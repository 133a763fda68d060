"""Raw event sources: the message topic, JSON trees, and the landed lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.functions import events as ev
from flowmart.schema import RAW_EVENT, TYPED_EVENT

# The topic, and the flush rule of the landing: this many messages or this much time.
TOPIC = "traffic-events"
FLUSH_MESSAGES = 50
FLUSH_TIME = "30s"

LANDED = "landed"
LANDED_LAYOUT = (
    "value string, stream string, span string, batch string, landed_at string, outcome string, date string, zone string"
)
# Batches of a span share a directory, so that neither a listing nor a directory grows with the age of the lake.
SPAN = 1000


def topic_lines(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    group: str | None = None,
    min_messages: int | None = FLUSH_MESSAGES,
    max_wait: str = FLUSH_TIME,
    max_messages: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of message texts from a Kafka topic, starting at the latest offsets.

    A micro-batch starts once min_messages are waiting or max_wait has passed, whichever comes first. Raise
    min_messages on a busy topic: it also sets how large the landed files become. max_messages bounds one batch
    after a long stop; min_partitions splits the offsets of a hot topic partition over several tasks. Offsets live in
    the sink's checkpoint, so a group only names the consumers for the broker.
    Needs the spark-sql-kafka package on the cluster; every consumer below takes any stream with a text column
    `value`, such as file_lines.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group is not None:
        reader = reader.option("groupIdPrefix", group)
    if min_messages is not None:
        reader = reader.option("minOffsetsPerTrigger", min_messages).option("maxTriggerDelay", max_wait)
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of lines from text files that appear below a folder."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All JSON lines below a folder. Directory keys are not read as columns, so `zone` keeps its spaces.

    The fixed schema saves the inference pass over all text. A malformed line gives a row of NULLs; a value of the
    wrong type gives NULL for that value only, where inference would retype the whole column.
    """
    return spark.read.schema(RAW_EVENT).option("recursiveFileLookup", "true").json(path)


def raw_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a stream, for the continuous refresh."""
    reader = spark.readStream.schema(RAW_EVENT).option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def batch_directory(number: int) -> str:
    """Directory of a batch below that of its stream."""
    return f"span={number // SPAN:09d}/batch={number:012d}"


def landed_lines(spark: SparkSession, root: str, places: list[str] | None = None) -> DataFrame:
    """Lines of the landing sink with their directory keys, see LANDED_LAYOUT.

    Batches appear as a whole, and leftovers of failed ones lie in a hidden folder, so the tree itself is the truth and
    there is no log to read. Filters on all keys prune directories; places (directories below the root, such as
    `stream=.../span=...`) keep Spark from listing any others.
    """
    root = root.rstrip("/")
    reader = spark.read.schema(LANDED_LAYOUT).option("basePath", root)
    return reader.text(root if places is None else [f"{root}/{place}" for place in places])


def _decoded(lines: DataFrame, *kept: str) -> DataFrame:
    """Events of landed lines. All fields come from the body, only `date` and what else is kept from the directory."""
    landed = lines.where(F.col("outcome") == LANDED)
    return landed.select(F.from_json("value", RAW_EVENT).alias("event"), "date", *kept).select("event.*", "date", *kept)


def read_landed(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events of the landing sink, optionally of a range of days; columns as read_raw plus date. Messages that could
    not be routed are left out; read_raw on the same root would give them too."""
    lines = landed_lines(spark, root)
    if first is not None:
        lines = lines.where(F.col("date") >= first)
    if last is not None:
        lines = lines.where(F.col("date") <= last)
    return _decoded(lines)


def read_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Events of the landing sink with the batch that brought them and the moment it landed, the second time axis beside
    the event time: columns as read_landed plus batch and landed_at."""
    events = _decoded(landed_lines(spark, root), "batch", "landed_at")
    return events.withColumn("landed_at", ev.utc_moment(F.col("landed_at")))


def spans_from(first: int) -> str:
    """Pattern of the span directories from a number on."""
    digits = f"{first:09d}"
    later = [
        f"{digits[:k]}[{int(digits[k]) + 1}-9]{'?' * (len(digits) - k - 1)}" for k in range(len(digits)) if digits[k] != "9"
    ]
    return "span={" + ",".join([digits, *later]) + "}"


def landed_stream(
    spark: SparkSession, root: str, files_per_trigger: int | None = None, first_span: int = 0
) -> DataFrame:
    """The same events as a stream: every landed batch is taken once. For each batch of its own the stream lists the spans from
    first_span on; raise it at a restart, up to a span whose batches have all been taken, and old spans are not listed
    again."""
    root = root.rstrip("/")
    reader = spark.readStream.schema(LANDED_LAYOUT).option("basePath", root)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _decoded(reader.text(f"{root}/stream=*/{spans_from(first_span)}" if first_span else root))


def typed(events: DataFrame) -> DataFrame:
    """Raw events with event_time as TIMESTAMP_NTZ (NULL where the text is no ISO time)."""
    return events.withColumn("event_time", ev.local_time(F.col("event_time")))


def dated(events: DataFrame) -> DataFrame:
    """Typed events with their day as text; events without a time get the day `undated`."""
    return events.withColumn("date", F.coalesce(ev.event_day(F.col("event_time")), F.lit(ev.UNDATED)))


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """Typed layer: columnar events with one directory per day. Filters on date prune directories, and a query reads
    only the columns it uses."""
    return spark.read.schema(TYPED_EVENT).parquet(path)
