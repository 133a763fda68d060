"""Jobs: `python -m flowmart <job> ...`, or this file given to spark-submit with the package as --py-files.

The master, memory and all other cluster settings come from the submission.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from flowmart.functions.events import UNDATED
from flowmart.operators import compaction
from flowmart.plans import batch
from flowmart.sinks.jdbc import JdbcTarget
from flowmart.sinks.lake import LakeTarget
from flowmart.sources import raw
from flowmart.streaming.landing import land
from flowmart.streaming.refresh import refresh

_OPEN_FILES = 64


def _events(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    """Only the columns a job uses are read from the typed layer; JSON text is parsed as a whole either way."""
    if options.events_from == "typed":
        return raw.read_typed(spark, options.raw)
    if options.events_from == "landed":
        return raw.read_landed(spark, options.raw)
    return raw.read_raw(spark, options.raw)


def _target(spark: SparkSession, options: argparse.Namespace):
    if options.jdbc_url:
        properties = {"driver": options.jdbc_driver} if options.jdbc_driver else {}
        return JdbcTarget(spark, options.jdbc_url, properties)
    return LakeTarget(spark, options.published)


def _moment(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="flowmart")
    parser.add_argument("--run-time", type=_moment, help="ISO time of the run; a retry with the same one adds nothing")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *folders: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        for folder in folders:
            added.add_argument(f"--{folder}", required=True)
        return added

    def reads_events(added: argparse.ArgumentParser) -> None:
        added.add_argument("--events-from", choices=("json", "landed", "typed"), default="json")

    def publishes(added: argparse.ArgumentParser) -> None:
        place = added.add_mutually_exclusive_group(required=True)
        place.add_argument("--published")
        place.add_argument("--jdbc-url")
        added.add_argument("--jdbc-driver")

    landing = job("land", "lake", "checkpoint")
    source = landing.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--inbox")
    landing.add_argument("--topic", default=raw.TOPIC)
    landing.add_argument("--starting", default="latest")
    landing.add_argument("--group")
    landing.add_argument("--min-messages", type=int, default=raw.FLUSH_MESSAGES)
    landing.add_argument("--max-wait", default=raw.FLUSH_TIME)
    landing.add_argument("--max-messages", type=int)
    landing.add_argument("--min-partitions", type=int)
    reads_events(job("process", "raw", "processed"))
    job("analyze", "processed", "analytics")
    publishes(job("publish", "analytics"))
    chain = job("chain", "raw", "lake")
    reads_events(chain)
    publishes(chain)
    publishes(job("incremental", "typed", "partials", "first", "last"))
    refreshing = job("refresh", "raw", "checkpoint")
    refreshing.add_argument("--events-from", choices=("json", "landed"), default="landed")
    refreshing.add_argument("--files-per-trigger", type=int)
    refreshing.add_argument("--first-span", type=int, default=0, help="landed spans from this one on are listed")
    refreshing.add_argument("--state-partitions", type=int, default=8)
    publishes(refreshing)
    job("compact-history", "published", "table", "day")
    compacting = job("compact", "lake", "target")
    compacting.add_argument("--bin-bytes", type=int, default=compaction.BIN_BYTES, help="landed bytes brought together")
    for rewriting in (compacting, job("type", "lake", "target", "first", "last")):
        rewriting.add_argument("--task-size", default="256m", help="shuffled bytes per written file")
    return parser


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"flowmart {options.job}").getOrCreate()
    run_ts = options.run_time or datetime.now(timezone.utc)
    match options.job:
        case "land":
            # A batch touches few directories: keep them open instead of sorting. Spark sorts if there are more.
            spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", _OPEN_FILES)
            if options.servers:
                lines = raw.topic_lines(
                    spark,
                    options.servers,
                    options.topic,
                    options.starting,
                    options.group,
                    min_messages=options.min_messages,
                    max_wait=options.max_wait,
                    max_messages=options.max_messages,
                    min_partitions=options.min_partitions,
                )
                # The source itself waits for enough messages, so the next batch may start at once.
                query = land(lines, options.lake, options.checkpoint, {"processingTime": "0 seconds"})
            else:
                query = land(raw.file_lines(spark, options.inbox), options.lake, options.checkpoint)
            query.awaitTermination()
        case "process":
            batch.write_processed(_events(spark, options), options.processed, run_ts)
        case "analyze":
            batch.write_analytics(spark, options.processed, options.analytics, run_ts)
        case "publish":
            batch.publish_analytics(spark, options.analytics, _target(spark, options), run_ts)
        case "chain":
            batch.run_chain(_events(spark, options), options.lake, _target(spark, options), run_ts)
        case "incremental":
            events = raw.read_typed(spark, options.typed)
            # Events without a day belong to no range, so their partials are recomputed by every run.
            touched = events.where(events.date.between(options.first, options.last) | (events.date == UNDATED))
            batch.run_incremental(events, touched, options.partials, _target(spark, options), run_ts)
        case "refresh":
            # One state row per zone and road needs few partitions. The first start fixes their number.
            spark.conf.set("spark.sql.shuffle.partitions", options.state_partitions)
            if options.events_from == "landed":
                events = raw.landed_stream(spark, options.raw, options.files_per_trigger, options.first_span)
            else:
                events = raw.raw_stream(spark, options.raw, options.files_per_trigger)
            refresh(events, _target(spark, options), options.checkpoint).awaitTermination()
        case "compact-history":
            LakeTarget(spark, options.published).compact_history(options.table, options.day)
        case "compact":
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", options.task_size)
            compaction.compact(spark, options.lake, options.target, options.bin_bytes)
        case "type":
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", options.task_size)
            compaction.build_typed_layer(spark, options.lake, options.target, options.first, options.last)


if __name__ == "__main__":
    main()
