"""Continuous refresh: the periodic full recompute as one streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowmart.operators.aggregates import processed_tables, sweep
from flowmart.operators.marts import analytics_tables
from flowmart.sinks.publish import publish, run_name

EVERY_60_SECONDS = {"processingTime": "60 seconds"}


def refresh(events: DataFrame, target, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the published tables up to date from a stream of events.

    Only new events are read; the state is one row per zone and one per road, so there is no watermark and late
    events count. Every batch publishes all marts. The run time is the batch time from the checkpoint: a batch that
    is repeated after a failure carries the same one and does not add to the history twice.
    """

    spark = events.sparkSession
    path = f"{checkpoint.rstrip('/')}_sweep"

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        # A few rows. Written once, they are not derived again from the state for each of the eight tables, also
        # not after lost executors, and the marts are planned adaptively, which Spark does not do inside a stream.
        batch.write.mode("overwrite").parquet(path)
        swept = spark.read.schema(batch.schema).parquet(path)
        newest = swept.select("run_ts").first()
        if newest is not None:
            run_ts = newest["run_ts"]
            marts = analytics_tables(processed_tables(swept), run_ts)
            publish(marts, target, run_ts, f"{run_name(run_ts)}-{batch_id}")

    return (
        sweep(events)
        .withColumn("run_ts", F.current_timestamp())
        .writeStream.outputMode("complete")
        .foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_60_SECONDS))
        .start()
    )
