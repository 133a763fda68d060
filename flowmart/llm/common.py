"""Helpers that several operators share: words, let-bindings for SQL expressions, row keys, driver garbage."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.workspace import new_folder

# A word is a run of anything but space and the characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once although use may name it often, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_key(text: Column) -> Column:
    """With doc_id it tells rows apart. Rows that are equal in both are copies of one row and get one result each."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def released(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished steps whose frames are gone. It only saves disk: no
    result depends on it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(frame: DataFrame, label: str) -> DataFrame:
    """frame, written to the shared working folder and read back; `discarded` removes it before the driver ends."""
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    back = frame.sparkSession.read.schema(frame.schema).parquet(path)
    back._stored_at = path
    return back


def discarded(*frames: DataFrame) -> None:
    """Removes stored frames that nothing will read again."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        released(spark)
