"""Table scans of the processed, analytics and published zones."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.schema import ANALYTICS, PROCESSED

_NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet table. Give the schema for tables with partition directories: directory values carry no type, so
    `02` would come back as a number."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def tolerant_scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet table without the files that vanished or cannot be read. A missing root is still an error."""
    reader = spark.read.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


_SMALL = 1 << 20


def skipped_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, size): the files below a path that tolerant_scan passes over. Files that give a row are read; of the others
    only an intact file without rows, which ends as it begins, has nothing to give. Names and sizes come from the listing, and the
    scan reads no column, so neither pass is one over the data."""
    named = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    gave_rows = tolerant_scan(spark, path, schema).select(named).distinct()
    mark = F.encode(F.lit("PAR1"), "UTF-8")
    intact = (F.substring("content", 1, 4) == mark) & (F.expr("right(content, 4)") == mark)
    without = listed.select(named, F.col("_metadata.file_size").alias("size")).join(gave_rows, "file", "left_anti")
    # Only a small file can be intact and empty; only those are opened.
    opened = listed.where(F.col("length") <= _SMALL).select(named, intact.alias("intact"))
    empty = opened.join(without.select("file"), "file", "left_semi").where("intact").select("file")
    return without.join(empty, "file", "left_anti")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at a path, or an empty one of the given schema if nothing has been written there yet. Any other
    failure is raised."""
    try:
        return tolerant_scan(spark, path, schema)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith(_NO_TABLE):
            return spark.createDataFrame([], schema)
        raise


def read_processed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: tolerant_scan(spark, f"{root}/{name}", schema) for name, schema in PROCESSED.items()}


def read_analytics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four marts; a mart never written is an empty table."""
    return {name: read_or_empty(spark, f"{root}/{name}", schema) for name, schema in ANALYTICS.items()}
