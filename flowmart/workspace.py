"""Shared working folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def working_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Executors must all see it, so a machine-local folder
    is only made up for a local master."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="flowmart-")
    return _local_roots[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the working folder, not yet existing. It is removed when the driver ends."""
    parent = f"{working_root(spark)}/flowmart/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(parent)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{parent}/data"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a written table. Cuts the lineage and lets several consumers share one pass
    over the events; unlike a cache it survives lost executors and gives the optimizer the true size."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
