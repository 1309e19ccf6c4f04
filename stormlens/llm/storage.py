"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stormlens.session import ensure_checkpoint_dir, ship_package

BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package known to the Python workers, and bound the rows of an Arrow batch: rows
    are whole documents here, and a batch is held several times on its way."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder; removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: what follows
    survives a lost executor without recomputing ``df``, and reads the same rows
    whatever partitioning it had."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
