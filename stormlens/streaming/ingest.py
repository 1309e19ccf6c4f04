"""Incremental ingest of reading exports (S1 + I1 + I3 as a Structured Streaming job).

New export files dropped into a folder are picked up by a file-source stream;
each micro-batch is cleaned (sentinels, day parsing) and reduced to partial sums
per (station, day) which ``foreachBatch`` writes to ``<table>/batch_id=<n>`` with
overwrite - an idempotent sink, so a batch replayed after a failure or restart
(the stream's checkpoint location records progress) replaces its own output
instead of duplicating it. Daily means are the merge of the partials, exactly
equal to the batch ``daily_mean`` over all files. No state store is needed: the
merge is a plain aggregate over the partials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormlens.operators.clean import to_station_days


def _write_partials(table_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy("station", "obs_date").agg(
            F.sum("rain_mm").alias("sum_mm"), F.count("rain_mm").alias("n_valid"),
            F.count(F.lit(1)).alias("n_rows"))
        partial.write.mode("overwrite").parquet(f"{table_dir}/batch_id={batch_id}")
    return write


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table_dir: str,
                  checkpoint_dir: str, fmt: str = "parquet", files_per_trigger: int | None = None,
                  available_now: bool = True):
    """Start the ingest stream; returns the ``StreamingQuery`` (already finished when
    ``available_now`` - process what is there, then stop)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    cleaned = to_station_days(reader.load(source_dir))
    writer = cleaned.writeStream.foreachBatch(_write_partials(table_dir)) \
        .option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def daily_from_partials(spark: SparkSession, table_dir: str) -> DataFrame:
    """Merge the per-batch partials into daily means (NULL when no valid value)."""
    p = spark.read.parquet(table_dir)
    return p.groupBy("station", "obs_date").agg(
        (F.sum("sum_mm") / F.sum("n_valid")).alias("rain_mm"), F.sum("n_rows").alias("n_rows"))
