"""Registered query: the incremental ingest stream (S1 + I1 + I3 streaming form).

The fixture readings are staged as one Parquet file per year in the shared
checkpoint folder, streamed one file per micro-batch, and the merged daily means
must equal the batch daily means (same oracle as ``i3_daily_mean``)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from stormlens.plans import fixture as fx
from stormlens.plans.registry import ORACLES, register
from stormlens.session import ensure_checkpoint_dir
from stormlens.sources.readings import READINGS_SCHEMA
from stormlens.streaming.ingest import daily_from_partials, ingest_stream


def _stream_daily(spark, sf_dir):
    root = os.path.join(ensure_checkpoint_dir(spark), f"ingest-{uuid.uuid4().hex}")
    staged = fx.region_readings(spark, sf_dir).select(*READINGS_SCHEMA.fieldNames()) \
        .withColumn("year", F.substring("data_timestamp", 1, 4))
    staged.repartition("year").write.partitionBy("year").parquet(f"{root}/incoming")
    ingest_stream(spark, f"{root}/incoming", READINGS_SCHEMA, f"{root}/partials", f"{root}/checkpoint",
                  files_per_trigger=1)
    return daily_from_partials(spark, f"{root}/partials")


@register("st1_stream_daily_mean")
def st1_stream_daily_mean(spark, sf_dir):
    return _stream_daily(spark, sf_dir).select("station", "obs_date", "rain_mm")


ORACLES["st1_stream_daily_mean"] = ORACLES["i3_daily_mean"]
