"""The ingest stream resumes from its checkpoint without duplicating a batch."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stormlens.operators.clean import daily_mean, to_station_days
from stormlens.sources.readings import READINGS_SCHEMA, load_fixture_readings
from stormlens.streaming.ingest import daily_from_partials, ingest_stream


def test_restart_picks_up_new_files_only(spark):
    root = tempfile.mkdtemp(prefix="stormlens-stream-")
    readings = load_fixture_readings(spark, SF_SMALL).select(*READINGS_SCHEMA.fieldNames())
    early = readings.filter(F.col("data_timestamp") < "1998")
    late = readings.filter(F.col("data_timestamp") >= "1998")
    early.write.parquet(os.path.join(root, "incoming", "part=early"))
    ingest_stream(spark, f"{root}/incoming", READINGS_SCHEMA, f"{root}/partials", f"{root}/ckpt")
    # a new export arrives; the restarted stream processes only that file
    late.write.parquet(os.path.join(root, "incoming", "part=late"))
    ingest_stream(spark, f"{root}/incoming", READINGS_SCHEMA, f"{root}/partials", f"{root}/ckpt")

    got = daily_from_partials(spark, f"{root}/partials")
    exp = daily_mean(to_station_days(readings))
    assert got.agg(F.sum("n_rows")).first()[0] == readings.count()  # no batch counted twice
    diff = got.join(exp.withColumnRenamed("rain_mm", "exp"), ["station", "obs_date"], "full_outer") \
        .filter(~F.col("rain_mm").eqNullSafe(F.col("exp")) & (F.abs(F.col("rain_mm") - F.col("exp")) > 1e-9)
                | F.col("rain_mm").isNull() & F.col("exp").isNotNull()
                | F.col("rain_mm").isNotNull() & F.col("exp").isNull())
    assert diff.count() == 0
