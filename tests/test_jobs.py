"""The end-to-end jobs run on the driver's tables and return whole results."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from stormlens.plans import fixture as fx
from stormlens.plans import jobs
from stormlens.sources.readings import load_fixture_readings


def test_jobs_end_to_end(spark):
    r = load_fixture_readings(spark, SF_ORACLE)
    lo, hi = fx.bounds(spark, SF_ORACLE)
    labelled = jobs.prepare_panel(r, lo, hi, prefix=fx.PREFIX, targets=fx.TARGETS)
    n_days = (hi - lo).days + 1
    # the imputed calendar is complete, so only the first 3 days (no lag3) drop out
    assert labelled.count() == len(fx.TARGETS) * (n_days - 3)
    assert labelled.filter(F.col("rain_mm").isNull()).count() == 0
    trained = jobs.train_evaluate(labelled, max_iter=5)
    rows = {r["threshold"]: r for r in trained["metrics"].collect()}
    assert rows[0.4]["recall"] >= rows[0.5]["recall"]
    assert trained["sweep"].count() == 19
    risk = jobs.forecast_risk(labelled.select("station", "obs_date", "rain_mm"), "2001-09-01", horizon=12)
    assert risk["daily"].count() == len(fx.TARGETS) * 365
    assert set(r[0] for r in risk["daily"].select("level").distinct().collect()) <= {"Aman", "Waspada", "Siaga", "Bahaya"}
