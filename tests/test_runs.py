"""Run-length features against row-by-row pandas definitions (property-based)."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stormlens.operators import features as FE

D0 = dt.date(2020, 1, 1)
VALUES = st.lists(st.one_of(st.none(), st.sampled_from([0.0, 0.05, 0.1, 0.2, 3.0, 40.0])),
                  min_size=1, max_size=60)


def _days_back(values, day, goes_on):
    """How many days right before ``day`` go on without a break, walking back from the eve."""
    n = 0
    while day - n > 0 and goes_on(values[day - n - 1]):
        n += 1
    return n


def _wet_runs(values):
    return [_days_back(values, i, lambda x: x is not None and x > 0) for i in range(len(values))]


def _dry_runs(values):
    """Unknown on the first day; a missing value doesn't break a dry run."""
    return [np.nan if i == 0 else _days_back(values, i, lambda x: x is None or not x > 0.1) for i in range(len(values))]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VALUES)
def test_runs_match_row_by_row_definitions(spark, values):
    rows = [("s", D0 + dt.timedelta(days=i), None if x is None else float(x)) for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
    plain = FE.add_dry_run(FE.add_wet_run(df)).orderBy("obs_date").toPandas()
    wet = F.coalesce(F.col("rain_mm") > 0, F.lit(False))
    dry = F.coalesce(F.col("rain_mm") > 0.1, F.lit(False))
    chunked = FE.run_before_chunked(FE.run_before_chunked(df, ~wet, "consec_rain", False, chunk_days=7),
                                    dry, "dry_days", True, chunk_days=7).orderBy("obs_date").toPandas()
    exp_wet, exp_dry = np.array(_wet_runs(values), float), np.array(_dry_runs(values), float)
    for got in (plain, chunked):
        assert np.array_equal(got["consec_rain"].to_numpy(float), exp_wet)
        assert np.array_equal(got["dry_days"].to_numpy(float), exp_dry, equal_nan=True)


@pytest.mark.parametrize("fn", ["mean", "sum", "max", "min"])
def test_long_windows_equal_sliding_frames(spark, fn):
    """Linear-time windows against the sliding frame, with gaps, all-missing stretches and windows longer than the history."""
    r = random.Random(3)
    start = dt.date(2001, 1, 1)
    rows = [(s, start + dt.timedelta(k), None if r.random() < 0.3 or 40 < k < 60 else round(r.uniform(-5, 90), 1)) for s, n in (("a", 150), ("b", 1), ("c", 23)) for k in range(n)]
    panel = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
    sizes = (1, 2, 7, 16, 400)
    slow = FE.add_rolling(panel, sizes, fn, linear_from=10 ** 6).orderBy("station", "obs_date").toPandas()
    fast = FE.add_rolling(panel, sizes, fn, linear_from=1).orderBy("station", "obs_date").toPandas()
    assert list(slow.columns) == list(fast.columns) and len(fast) == len(rows)
    for c in slow.columns[3:]:
        assert np.allclose(slow[c], fast[c], atol=1e-9, equal_nan=True)


def test_interval_panel_follows_the_readings(spark):
    """Same days, gaps and runs as the dense calendar, from at most 2r + 1 rows a station."""
    from stormlens.operators import intervals as IV
    from stormlens.operators import profile as P
    from stormlens.operators.calendar import densify
    r = random.Random(12)
    lo, hi = dt.date(2000, 1, 1), dt.date(2009, 12, 31)
    rows = [("a", lo + dt.timedelta(r.randrange(3600)), r.choice([None, 0.0, 0.05, 0.2, 5.0])) for _ in range(300)]
    rows += [("b", lo, 1.0), ("b", hi, 0.0), ("c", dt.date(1990, 1, 1), 3.0), ("d", None, 1.0), ("e", lo, None), ("e", lo + dt.timedelta(1), 7.0), ("e", lo, 2.0), ("f", dt.date(1999, 5, 5), 1.0), ("f", dt.date(2005, 5, 5), 1.0)]
    raw = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
    coded, dense = IV.to_intervals(raw, lo, hi), densify(raw, lo, hi)
    key = lambda df, *c: sorted((tuple(x) for x in df.select(*c).collect()), key=repr)
    assert key(IV.days(coded), "station", "obs_date", "rain_mm") == key(dense, "station", "obs_date", "rain_mm")
    assert coded.count() <= 2 * len(rows) + 6 and dense.count() == 6 * 3653
    assert key(IV.gaps(coded), "station", "gap_start", "gap_end", "gap_len") == key(P.gap_episodes(dense), "station", "gap_start", "gap_end", "gap_len")
    wet = IV.days_with_run(IV.with_runs(coded, "consec_rain", ~F.coalesce(F.col("value") > 0, F.lit(False)), False), "consec_rain")
    assert key(wet, "station", "obs_date", "consec_rain") == key(FE.add_wet_run(dense), "station", "obs_date", "consec_rain")
    dry = IV.days_with_run(IV.with_runs(coded, "dry_days", F.col("value") > 0.1, True), "dry_days")
    assert key(dry, "station", "obs_date", "dry_days") == key(FE.add_dry_run(dense), "station", "obs_date", "dry_days")
