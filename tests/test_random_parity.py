"""Randomised parity with plain pandas for interpolation and neighbour means."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stormlens.operators import features as FE
from stormlens.operators import impute as I

D0 = dt.date(2020, 1, 1)
CELL = st.one_of(st.none(), st.floats(min_value=0, max_value=100, allow_nan=False).map(lambda x: round(x, 1)))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(CELL, min_size=2, max_size=40).filter(lambda v: any(x is not None for x in v)))
def test_interpolation_matches_pandas_random(spark, values):
    v = pd.Series([np.nan if x is None else x for x in values], dtype="float64")
    rows = [("s", D0 + dt.timedelta(days=i), x) for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
    got = I.interpolate_linear(df).orderBy("obs_date").toPandas()["rain_mm"].to_numpy(float)
    exp = v.interpolate(method="linear", limit_direction="both").to_numpy()
    assert np.allclose(got, exp, atol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(CELL, CELL, CELL, CELL), min_size=1, max_size=15))
def test_neighbour_mean_matches_pandas_random(spark, days):
    stations = ["a", "b", "c", "d"]
    members = ["a", "b", "c"]
    wide = pd.DataFrame([[np.nan if x is None else x for x in d] for d in days], columns=stations)
    rows = [(s, D0 + dt.timedelta(days=i), None if pd.isna(wide.at[i, s]) else float(wide.at[i, s]))
            for i in range(len(days)) for s in stations]
    df = spark.createDataFrame(rows, "station string, obs_date date, v double")
    got = FE.neighbour_mean(df, ["v"], members=members).toPandas()
    for _, r in got.iterrows():
        i = (r["obs_date"] - D0).days
        others = [m for m in members if m != r["station"]]
        exp = wide.loc[i, others].mean()  # NaN-skipping, NaN when all missing
        if np.isnan(exp):
            assert pd.isna(r["nbr_v_avg"])
        else:
            assert abs(r["nbr_v_avg"] - exp) < 1e-9
