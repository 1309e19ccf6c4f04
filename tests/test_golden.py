"""Micro golden tests from the published intermediate results (FIXTURES.md §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stormlens.functions.calendar import add_calendar
from stormlens.functions.risk import risk_level
from stormlens.operators import features as FE
from stormlens.operators import profile as P

D0 = dt.date(2017, 1, 1)
SERIES = {
    "Lubuk_Minturun": [0.0, 19.5, 38.5, 51.0, 78.0, 68.0, 21.5, 0.0],
    "Nanggalo": [0.0, 31.0, 31.0, 46.0, 96.0, 48.0, 26.0, 0.0],
    "Parak_Karakah": [0.0, 15.0, 22.0, 57.0, 83.5, 40.8, 29.0, 0.0],
}


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(s, D0 + dt.timedelta(days=i), v) for s, vs in SERIES.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")


def _at(df, station, day, col):
    r = df.filter((F.col("station") == station) & (F.col("obs_date") == day)).select(col).first()
    return r[0]


def test_roll7_and_neighbour_lag1(panel):
    feats = FE.build_features(panel, rolls=(7,))
    d4 = dt.date(2017, 1, 4)
    assert _at(feats, "Lubuk_Minturun", d4, "roll7") == pytest.approx(19.333333, abs=1e-6)
    assert _at(feats, "Nanggalo", d4, "roll7") == pytest.approx(20.666667, abs=1e-6)
    assert _at(feats, "Parak_Karakah", d4, "roll7") == pytest.approx(12.333333, abs=1e-6)
    assert _at(feats, "Lubuk_Minturun", d4, "nbr_lag1_avg") == pytest.approx(26.5)
    assert _at(feats, "Nanggalo", d4, "nbr_lag1_avg") == pytest.approx(30.25)
    assert _at(feats, "Parak_Karakah", d4, "nbr_lag1_avg") == pytest.approx(34.75)
    d5 = dt.date(2017, 1, 5)
    assert _at(feats, "Lubuk_Minturun", d5, "roll7") == pytest.approx(27.25)
    assert _at(feats, "Nanggalo", d5, "roll7") == pytest.approx(27.0)
    assert _at(feats, "Parak_Karakah", d5, "roll7") == pytest.approx(23.5)
    assert _at(feats, "Lubuk_Minturun", d5, "nbr_lag1_avg") == pytest.approx(51.5)
    assert _at(feats, "Nanggalo", d5, "nbr_lag1_avg") == pytest.approx(54.0)
    assert _at(feats, "Parak_Karakah", d5, "nbr_lag1_avg") == pytest.approx(48.5)


def test_calendar_weekday_and_season(panel):
    cal = add_calendar(panel)
    d4 = dt.date(2017, 1, 4)
    assert _at(cal, "Nanggalo", d4, "hari_minggu") == 2
    assert _at(cal, "Nanggalo", d4, "musim") == "Hujan_Intensif"


def test_wet_and_dry_runs(panel):
    out = FE.add_dry_run(FE.add_wet_run(panel))
    lm = {r.obs_date.day: (r.consec_rain, r.dry_days) for r in
          out.filter(F.col("station") == "Lubuk_Minturun").collect()}
    assert lm[1] == (0, None)
    assert lm[2] == (0, 1)
    assert lm[3] == (1, 0)
    assert lm[8] == (6, 0)


def test_gap_summary(spark):
    vals = [1.0] * 3 + [None] * 20 + [2.0] + [None] + [3.0]
    rows = [("s", D0 + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
    r = P.gap_summary(df).first()
    assert (r.n_gaps, r.longest_gap, list(r.top_gaps)) == (2, 20, [20, 1])


def test_risk_levels(spark):
    df = spark.createDataFrame([(0.24,), (0.25,), (0.40,), (0.60,)], "p double")
    got = [r[0] for r in df.select(risk_level("p")).collect()]
    assert got == ["Aman", "Waspada", "Siaga", "Bahaya"]


def test_confusion_to_metrics_golden(spark):
    # TN 1376, FP 485, FN 61, TP 49 → acc .7230, precision .0918, recall .4455, F1 .1522
    from stormlens.operators.evaluate import binary_metrics, class_report
    rows = ([(0, 0.1)] * 1376 + [(0, 0.9)] * 485 + [(1, 0.1)] * 61 + [(1, 0.9)] * 49)
    pred = spark.createDataFrame(rows, "label int, proba double")
    m = binary_metrics(pred, 0.5).first()
    assert (m.tn, m.fp, m.fn, m.tp) == (1376, 485, 61, 49)
    assert round(m.accuracy, 4) == 0.7230
    assert round(m.precision, 4) == 0.0918
    assert round(m.recall, 4) == 0.4455
    assert round(m.f1, 4) == 0.1522
    rep = {r["class"]: r for r in class_report(pred, 0.5).collect()}
    assert rep["1"].support == 110 and rep["0"].support == 1861
    assert round(rep["accuracy"].f1, 4) == 0.7230
