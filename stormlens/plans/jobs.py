"""The three end-to-end jobs of the studied project, composed from the operators.

* ``prepare_panel``   - step chain: readings → region → cleaned → dense calendar →
                        KNN-imputed → features → P95 label (SURVEY §3.1)
* ``train_evaluate``  - one-shot trainer: date split → robust scaling → weighted
                        boosted trees → metrics at two thresholds, sweep,
                        importances (SURVEY §3.2)
* ``forecast_risk``   - monthly totals → seasonal forecast → daily
                        disaggregation → risk levels and month summary (SURVEY §3.3)

Each returns DataFrames (lazy where possible); reused intermediates are cut into
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.operators import evaluate as V
from stormlens.operators import forecast as FC
from stormlens.operators import model as M
from stormlens.operators import prep as E
from stormlens.operators import risk as RK
from stormlens.operators.calendar import densify
from stormlens.operators.clean import drop_incomplete, filter_prefix, to_station_days
from stormlens.operators.features import build_features
from stormlens.operators.impute import knn_impute
from stormlens.operators.label import label_extreme
from stormlens.session import cut_lineage

FEATURES = ["bulan", "hari_tahun", "hari_minggu", "lag1", "lag2", "lag3", "roll7", "roll30",
            "nbr_lag1_avg", "nbr_roll7_avg"]


def prepare_panel(readings: DataFrame, start, end, prefix: str | None = None, targets=None,
                  region_prefix_len: int = 4, k: int = 5) -> DataFrame:
    """Labelled long panel of the target stations (all stations when None).

    Every region (stations sharing ``region_prefix_len`` leading id characters) is
    imputed from its own stations."""
    r = filter_prefix(readings, "station_id", prefix) if prefix else readings
    grid = densify(to_station_days(r), start, end)
    grid = grid.withColumn("_region", F.substring("station", 1, region_prefix_len))
    panel = knn_impute(grid, k=k, region_col="_region").drop("_region", "imputed")
    panel = cut_lineage(panel)
    feats = build_features(panel, targets=targets, members=targets, rolls=(7, 30))
    return drop_incomplete(label_extreme(feats), ["rain_mm"] + FEATURES)


def train_evaluate(labelled: DataFrame, frac: float = 0.8, thresholds=(0.5, 0.4),
                   max_iter: int = 100, max_depth: int = 3, step: float = 0.1) -> dict:
    """Fit on the earlier dates, evaluate on the later ones."""
    lab = cut_lineage(E.date_split(labelled, frac))
    train, test = lab.filter("split = 'train'"), lab.filter("split = 'test'")
    params = E.fit_robust(train, FEATURES)
    train = cut_lineage(E.class_weights(E.apply_scaler(train, params), mode="ratio"))
    test = E.apply_scaler(test, params)
    model = M.fit_gbt(train, FEATURES, max_iter=max_iter, max_depth=max_depth, step=step)
    scored = cut_lineage(M.score(model, test))
    metrics = None
    for t in thresholds:
        m = V.binary_metrics(scored, t).withColumn("threshold", F.lit(t))
        metrics = m if metrics is None else metrics.unionByName(m)
    return {"model": model, "scaler": params, "scored": scored, "metrics": metrics,
            "sweep": V.threshold_sweep(scored), "importance": M.importance_table(model, FEATURES)}


def forecast_risk(panel: DataFrame, start_month, horizon: int = 36, variant: str = "unit100",
                  mode: str = "share") -> dict:
    """Seasonal-mean forecast of the network's monthly total, split into daily rain
    per station and scored into risk levels."""
    monthly = FC.monthly_totals(panel, "sum")
    fc = FC.seasonal_mean_forecast(monthly, start_month, horizon)
    daily = FC.disaggregate(fc, FC.monthly_climatology(panel), mode=mode)
    scored = RK.score_forecast(daily, variant)
    return {"monthly_forecast": fc, "daily": scored, "monthly_summary": RK.monthly_summary(scored),
            "daily_summary": RK.daily_summary(scored)}


def run_all(spark: SparkSession, readings: DataFrame, start, end, prefix, targets, forecast_from):
    """The three jobs in sequence (what the studied scripts do one after another)."""
    labelled = prepare_panel(readings, start, end, prefix=prefix, targets=targets)
    trained = train_evaluate(labelled)
    risk = forecast_risk(labelled.select("station", "obs_date", "rain_mm"), forecast_from)
    return labelled, trained, risk
