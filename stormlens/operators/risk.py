"""Risk tables over daily forecasts / scored panels.

A forecast table has columns ``obs_date, station, rain_mm, risk, level``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlens.functions.risk import (
    LEVELS, level_from_rank, level_rank, rain_to_risk, risk_level, risk_level_rain, round_half_even,
)

ALERT_LEVELS = ("Siaga", "Bahaya")


def score_forecast(daily: DataFrame, variant: str = "clip100", level_by: str = "risk",
                   rain_digits: int = 1, risk_digits: int = 4) -> DataFrame:
    """Rain → risk probability (named variant) → level; rain and risk rounded
    half-even for presentation, the level taken from the unrounded value."""
    risk = rain_to_risk("rain_mm", variant)
    level = risk_level(risk) if level_by == "risk" else risk_level_rain("rain_mm")
    return daily.withColumns({"level": level, "risk": round_half_even(risk, risk_digits),
                              "rain_mm": round_half_even("rain_mm", rain_digits)})


def score_forecast_model(history: DataFrame, daily: DataFrame, score=None, seed_days: int = 365, rolls=(7, 30),
                         variant: str = "unit100", **features) -> DataFrame:
    """P5: risk of a daily forecast. Features of the forecast days are rebuilt with the end of
    the history as seed (W11); rows with all of them get a probability from ``score`` (feature
    rows → rows with ``proba``) and its level. Without a model the rain depth decides by
    ``variant``."""
    from stormlens.operators.features import features_with_seed

    f = features_with_seed(history, daily, seed_days=seed_days, rolls=rolls, **features)
    f = f.dropna(subset=[c for c in f.columns if c.startswith(("lag", "roll", "nbr_"))] + ["rain_mm"])
    f = f.withColumn("proba", rain_to_risk("rain_mm", variant)) if score is None else score(f)
    return f.select("obs_date", "station", "rain_mm", F.col("proba").alias("risk"), risk_level("proba").alias("level"))


def modal_level(group_cols, df: DataFrame, level_col: str = "level") -> DataFrame:
    """Most frequent level per group; ties go to the more severe level.

    Two aggregation levels: counts per (group, level) - at most 4 per group - then
    ``max_by`` over (count, severity). No group's rows are collected."""
    counts = df.filter(F.col(level_col).isNotNull()).groupBy(*group_cols, level_col) \
        .agg(F.count(F.lit(1)).alias("_n"))
    key = F.struct(F.col("_n"), level_rank(level_col))
    return counts.groupBy(*group_cols).agg(F.max_by(F.col(level_col), key).alias("modal_level"))


def daily_summary(forecast: DataFrame) -> DataFrame:
    """Per date - mean risk, mean rain, modal level."""
    means = forecast.groupBy("obs_date").agg(F.avg("risk").alias("mean_risk"),
                                             F.avg("rain_mm").alias("mean_rain"))
    return means.join(modal_level(["obs_date"], forecast), on="obs_date", how="left")


def monthly_summary(forecast: DataFrame) -> DataFrame:
    """Per month - mean risk, modal level, mean rain."""
    f = forecast.withColumn("month", F.trunc("obs_date", "MM"))
    means = f.groupBy("month").agg(F.avg("risk").alias("mean_risk"), F.avg("rain_mm").alias("mean_rain"))
    return means.join(modal_level(["month"], f), on="month", how="left")


def alert_counters(scored: DataFrame, n_stations: int = 3) -> DataFrame:
    """Station-days at alert / danger level integer-divided by the number of
    stations (as the dashboards count them, T9), the distinct alert dates, and mean rain."""
    lv = F.col("level")
    is_alert = lv.isin(*ALERT_LEVELS)
    return scored.agg(
        F.floor(F.count_if(is_alert) / F.lit(n_stations)).alias("alert_days"),
        F.floor(F.count_if(lv == "Bahaya") / F.lit(n_stations)).alias("danger_days"),
        F.count_distinct(F.when(is_alert, F.col("obs_date"))).alias("alert_dates"),
        F.avg("rain_mm").alias("mean_rain"))


def date_card(forecast: DataFrame, date, lexicographic: bool = False) -> DataFrame:
    """Selected-date card - mean risk, highest level, mean and max rain, number
    of stations at alert level. The highest level is by severity; ``lexicographic``
    reproduces the text-max of the original dashboards (T7)."""
    day = forecast.filter(F.col("obs_date") == F.lit(date).cast("date"))
    top = F.max("level") if lexicographic else level_from_rank(F.max(level_rank("level")))
    return day.agg(F.avg("risk").alias("mean_risk"), top.alias("max_level"),
                   F.avg("rain_mm").alias("mean_rain"), F.max("rain_mm").alias("max_rain"),
                   F.count_if(F.col("level").isin(*ALERT_LEVELS)).alias("n_alert_stations"))


def next_day_risk(panel: DataFrame, variant: str = "clip80", value_col: str = "rain_mm") -> DataFrame:
    """H+1 outlook - mean of the day's stations → risk (variant) → level,
    dated the next day."""
    per = panel.groupBy("obs_date").agg(F.avg(value_col).alias("mean_rain"))
    risk = rain_to_risk("mean_rain", variant)
    return per.select(F.date_add("obs_date", 1).alias("target_date"), "mean_rain",
                      risk.alias("risk"), risk_level(risk).alias("level"))


def severity_order() -> Column:
    return F.array(*[F.lit(x) for x in LEVELS])
