"""Monthly series, seasonal forecasts and their daily disaggregation (A15, A16,
P1, P3; P2 lives in ``seasonal_ar``).

Series tables: ``monthly(series, month DATE first-of-month, total)``.
Everything is keyed by ``series`` so thousands of series are forecast in the same
aggregate jobs; nothing is collected per series.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlens.functions.calendar import days_in_month


def monthly_totals(panel: DataFrame, combine: str = "sum", series_col: str | None = None,
                   value_col: str = "rain_mm") -> DataFrame:
    """Month sums per station (a month with no value sums to 0), then the
    cross-station ``sum`` or ``mean`` per series (default one network series)."""
    p = panel.withColumn("series", F.col(series_col) if series_col else F.lit("network"))
    per_station = p.groupBy("series", "station", F.trunc("obs_date", "MM").alias("month")) \
        .agg(F.coalesce(F.sum(value_col), F.lit(0.0)).alias("station_total"))
    agg = F.sum if combine == "sum" else F.avg
    return per_station.groupBy("series", "month").agg(agg("station_total").alias("total"))


def monthly_climatology(panel: DataFrame, value_col: str = "rain_mm",
                        series_col: str | None = None) -> DataFrame:
    """Mean daily value per (station, calendar month)."""
    p = panel.withColumn("series", F.col(series_col) if series_col else F.lit("network"))
    return p.groupBy("series", "station", F.month("obs_date").alias("cal_month")) \
        .agg(F.avg(value_col).alias("clim"))


def seasonal_mean_forecast(monthly: DataFrame, start_month, horizon: int = 36,
                           band=(0.7, 1.3)) -> DataFrame:
    """Each future month = historical mean of the same calendar month of its
    series; band = ×0.7 / ×1.3."""
    m0 = (start_month if isinstance(start_month, _dt.date)
          else _dt.date.fromisoformat(str(start_month))).replace(day=1)
    clim = monthly.groupBy("series", F.month("month").alias("cal_month")) \
        .agg(F.avg("total").alias("pred"))
    future = clim.select("series").distinct().select(
        "series", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("_k")
    ).select("series", F.add_months(F.lit(m0), F.col("_k")).alias("month"))
    out = future.withColumn("cal_month", F.month("month")).join(clim, ["series", "cal_month"], "left")
    return out.select("series", "month", "pred", (F.col("pred") * band[0]).alias("lower"),
                      (F.col("pred") * band[1]).alias("upper"))


def day_factor(station_col: str = "station", date_col: str = "obs_date", lo: float = 0.7,
               hi: float = 1.3):
    """Deterministic per (station, day) factor in [lo, hi) - a reproducible
    stand-in for the unseeded day noise of the original."""
    h = F.pmod(F.xxhash64(F.col(station_col), F.col(date_col)), F.lit(1_000_000))
    return F.lit(lo) + F.lit(hi - lo) * h / F.lit(1_000_000.0)


def disaggregate(monthly_fc: DataFrame, climatology: DataFrame, mode: str = "share",
                 noise: bool = False, fallback: float = 10.0 / 3.0) -> DataFrame:
    """Monthly forecast total → daily rain per station.

    ``share``: daily total = month total / days in month, split by each station's
    share of the calendar-month climatology (equal shares when it sums to 0).
    ``scale``: each station gets its climatology × (daily target / mean climatology).
    Missing climatology months use ``fallback`` per station. Values floored at 0.
    The climatology table is (stations × 12) rows, joined on (series, month).
    """
    days = monthly_fc.select(
        "series", "month", "pred",
        F.explode(F.sequence(F.col("month"), F.last_day("month"))).alias("obs_date")
    ).withColumns({"cal_month": F.month("month"), "_dim": days_in_month("month")})
    stations = climatology.select("series", "station").distinct()
    months = stations.select("series", "station",
                             F.explode(F.sequence(F.lit(1), F.lit(12))).alias("cal_month"))
    clim = months.join(climatology, ["series", "station", "cal_month"], "left") \
        .withColumn("clim", F.coalesce("clim", F.lit(fallback)))
    w = Window.partitionBy("series", "cal_month")
    clim = clim.withColumns({"_csum": F.sum("clim").over(w), "_cmean": F.avg("clim").over(w),
                             "_cn": F.count(F.lit(1)).over(w)})
    j = days.join(clim, ["series", "cal_month"])
    target = F.col("pred") / F.col("_dim")
    if mode == "share":
        prop = F.when(F.col("_csum") > 0, F.col("clim") / F.col("_csum")).otherwise(1.0 / F.col("_cn"))
        rain = target * prop
    else:
        scale = F.when(F.col("_csum") > 0, target / F.col("_cmean")).otherwise(target)
        rain = F.col("clim") * scale
    if noise:
        rain = rain * day_factor()
    return j.select("series", "obs_date", "station", F.greatest(rain, F.lit(0.0)).alias("rain_mm"))
