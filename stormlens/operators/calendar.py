"""Calendars and dense grids (J3, J8 spines, X12).

The positional ``shift``/``rolling`` semantics of the studied code are only right on a
dense daily calendar, so every station gets exactly one row per day in the study
range. That also bounds every station's window partition by the length of the
calendar, whatever the raw volume (raw skew is absorbed by the partial aggregate in
``daily_mean``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlens.operators.clean import daily_mean

SPINE_CHUNK_DAYS = 366


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def date_spine(stations: DataFrame, start, end, station_col: str = "station",
               chunk_days: int = SPINE_CHUNK_DAYS) -> DataFrame:
    """One row per (station, day) in [start, end].

    Generated in two steps - (station, chunk) rows first, redistributed, then each
    chunk exploded into its days - so that a long calendar over many stations is
    produced by many tasks, not by the one task holding the distinct station list.
    """
    s, e = _as_date(start), _as_date(end)
    n_days = (e - s).days + 1
    n_chunks = max(1, -(-n_days // chunk_days))
    first = F.date_add(F.lit(s), F.col("_chunk") * F.lit(chunk_days))
    last = F.least(F.date_add(first, chunk_days - 1), F.lit(e))
    chunks = (stations.select(F.col(station_col).alias(station_col))
              .select(station_col, F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("_chunk"))
              .repartition(station_col, "_chunk"))
    return chunks.select(station_col, F.explode(F.sequence(first, last)).alias("obs_date"))


def densify(station_days: DataFrame, start, end, stations: DataFrame | None = None,
            value_col: str = "rain_mm", aggregate: bool = True) -> DataFrame:
    """J3 (+I3): dense (station, obs_date) grid over [start, end], duplicates averaged.

    Plan: one scan. Partial + final hash aggregate of the readings on (station, obs_date);
    then every station-day stands for the days up to the station's next one (the first also
    for those before it), cut to the range and exploded; days without a reading carry
    NULL. A station with readings only outside the range keeps its (empty) days. With a
    given ``stations`` frame its calendar is generated and left-joined instead.
    """
    s, e = _as_date(start), _as_date(end)
    if stations is not None:
        rows = station_days.filter(F.col("obs_date").between(F.lit(s), F.lit(e)))
        daily = daily_mean(rows, value_col=value_col) if aggregate else rows
        return date_spine(stations, s, e).join(daily, on=["station", "obs_date"], how="left")
    # a station known only from undated rows keeps its place: a day before the range stands for them
    rows = station_days.withColumn("obs_date", F.coalesce("obs_date", F.lit(s - _dt.timedelta(days=1))))
    daily = daily_mean(rows, value_col=value_col) if aggregate else rows
    w = Window.partitionBy("station").orderBy("obs_date")
    first = F.when(F.lag("obs_date").over(w).isNull(), F.least(F.lit(s), F.col("obs_date"))).otherwise(F.col("obs_date"))
    last = F.coalesce(F.date_sub(F.lead("obs_date").over(w), 1), F.lit(e))
    spans = daily.withColumns({"_from": F.greatest(first, F.lit(s)), "_to": F.least(last, F.lit(e))}) \
        .filter(F.col("_from") <= F.col("_to"))
    days = spans.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    others = [c for c in daily.columns if c not in ("station", "obs_date")]
    return days.select("station", F.col("_day").alias("obs_date"),
                       *[F.when(F.col("_day") == F.col("obs_date"), F.col(c)).alias(c) for c in others])


def month_spine(series: DataFrame, start_month, n_months: int, key_col: str) -> DataFrame:
    """(key, month) rows for ``n_months`` months from ``start_month`` (first of month)."""
    m0 = _as_date(start_month).replace(day=1)
    return series.select(key_col).distinct().select(
        key_col, F.explode(F.sequence(F.lit(0), F.lit(n_months - 1))).alias("_k")
    ).select(key_col, F.add_months(F.lit(m0), F.col("_k")).alias("month"))


def year_spine(keys: DataFrame, y0: int, y1: int, key_col: str) -> DataFrame:
    """(key, year) rows for every year in [y0, y1]."""
    return keys.select(key_col).distinct().select(
        key_col, F.explode(F.sequence(F.lit(y0), F.lit(y1))).alias("year"))
