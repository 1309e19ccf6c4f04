"""The daily panel coded as intervals (J3, A14, W5, W6 without the calendar's rows).

An interval is (station, first, last, value): a run of days with the same value, or without one. A station of r
readings in the range has at most 2r + 1 intervals, however long the calendar is, so a table of them,
and every shuffle and window over them, follows the readings and not the days. Gaps are the
intervals without a value; run lengths need one running maximum over intervals; days are only
exploded at output (``days``), where each gets its run length by arithmetic.

Defined results: readings of one station and day are averaged, a mean of nothing is no value; adjacent
intervals of equal value (no value included) are one; a station with readings only outside the
range, or without a date, is one interval without a value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlens.operators.calendar import _as_date
from stormlens.operators.clean import daily_mean


def to_intervals(station_days: DataFrame, start, end, value_col: str = "rain_mm") -> DataFrame:
    """(station, first, last, value) over [start, end]."""
    s, e = _as_date(start), _as_date(end)
    day = F.lit(s - dt.timedelta(days=1))
    # readings outside the range keep their station: they stand on the day before it, without a value
    inside = F.coalesce(F.col("obs_date").between(F.lit(s), F.lit(e)), F.lit(False))
    rows = station_days.select("station", F.when(inside, F.col("obs_date")).otherwise(day).alias("obs_date"), F.when(inside, F.col(value_col)).alias(value_col))
    daily = daily_mean(rows, value_col=value_col)
    w = Window.partitionBy("station").orderBy("obs_date")
    following = F.coalesce(F.date_sub(F.lead("obs_date").over(w), 1), F.lit(e))
    opening = F.when(F.lag("obs_date").over(w).isNull() & (F.col("obs_date") > F.lit(s)), F.struct(F.lit(s).alias("first"), F.date_sub("obs_date", 1).alias("last"), F.lit(None).cast("double").alias("value")))
    own = F.when(F.col("obs_date") >= F.lit(s), F.struct(F.col("obs_date").alias("first"), F.col("obs_date").alias("last"), F.col(value_col).cast("double").alias("value")))
    after = F.when(following > F.col("obs_date"), F.struct(F.date_add("obs_date", 1).alias("first"), following.alias("last"), F.lit(None).cast("double").alias("value")))
    pieces = daily.withColumn("_p", F.array_compact(F.array(opening, own, after))).select("station", F.inline("_p"))
    order = Window.partitionBy("station").orderBy("first")
    new = ~F.lag("value").over(order).eqNullSafe(F.col("value")) | F.lag("first").over(order).isNull()
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = pieces.withColumn("_new", new.cast("int")).withColumn("_island", island)
    return runs.groupBy("station", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.first("value").alias("value")).drop("_island")


def days(intervals: DataFrame, value_col: str = "rain_mm") -> DataFrame:
    """The dense panel (station, obs_date, value) of intervals."""
    return intervals.select("station", F.explode(F.sequence("first", "last")).alias("obs_date"), F.col("value").alias(value_col))


def gaps(intervals: DataFrame) -> DataFrame:
    """(station, gap_start, gap_end, gap_len)."""
    return intervals.filter("value is null").select("station", F.col("first").alias("gap_start"), F.col("last").alias("gap_end"), (F.datediff("last", "first") + 1).cast("long").alias("gap_len"))


def gap_summary(intervals: DataFrame, top: int = 5) -> DataFrame:
    """Number of gaps, the longest, and the ``top`` longest lengths of each station."""
    eps = gaps(intervals)
    place = F.row_number().over(Window.partitionBy("station").orderBy(F.desc("gap_len"), "gap_start"))
    first = eps.withColumn("_place", place).filter(F.col("_place") <= top).groupBy("station").agg(F.sort_array(F.collect_list("gap_len"), asc=False).alias("top_gaps"))
    return eps.groupBy("station").agg(F.count("*").alias("n_gaps"), F.max("gap_len").alias("longest_gap")).join(first, "station")


def with_runs(intervals: DataFrame, out: str, breaks: Column, first_null: bool) -> DataFrame:
    """``intervals`` with the struct ``out``: what ``days_with_run`` needs to tell each day's run of days
    before it on which ``breaks`` (a condition on ``value``) did not hold."""
    order = Window.partitionBy("station").orderBy("first")
    before = F.max(F.when(F.col("_breaks"), F.col("last"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begin = F.min("first").over(Window.partitionBy("station"))
    run = intervals.withColumn("_breaks", F.coalesce(breaks, F.lit(False))).withColumn("_begin", begin) \
        .withColumn("_since", F.coalesce(before, F.date_sub("_begin", 1)))
    return run.withColumn(out, F.struct("_breaks", "_since", "_begin", F.lit(first_null).alias("_first_null"))).drop("_breaks", "_since", "_begin")


def days_with_run(intervals: DataFrame, out: str, value_col: str = "rain_mm") -> DataFrame:
    """The dense panel with the run length ``out`` of ``with_runs``."""
    each = intervals.select("station", "first", "value", F.col(out).alias("_r"), F.explode(F.sequence("first", "last")).alias("obs_date"))
    run = F.when(F.col("_r._breaks") & (F.col("obs_date") > F.col("first")), 0).otherwise(F.datediff("obs_date", "_r._since") - 1)
    return each.select("station", "obs_date", F.col("value").alias(value_col),
                       F.when(~F.col("_r._first_null") | (F.col("obs_date") > F.col("_r._begin")), run).alias(out))
