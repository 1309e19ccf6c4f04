"""Profiling and aggregation operators.

Everything is a grouped hash aggregate (partial per task, final after one
shuffle on the group key). Exact quantiles of raw rows come from sketches and one
counting pass (``quantiles``); A23, over one station's calendar days, uses ``percentile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlens.operators.clean import NULL_CODES, ZERO_CODES
from stormlens.operators.quantiles import quantiles_by


def _by(by):
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def describe_exact(df: DataFrame, col: str, by=None) -> DataFrame:
    """A1: count, mean, sample std, min, exact linear quartiles, max."""
    c = F.col(col)
    g = quantiles_by(df, _by(by), c, (0.25, 0.5, 0.75), F.count(c).alias("count"), F.avg(c).alias("mean"),
                     F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    return g.select(*_by(by), "count", "mean", "std", "min",
                    F.get("q", F.lit(0)).alias("p25"), F.get("q", F.lit(1)).alias("p50"),
                    F.get("q", F.lit(2)).alias("p75"), "max")


def station_stats(df: DataFrame, by: str = "name", value_col: str = "rain_mm",
                  ts_col: str = "obs_date") -> DataFrame:
    """A2: per station - days with data, years with data, min, max, mean, median, std."""
    v = F.col(value_col)
    g = quantiles_by(df.filter(v.isNotNull()), [by], v, (0.5,),
                     F.count(v).alias("n_days"), F.count_distinct(F.year(ts_col)).alias("n_years"),
                     F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    return g.select(by, "n_days", "n_years", "min", "max", "mean", F.get("q", F.lit(0)).alias("median"), "std")


def annual_means(df: DataFrame, y0: int, y1: int, by: str = "name",
                 value_col: str = "rain_mm", ts_col: str = "obs_date") -> DataFrame:
    """A3 + J8: mean per station per year for every year in [y0, y1] (NULL =
    "not available"), and the mean of the available annual means per station."""
    v = F.col(value_col)
    annual = (df.filter(v.isNotNull()).withColumn("year", F.year(ts_col))
              .groupBy(by, "year").agg(F.avg(v).alias("annual_mean")))
    spine = annual.select(by).distinct().select(
        by, F.explode(F.sequence(F.lit(y0), F.lit(y1))).alias("year"))
    out = spine.join(annual, on=[by, "year"], how="left")
    w = Window.partitionBy(by)
    return out.withColumns({
        "available": F.col("annual_mean").isNotNull().cast("int"),
        "mean_of_annual_means": F.avg(F.when(F.col("year").between(y0, y1),
                                             F.col("annual_mean"))).over(w)})


def network_summary(df: DataFrame, by: str = "name", value_col: str = "rain_mm",
                    high: float = 20.0, low: float = 5.0) -> DataFrame:
    """A4: over station means - mean of means, max of maxima, min of minima, number
    of stations with mean > 20 and mean < 5. Two aggregation levels (the mean of
    station means is not the overall mean)."""
    v = F.col(value_col)
    per = df.filter(v.isNotNull()).groupBy(by).agg(
        F.avg(v).alias("m"), F.max(v).alias("mx"), F.min(v).alias("mn"))
    return per.agg(F.avg("m").alias("mean_of_means"), F.max("mx").alias("max_of_max"),
                   F.min("mn").alias("min_of_min"),
                   F.count_if(F.col("m") > high).alias("n_mean_above"),
                   F.count_if(F.col("m") < low).alias("n_mean_below"))


def top_stations(df: DataFrame, n: int = 10, by: str = "name", value_col: str = "rain_mm") -> DataFrame:
    """O2: the n stations with the highest mean (ties by name)."""
    per = df.filter(F.col(value_col).isNotNull()).groupBy(by).agg(F.avg(value_col).alias("mean"))
    return per.orderBy(F.desc("mean"), F.asc(by)).limit(n)


def station_completeness(df: DataFrame, keys=("station_id", "name"), value_col: str = "rain_mm",
                         ts_col: str = "data_timestamp") -> DataFrame:
    """A5: non-null count, first/last timestamp (text min/max), null count."""
    v = F.col(value_col)
    return df.groupBy(*keys).agg(
        F.count(v).alias("n_rows"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"),
        F.count_if(v.isNull()).alias("n_null"))


def sentinel_counts(df: DataFrame, by=None, value_col: str = "rain_mm",
                    codes=NULL_CODES + ZERO_CODES) -> DataFrame:
    """Occurrences of each sentinel code (and row total), overall or per group."""
    v = F.col(value_col)
    aggs = [F.count_if(v == F.lit(c)).alias(f"count_{int(c)}") for c in codes]
    return df.groupBy(*_by(by)).agg(*aggs, F.count(F.lit(1)).alias("n_rows"))


def conditional_counts(df: DataFrame, cond: Column, col: str) -> DataFrame:
    """Frequency of ``col`` among rows meeting ``cond``."""
    return value_counts(df.filter(cond), col)


def value_counts(df: DataFrame, col: str, by=None) -> DataFrame:
    """Frequency table (NULL excluded), most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(*_by(by), col)
            .agg(F.count(F.lit(1)).alias("n")))


def null_profile(panel: DataFrame, value_col: str = "rain_mm") -> DataFrame:
    """Null count and percentage per station."""
    v = F.col(value_col)
    return panel.groupBy("station").agg(
        F.count_if(v.isNull()).alias("n_null"), F.count(F.lit(1)).alias("n_days")
    ).withColumn("pct_null", F.col("n_null") * 100.0 / F.col("n_days"))


def null_by_year(panel: DataFrame, value_col: str = "rain_mm", stations=None) -> DataFrame:
    """A10: null count per (year, station); wide when a station list is given."""
    g = panel.withColumn("year", F.year("obs_date"))
    if stations is not None:
        return g.groupBy("year").pivot("station", list(stations)).agg(
            F.count_if(F.col(value_col).isNull()))
    return g.groupBy("year", "station").agg(F.count_if(F.col(value_col).isNull()).alias("n_null"))


def null_gate(panel: DataFrame, limit: float = 30.0, value_col: str = "rain_mm") -> DataFrame:
    """Null share per station and an OK / too-high flag (limit in %)."""
    prof = null_profile(panel, value_col)
    return prof.withColumn("status", F.when(F.col("pct_null") < limit, "OK").otherwise("TOO_HIGH"))


def coverage(station_days: DataFrame, expected_days: int, value_col: str = "rain_mm") -> DataFrame:
    """Missing % against the full expected calendar (absent days + null days)."""
    per = station_days.groupBy("station").agg(
        F.count_distinct("obs_date").alias("n_dates"),
        F.count_distinct(F.when(F.col(value_col).isNotNull(), F.col("obs_date"))).alias("n_valid_dates"))
    return per.withColumns({
        "n_absent": F.lit(expected_days) - F.col("n_dates"),
        "pct_missing": (F.lit(expected_days) - F.col("n_valid_dates")) * 100.0 / F.lit(expected_days)})


def zero_null_counts(df: DataFrame, by: str = "station", value_col: str = "rain_mm") -> DataFrame:
    """A13."""
    v = F.col(value_col)
    return df.groupBy(by).agg(F.count_if(v == 0).alias("n_zero"), F.count_if(v.isNull()).alias("n_null"))


def gap_episodes(panel: DataFrame, value_col: str = "rain_mm") -> DataFrame:
    """Runs of consecutive missing days per station (dense grid).

    Only the NULL rows are windowed; on a dense calendar consecutive missing days
    share ``obs_date − row_number`` (gaps and islands)."""
    nulls = panel.filter(F.col(value_col).isNull()).select("station", "obs_date")
    rn = F.row_number().over(Window.partitionBy("station").orderBy("obs_date"))
    isl = nulls.withColumn("_island", F.date_sub(F.col("obs_date"), rn))
    return isl.groupBy("station", "_island").agg(
        F.min("obs_date").alias("gap_start"), F.max("obs_date").alias("gap_end"),
        F.count(F.lit(1)).alias("gap_len")).drop("_island")


def gap_summary(panel: DataFrame, value_col: str = "rain_mm", top: int = 5) -> DataFrame:
    """Number of gaps, longest, and the ``top`` longest lengths (descending).

    The top-k is a ``row_number <= k`` filter (planned as a WindowGroupLimit), so
    the collected list never holds more than ``top`` items per station."""
    eps = gap_episodes(panel, value_col)
    stats = eps.groupBy("station").agg(F.count(F.lit(1)).alias("n_gaps"),
                                       F.max("gap_len").alias("longest_gap"))
    rk = F.row_number().over(Window.partitionBy("station").orderBy(F.desc("gap_len"), "gap_start"))
    topk = (eps.withColumn("_rk", rk).filter(F.col("_rk") <= top)
            .groupBy("station").agg(F.sort_array(F.collect_list("gap_len"), asc=False).alias("top_gaps")))
    return stats.join(topk, on="station")


def class_balance(df: DataFrame, label: str = "label", by=None) -> DataFrame:
    """Rows, positives, positive %, imbalance ratio 1:(100−p)/p (NULL when p=0)."""
    g = df.groupBy(*_by(by)).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.sum(F.col(label)).alias("n_pos"))
    pct = F.col("n_pos") * 100.0 / F.col("n_rows")
    return g.withColumns({"pct_pos": pct,
                          "imbalance_ratio": F.when(pct > 0, (F.lit(100.0) - pct) / pct)})


def distinct_counts(df: DataFrame, cols) -> DataFrame:
    """Exact distinct count of each column."""
    return df.agg(*[F.count_distinct(c).alias(f"n_distinct_{c}") for c in cols])


def station_quantile(panel: DataFrame, q: float = 0.95, rain_only: bool = False,
                     value_col: str = "rain_mm", out: str = "threshold") -> DataFrame:
    """Exact per-station quantile with linear interpolation (pandas ``quantile``).

    ``rain_only`` restricts to days with value > 0."""
    v = F.col(value_col)
    rows = panel.filter(v > 0) if rain_only else panel.filter(v.isNotNull())
    return rows.groupBy("station").agg(F.percentile(v, q).alias(out))


def profile(df: DataFrame) -> DataFrame:
    """One-pass table profile - total rows and NULL count per column - as long
    rows (column, dtype, n_rows, n_null)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_z{i}")
                                                for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{df.schema[c].dataType.simpleString()}', _z{i}"
                      for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, dtype, n_null)",
                           "_n as n_rows")


def date_bounds(df: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """First and last date and number of distinct dates."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                  F.count_distinct(date_col).alias("n_dates"))


def clamp_date(date, lo: Column, hi: Column) -> Column:
    """Requested date clamped into [lo, hi]."""
    return F.least(F.greatest(F.lit(date).cast("date"), lo), hi)


def top_values(df: DataFrame, col: str, n: int = 20, tie_cols=("station_id", "data_timestamp")) -> DataFrame:
    """O1: the n largest values with their context, deterministic ties.
    Planned as ``TakeOrderedAndProject``: each task keeps its own top n, the driver
    merges n × tasks rows."""
    return df.filter(F.col(col).isNotNull()).orderBy(F.desc(col), *[F.asc(c) for c in tie_cols]).limit(n)


def preview(df: DataFrame, n: int, order, ascending: bool = True) -> DataFrame:
    """Ordered head (or tail with ``ascending=False``); never ``tail()``."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [F.asc(c) if ascending else F.desc(c) for c in order]
    return df.orderBy(*cols).limit(n)
