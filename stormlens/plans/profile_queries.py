"""Registered queries: profiling and aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlens.operators import profile as P
from stormlens.plans import fixture as fx
from stormlens.plans.registry import register

GRID3 = "station:s obs_date:d rain_mm:f"


@register("a1_describe", fx.sql(body="""
SELECT station, count(rain_mm) AS count, avg(rain_mm) AS mean, stddev_samp(rain_mm) AS std,
       min(rain_mm) AS min, quantile_cont(rain_mm, 0.25) AS p25, quantile_cont(rain_mm, 0.5) AS p50,
       quantile_cont(rain_mm, 0.75) AS p75, max(rain_mm) AS max
FROM grid GROUP BY station"""), "station:s count:i mean:f std:f min:f p25:f p50:f p75:f max:f")
def a1_describe(spark, sf_dir):
    return P.describe_exact(fx.grid(spark, sf_dir), "rain_mm", by="station")


@register("a1_describe_all", fx.sql(body="""
SELECT count(rain_mm) AS count, avg(rain_mm) AS mean, stddev_samp(rain_mm) AS std,
       min(rain_mm) AS min, quantile_cont(rain_mm, 0.25) AS p25, quantile_cont(rain_mm, 0.5) AS p50,
       quantile_cont(rain_mm, 0.75) AS p75, max(rain_mm) AS max FROM readings"""),
          "count:i mean:f std:f min:f p25:f p50:f p75:f max:f")
def a1_describe_all(spark, sf_dir):
    """A1 over the whole raw table (sentinels included, as the first audit does)."""
    return P.describe_exact(fx.readings(spark, sf_dir), "rain_mm")


@register("a2_station_stats", fx.sql(body="""
SELECT name, count(rain_mm) AS n_days, count(DISTINCT year(obs_date)) AS n_years,
       min(rain_mm) AS min, max(rain_mm) AS max, avg(rain_mm) AS mean,
       quantile_cont(rain_mm, 0.5) AS median, stddev_samp(rain_mm) AS std
FROM named_all WHERE rain_mm IS NOT NULL GROUP BY name"""),
          "name:s n_days:i n_years:i min:f max:f mean:f median:f std:f")
def a2_station_stats(spark, sf_dir):
    return P.station_stats(fx.named_all(spark, sf_dir))


@register("a3_annual_means", fx.sql(body="""
SELECT s.name, s.year, a.annual_mean, CAST(a.annual_mean IS NOT NULL AS INT) AS available,
       avg(a.annual_mean) OVER (PARTITION BY s.name) AS mean_of_annual_means
FROM (SELECT DISTINCT name, unnest(generate_series(1995, 2002)) AS year FROM named_all
      WHERE rain_mm IS NOT NULL) s
LEFT JOIN (SELECT name, year(obs_date) AS year, avg(rain_mm) AS annual_mean FROM named_all
           WHERE rain_mm IS NOT NULL GROUP BY 1, 2) a ON a.name = s.name AND a.year = s.year"""),
          "name:s year:i annual_mean:f available:i mean_of_annual_means:f")
def a3_annual_means(spark, sf_dir):
    return P.annual_means(fx.named_all(spark, sf_dir), 1995, 2002)


@register("a4_network_summary", fx.sql("""
per AS (SELECT name, avg(rain_mm) AS m, max(rain_mm) AS mx, min(rain_mm) AS mn FROM named_all
        WHERE rain_mm IS NOT NULL GROUP BY name)""", body="""
SELECT avg(m) AS mean_of_means, max(mx) AS max_of_max, min(mn) AS min_of_min,
       count_if(m > 20) AS n_mean_above, count_if(m < 5) AS n_mean_below FROM per"""),
          "mean_of_means:f max_of_max:f min_of_min:f n_mean_above:i n_mean_below:i")
def a4_network_summary(spark, sf_dir):
    return P.network_summary(fx.named_all(spark, sf_dir))


@register("a5_completeness", fx.sql(body="""
SELECT station_id, name, count(rain_mm) AS n_rows, min(data_timestamp) AS first_ts,
       max(data_timestamp) AS last_ts, count_if(rain_mm IS NULL) AS n_null
FROM region GROUP BY station_id, name"""),
          "station_id:s name:s n_rows:i first_ts:s last_ts:s n_null:i")
def a5_completeness(spark, sf_dir):
    return P.station_completeness(fx.region_readings(spark, sf_dir))


@register("a6_sentinel_counts", fx.sql(body="""
SELECT station_id, name, count_if(rain_mm = 9999) AS count_9999, count_if(rain_mm = 8888) AS count_8888,
       count(*) AS n_rows FROM region GROUP BY station_id, name"""),
          "station_id:s name:s count_9999:i count_8888:i n_rows:i")
def a6_sentinel_counts(spark, sf_dir):
    return P.sentinel_counts(fx.region_readings(spark, sf_dir), by=["station_id", "name"])


@register("a6_sentinel_counts_all", fx.sql(body="""
SELECT count_if(rain_mm = 9999) AS count_9999, count_if(rain_mm = 8888) AS count_8888,
       count(*) AS n_rows FROM readings"""), "count_9999:i count_8888:i n_rows:i")
def a6_sentinel_counts_all(spark, sf_dir):
    return P.sentinel_counts(fx.readings(spark, sf_dir))


@register("a7_trace_values", fx.sql(body="""
SELECT rain_mm, count(*) AS n FROM region WHERE trace = 'Y' AND rain_mm IS NOT NULL GROUP BY rain_mm"""),
          "rain_mm:f n:i")
def a7_trace_values(spark, sf_dir):
    """Value distribution on trace days."""
    return P.conditional_counts(fx.region_readings(spark, sf_dir), F.col("trace") == "Y", "rain_mm")


@register("a7_sentinel_trace", fx.sql(body="""
SELECT trace, count(*) AS n FROM region WHERE rain_mm = 8888 AND trace IS NOT NULL GROUP BY trace"""),
          "trace:s n:i")
def a7_sentinel_trace(spark, sf_dir):
    """Trace flag distribution on 8888 rows."""
    return P.conditional_counts(fx.region_readings(spark, sf_dir), F.col("rain_mm") == 8888, "trace")


@register("a8_value_counts", fx.sql(body="""
SELECT station_id, name, count(*) AS n FROM readings WHERE name IS NOT NULL GROUP BY station_id, name"""),
          "station_id:s name:s n:i")
def a8_value_counts(spark, sf_dir):
    return P.value_counts(fx.readings(spark, sf_dir), "name", by="station_id")


@register("a9_null_profile", fx.sql(body="""
SELECT station, count_if(rain_mm IS NULL) AS n_null, count(*) AS n_days,
       count_if(rain_mm IS NULL) * 100.0 / count(*) AS pct_null FROM grid GROUP BY station"""),
          "station:s n_null:i n_days:i pct_null:f")
def a9_null_profile(spark, sf_dir):
    return P.null_profile(fx.grid(spark, sf_dir))


@register("a10_null_by_year", fx.sql(body=f"""
SELECT year(obs_date) AS year,
       {", ".join(f"count_if(station = '{s}' AND rain_mm IS NULL) AS \"{s}\"" for s in fx.STATIONS)}
FROM grid GROUP BY 1"""), "year:i " + " ".join(f"{s}:i" for s in fx.STATIONS))
def a10_null_by_year(spark, sf_dir):
    return P.null_by_year(fx.grid(spark, sf_dir), stations=fx.STATIONS)


@register("a11_null_gate", fx.sql(body="""
SELECT station, count_if(rain_mm IS NULL) AS n_null, count(*) AS n_days,
       count_if(rain_mm IS NULL) * 100.0 / count(*) AS pct_null,
       CASE WHEN count_if(rain_mm IS NULL) * 100.0 / count(*) < 45 THEN 'OK' ELSE 'TOO_HIGH' END AS status
FROM grid GROUP BY station"""), "station:s n_null:i n_days:i pct_null:f status:s")
def a11_null_gate(spark, sf_dir):
    return P.null_gate(fx.grid(spark, sf_dir), limit=45.0)


@register("a12_coverage", fx.sql(body="""
SELECT station, count(DISTINCT obs_date) AS n_dates,
       count(DISTINCT CASE WHEN rain_mm IS NOT NULL THEN obs_date END) AS n_valid_dates,
       any_value(n) - count(DISTINCT obs_date) AS n_absent,
       (any_value(n) - count(DISTINCT CASE WHEN rain_mm IS NOT NULL THEN obs_date END)) * 100.0 / any_value(n) AS pct_missing
FROM cleaned, (SELECT count(*) AS n FROM days) t GROUP BY station"""),
          "station:s n_dates:i n_valid_dates:i n_absent:i pct_missing:f")
def a12_coverage(spark, sf_dir):
    lo, hi = fx.bounds(spark, sf_dir)
    return P.coverage(fx.cleaned(spark, sf_dir), (hi - lo).days + 1)


@register("a13_zero_null_counts", fx.sql(body="""
SELECT station, count_if(rain_mm = 0) AS n_zero, count_if(rain_mm IS NULL) AS n_null
FROM cleaned GROUP BY station"""), "station:s n_zero:i n_null:i")
def a13_zero_null_counts(spark, sf_dir):
    return P.zero_null_counts(fx.cleaned(spark, sf_dir))


GAPS_SQL = """
nl AS (SELECT station, obs_date,
              obs_date - CAST(row_number() OVER (PARTITION BY station ORDER BY obs_date) AS INT) AS isl
       FROM grid WHERE rain_mm IS NULL),
eps AS (SELECT station, min(obs_date) AS gap_start, max(obs_date) AS gap_end, count(*) AS gap_len
        FROM nl GROUP BY station, isl)"""


@register("a14_gap_episodes", fx.sql(GAPS_SQL, body="SELECT * FROM eps"),
          "station:s gap_start:d gap_end:d gap_len:i")
def a14_gap_episodes(spark, sf_dir):
    return P.gap_episodes(fx.grid(spark, sf_dir))


@register("a14_gap_summary", fx.sql(GAPS_SQL, body="""
SELECT station, count(*) AS n_gaps, max(gap_len) AS longest_gap,
       list(gap_len ORDER BY gap_len DESC, gap_start)[1:5] AS top_gaps FROM eps GROUP BY station"""),
          "station:s n_gaps:i longest_gap:i top_gaps:a")
def a14_gap_summary(spark, sf_dir):
    return P.gap_summary(fx.grid(spark, sf_dir))


def _intervals(spark, sf_dir):
    from stormlens.operators.intervals import to_intervals
    return to_intervals(*fx.grid_input(spark, sf_dir))


@register("a14_gaps_of_intervals", fx.sql(GAPS_SQL, body="SELECT * FROM eps"), "station:s gap_start:d gap_end:d gap_len:i")
def a14_gaps_of_intervals(spark, sf_dir):
    """A14 on the interval-coded panel: gaps are its rows without a value."""
    from stormlens.operators import intervals as IV
    return IV.gaps(_intervals(spark, sf_dir))


@register("a14_gap_summary_of_intervals", fx.sql(GAPS_SQL, body="""
SELECT station, count(*) AS n_gaps, max(gap_len) AS longest_gap,
       list(gap_len ORDER BY gap_len DESC, gap_start)[1:5] AS top_gaps FROM eps GROUP BY station"""),
          "station:s n_gaps:i longest_gap:i top_gaps:a")
def a14_gap_summary_of_intervals(spark, sf_dir):
    from stormlens.operators import intervals as IV
    return IV.gap_summary(_intervals(spark, sf_dir))


@register("j3_days_of_intervals", fx.sql(body="SELECT * FROM grid"), "station:s obs_date:d rain_mm:f")
def j3_days_of_intervals(spark, sf_dir):
    """J3 from the interval-coded panel: days exist at output only."""
    from stormlens.operators import intervals as IV
    return IV.days(_intervals(spark, sf_dir))


@register("a22_distinct_counts", fx.sql(body="""
SELECT count(DISTINCT station) AS n_distinct_station, count(DISTINCT obs_date) AS n_distinct_obs_date
FROM cleaned"""), "n_distinct_station:i n_distinct_obs_date:i")
def a22_distinct_counts(spark, sf_dir):
    return P.distinct_counts(fx.cleaned(spark, sf_dir), ["station", "obs_date"])


@register("a23_p95", fx.sql(body="""
SELECT a.station, a.threshold, w.threshold_wet FROM
 (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold FROM grid WHERE rain_mm IS NOT NULL
  GROUP BY station) a
 JOIN (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold_wet FROM grid WHERE rain_mm > 0
  GROUP BY station) w USING (station)"""), "station:s threshold:f threshold_wet:f")
def a23_p95(spark, sf_dir):
    v = F.col("rain_mm")
    return fx.grid(spark, sf_dir).groupBy("station").agg(
        F.percentile(v, 0.95).alias("threshold"), F.percentile(F.when(v > 0, v), 0.95).alias("threshold_wet"))


_PROFILE_COLS = (("rid", "bigint"), ("station_id", "string"), ("name", "string"),
                 ("data_timestamp", "string"), ("rain_mm", "double"), ("trace", "string"))


@register("a24_profile", fx.sql(
    "c AS (SELECT count(*) AS n_rows, "
    + ", ".join(f"count_if({c} IS NULL) AS z_{c}" for c, _ in _PROFILE_COLS) + " FROM readings)",
    body="SELECT t.column_name, t.dtype, CASE t.column_name "
    + " ".join(f"WHEN '{c}' THEN z_{c}" for c, _ in _PROFILE_COLS)
    + " END AS n_null, c.n_rows FROM (VALUES "
    + ", ".join(f"('{c}', '{d}')" for c, d in _PROFILE_COLS)
    + ") AS t(column_name, dtype) CROSS JOIN c"),
    "column_name:s dtype:s n_null:i n_rows:i")
def a24_profile(spark, sf_dir):
    return P.profile(fx.readings(spark, sf_dir))


@register("a25_date_bounds", fx.sql(body="""
SELECT min(obs_date) AS first_date, max(obs_date) AS last_date, count(DISTINCT obs_date) AS n_dates
FROM grid WHERE rain_mm IS NOT NULL"""), "first_date:d last_date:d n_dates:i")
def a25_date_bounds(spark, sf_dir):
    return P.date_bounds(fx.grid(spark, sf_dir).filter(F.col("rain_mm").isNotNull()))


@register("a25_clamp_date", fx.sql(body="""
SELECT least(greatest(DATE '2003-01-01', min(obs_date)), max(obs_date)) AS clamped_late,
       least(greatest(DATE '1990-01-01', min(obs_date)), max(obs_date)) AS clamped_early
FROM grid WHERE rain_mm IS NOT NULL"""), "clamped_late:d clamped_early:d")
def a25_clamp_date(spark, sf_dir):
    b = P.date_bounds(fx.grid(spark, sf_dir).filter(F.col("rain_mm").isNotNull()))
    return b.select(P.clamp_date("2003-01-01", F.col("first_date"), F.col("last_date")).alias("clamped_late"),
                    P.clamp_date("1990-01-01", F.col("first_date"), F.col("last_date")).alias("clamped_early"))


@register("o1_top_values", fx.sql(body="""
SELECT station_id, data_timestamp, rain_mm FROM readings WHERE rain_mm IS NOT NULL
ORDER BY rain_mm DESC, station_id, data_timestamp LIMIT 20"""),
          "station_id:s data_timestamp:s rain_mm:f")
def o1_top_values(spark, sf_dir):
    return P.top_values(fx.readings(spark, sf_dir), "rain_mm", 20).select("station_id", "data_timestamp", "rain_mm")


@register("o2_top_stations", fx.sql(body="""
SELECT name, avg(rain_mm) AS mean FROM named_all WHERE rain_mm IS NOT NULL GROUP BY name
ORDER BY mean DESC, name LIMIT 10"""), "name:s mean:f")
def o2_top_stations(spark, sf_dir):
    return P.top_stations(fx.named_all(spark, sf_dir), 10)


@register("o4_preview_tail", fx.sql(body="""
SELECT * FROM grid ORDER BY obs_date DESC, station DESC LIMIT 7"""), GRID3)
def o4_preview_tail(spark, sf_dir):
    return P.preview(fx.grid(spark, sf_dir), 7, ["obs_date", "station"], ascending=False)
