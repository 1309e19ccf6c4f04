"""Registered queries: calendar, window features, neighbours, reshape
(X1, X2, W1-W9, W11, J5, J6, U3-U5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlens.functions.calendar import add_calendar
from stormlens.operators import clean as C
from stormlens.operators import features as FE
from stormlens.plans import fixture as fx
from stormlens.plans.registry import ORACLES, register

W = "WINDOW w AS (PARTITION BY station ORDER BY obs_date)"
SEASON_SQL = """CASE WHEN month(obs_date) IN (12, 1, 2, 3) THEN 'Hujan_Intensif'
     WHEN month(obs_date) IN (4, 5) THEN 'Peralihan_1'
     WHEN month(obs_date) IN (6, 7, 8, 9) THEN 'Kemarau' ELSE 'Peralihan_2' END"""


@register("x1_calendar", fx.sql(body=f"""
SELECT station, obs_date, month(obs_date) AS bulan, dayofyear(obs_date) AS hari_tahun,
       isodow(obs_date) - 1 AS hari_minggu, year(obs_date) AS tahun, {SEASON_SQL} AS musim
FROM grid"""), "station:s obs_date:d bulan:i hari_tahun:i hari_minggu:i tahun:i musim:s")
def x1_calendar(spark, sf_dir):
    return add_calendar(fx.grid(spark, sf_dir)).drop("rain_mm")


@register("x2_season_counts", fx.sql(body=f"""
SELECT {SEASON_SQL} AS musim, count(*) AS n_days, avg(rain_mm) AS mean_rain FROM grid GROUP BY 1"""),
          "musim:s n_days:i mean_rain:f")
def x2_season_counts(spark, sf_dir):
    """Days and mean rain per season."""
    return add_calendar(fx.grid(spark, sf_dir)).groupBy("musim").agg(
        F.count(F.lit(1)).alias("n_days"), F.avg("rain_mm").alias("mean_rain"))


@register("w1_lags", fx.sql(body=f"""
SELECT station, obs_date, rain_mm, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2,
       lag(rain_mm, 3) OVER w AS lag3 FROM grid {W}"""),
          "station:s obs_date:d rain_mm:f lag1:f lag2:f lag3:f")
def w1_lags(spark, sf_dir):
    return FE.add_lags(fx.grid(spark, sf_dir), (1, 2, 3))


def bucketed_grid(spark, sf_dir):
    """The dense panel as a bucketed table in the shared folder."""
    import os
    import uuid

    from stormlens.session import ensure_checkpoint_dir
    from stormlens.sources.readings import write_bucketed
    name = f"panel_{uuid.uuid4().hex}"
    return write_bucketed(fx.grid(spark, sf_dir), name, os.path.join(ensure_checkpoint_dir(spark), name))


@register("s3_bucketed_lags")
def s3_bucketed_lags(spark, sf_dir):
    """S3: lags over the station-bucketed panel, read without an exchange (same oracle as W1)."""
    return FE.add_lags(bucketed_grid(spark, sf_dir), (1, 2, 3))


@register("w2_rolling", fx.sql(body=f"""
SELECT station, obs_date, rain_mm,
       avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
       avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30,
       avg(rain_mm) OVER (w ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING) AS roll365 FROM grid {W}"""),
          "station:s obs_date:d rain_mm:f roll7:f roll30:f roll365:f")
def w2_rolling(spark, sf_dir):
    return FE.add_rolling(fx.grid(spark, sf_dir), (7, 30, 365))


@register("w2_rolling_chunked")
def w2_rolling_chunked(spark, sf_dir):
    """W2 on (station, 2-year chunk) partitions with a 365-day halo - identical
    result to the per-station windows (same oracle)."""
    return FE.chunked(fx.grid(spark, sf_dir), lambda p: FE.add_rolling(p, (7, 30, 365)), halo=365,
                      chunk_days=730)


@register("w3_max3", fx.sql(body=f"""
SELECT station, obs_date, rain_mm, max(rain_mm) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS max3
FROM grid {W}"""), "station:s obs_date:d rain_mm:f max3:f")
def w3_max3(spark, sf_dir):
    return FE.add_rolling(fx.grid(spark, sf_dir), (3,), "max")


@register("w3_year_extremes", fx.sql(body=f"""
SELECT station, obs_date, max(rain_mm) OVER (w ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING) AS max365, min(rain_mm) OVER (w ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING) AS min365,
       sum(rain_mm) OVER (w ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING) AS sum365 FROM grid {W}"""),
          "station:s obs_date:d max365:f min365:f sum365:f")
def w3_year_extremes(spark, sf_dir):
    """W3 over a year: largest and least value and total of the previous 365 days, in linear time."""
    p = FE.add_rolling(FE.add_rolling(fx.grid(spark, sf_dir), (365,), "max"), (365,), "min")
    return FE.add_rolling(p, (365,), "sum").select("station", "obs_date", "max365", "min365", "sum365")


@register("w4_trend", fx.sql(body=f"""
SELECT station, obs_date, lag(rain_mm, 1) OVER w - lag(rain_mm, 2) OVER w AS trend FROM grid {W}"""),
          "station:s obs_date:d trend:f")
def w4_trend(spark, sf_dir):
    return FE.add_trend(FE.add_lags(fx.grid(spark, sf_dir), (1, 2))).select("station", "obs_date", "trend")


def _run_sql(break_cond: str, out: str, first_null: bool) -> str:
    # Oracle formulation by dates (independent of the engine's positional one):
    # days since the last breaking day before today, or since the calendar start.
    first = f"CASE WHEN obs_date = min(obs_date) OVER (PARTITION BY station) THEN NULL ELSE {{}} END" \
        if first_null else "{}"
    run = ("CAST(obs_date - coalesce(last_break, CAST(min(obs_date) OVER (PARTITION BY station) "
           "- INTERVAL 1 DAY AS DATE)) AS BIGINT) - 1")
    return fx.sql(f"""
rb AS (SELECT station, obs_date, rain_mm,
              max(CASE WHEN {break_cond} THEN obs_date END)
                OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_break
       FROM grid {W})""", body=f"SELECT station, obs_date, rain_mm, {first.format(run)} AS {out} FROM rb")


@register("w5_wet_run", _run_sql("NOT coalesce(rain_mm > 0, false)", "consec_rain", False),
          "station:s obs_date:d rain_mm:f consec_rain:i")
def w5_wet_run(spark, sf_dir):
    return FE.add_wet_run(fx.grid(spark, sf_dir))


@register("w6_dry_run", _run_sql("coalesce(rain_mm > 0.1, false)", "dry_days", True),
          "station:s obs_date:d rain_mm:f dry_days:i")
def w6_dry_run(spark, sf_dir):
    return FE.add_dry_run(fx.grid(spark, sf_dir))


FEAT_SQL = f"""
f AS (SELECT station, obs_date, rain_mm, lag(rain_mm, 1) OVER w AS lag1,
             avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
             max(rain_mm) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS max3
      FROM grid {W})"""
NBR_SPEC = "station:s obs_date:d lag1:f roll7:f nbr_lag1_avg:f nbr_roll7_avg:f"


def _nbr_sql(members, targets) -> str:
    mem = "" if members is None else f" AND b.station IN {fx.in_list(members)}"
    tgt = "" if targets is None else f" WHERE a.station IN {fx.in_list(targets)}"
    return fx.sql(FEAT_SQL, body=f"""
SELECT a.station, a.obs_date, a.lag1, a.roll7, avg(b.lag1) AS nbr_lag1_avg, avg(b.roll7) AS nbr_roll7_avg
FROM f a LEFT JOIN f b ON b.obs_date = a.obs_date AND b.station <> a.station{mem}{tgt}
GROUP BY a.station, a.obs_date, a.lag1, a.roll7""")


def _feat(spark, sf_dir):
    g = fx.grid(spark, sf_dir)
    return FE.add_rolling(FE.add_rolling(FE.add_lags(g, (1,)), (7,)), (3,), "max")


def _nbr(spark, sf_dir, members, targets):
    out = FE.neighbour_mean(_feat(spark, sf_dir), ["lag1", "roll7"], members=members, targets=targets)
    return out.select("station", "obs_date", "lag1", "roll7", "nbr_lag1_avg", "nbr_roll7_avg")


@register("w8_neighbour_targets", _nbr_sql(fx.TARGETS, fx.TARGETS), NBR_SPEC)
def w8_neighbour_targets(spark, sf_dir):
    """W8 (a): neighbours = the other target stations."""
    return _nbr(spark, sf_dir, fx.TARGETS, fx.TARGETS)


@register("w8_neighbour_non_targets", _nbr_sql(fx.NON_TARGETS, fx.TARGETS), NBR_SPEC)
def w8_neighbour_non_targets(spark, sf_dir):
    """W8 (b): neighbours of a target = every non-target station."""
    return _nbr(spark, sf_dir, fx.NON_TARGETS, fx.TARGETS)


@register("w8_neighbour_all", _nbr_sql(None, None), NBR_SPEC)
def w8_neighbour_all(spark, sf_dir):
    """W8 (c): neighbours = every other station."""
    return _nbr(spark, sf_dir, None, None)


# An explicit neighbour map, as a user would load it from a JSON file.
NEIGHBOUR_MAP = {"137110a": ["137120a", "137140a"], "137120a": ["137110a"],
                 "137130a": ["137140a", "137150a", "137110a"]}


@register("j6_neighbour_edges", fx.sql(FEAT_SQL, f"""
e AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{n}')" for s, ns in NEIGHBOUR_MAP.items() for n in ns)})
      AS t(station, neighbour))""", body="""
SELECT a.station, a.obs_date, a.lag1, a.roll7, m.nbr_lag1_avg, m.nbr_roll7_avg FROM f a
LEFT JOIN (SELECT e.station, b.obs_date, avg(b.lag1) AS nbr_lag1_avg, avg(b.roll7) AS nbr_roll7_avg
           FROM e JOIN f b ON b.station = e.neighbour GROUP BY e.station, b.obs_date) m
  ON m.station = a.station AND m.obs_date = a.obs_date"""), NBR_SPEC)
def j6_neighbour_edges(spark, sf_dir):
    edges = FE.edges_from_map(spark, NEIGHBOUR_MAP)
    out = FE.neighbour_mean_edges(_feat(spark, sf_dir), edges, ["lag1", "roll7"])
    return out.select("station", "obs_date", "lag1", "roll7", "nbr_lag1_avg", "nbr_roll7_avg")


@register("w7_interaction", fx.sql(FEAT_SQL, body=f"""
SELECT a.station, a.obs_date, avg(b.lag1) * a.roll7 AS spatial_x_roll7, avg(b.max3) AS nbr_max3_avg
FROM f a LEFT JOIN f b ON b.obs_date = a.obs_date AND b.station <> a.station
  AND b.station IN {fx.in_list(fx.TARGETS)}
WHERE a.station IN {fx.in_list(fx.TARGETS)} GROUP BY a.station, a.obs_date, a.roll7"""),
          "station:s obs_date:d spatial_x_roll7:f nbr_max3_avg:f")
def w7_interaction(spark, sf_dir):
    out = FE.neighbour_mean(_feat(spark, sf_dir), ["lag1", "max3"], members=fx.TARGETS, targets=fx.TARGETS)
    return FE.add_interaction(out).select("station", "obs_date", "spatial_x_roll7", "nbr_max3_avg")


@register("j5_day_over_day", fx.sql("""
p AS (SELECT s.station,
             coalesce(max(CASE WHEN g.obs_date = DATE '1999-06-15' THEN g.rain_mm END), 0) AS today,
             coalesce(max(CASE WHEN g.obs_date = DATE '1999-06-14' THEN g.rain_mm END), 0) AS yesterday
      FROM (SELECT DISTINCT station FROM grid) s JOIN grid g USING (station)
      WHERE g.obs_date BETWEEN DATE '1999-06-14' AND DATE '1999-06-15' GROUP BY s.station)""", body="""
SELECT station, today, yesterday, today - yesterday AS change,
       avg(today - yesterday) OVER () AS mean_change,
       CASE WHEN avg(today - yesterday) OVER () > 5 THEN 'naik'
            WHEN avg(today - yesterday) OVER () < -5 THEN 'turun' ELSE 'stabil' END AS trend_class
FROM p"""), "station:s today:f yesterday:f change:f mean_change:f trend_class:s")
def j5_day_over_day(spark, sf_dir):
    return FE.day_over_day(fx.grid(spark, sf_dir), "1999-06-15")


@register("w11_seeded_features", fx.sql(f"""
hist AS (SELECT * FROM grid WHERE obs_date < DATE '2001-07-01'),
fut AS (SELECT * FROM grid WHERE obs_date >= DATE '2001-07-01'),
seed AS (SELECT h.*, true AS is_seed FROM hist h
         WHERE h.obs_date >= DATE '2001-07-01' - INTERVAL 365 DAY),
b AS (SELECT * FROM seed UNION ALL SELECT *, false AS is_seed FROM fut),
f AS (SELECT station, obs_date, is_seed, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2, lag(rain_mm, 3) OVER w AS lag3,
             avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
             avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30,
             avg(rain_mm) OVER (w ROWS BETWEEN 365 PRECEDING AND 1 PRECEDING) AS roll365 FROM b {W})""", body="""
SELECT a.station, a.obs_date, a.lag1, a.lag2, a.lag3, a.roll7, a.roll30, a.roll365, avg(o.lag1) AS nbr_lag1_avg, avg(o.roll7) AS nbr_roll7_avg
FROM f a LEFT JOIN f o ON o.obs_date = a.obs_date AND o.station <> a.station
WHERE NOT a.is_seed GROUP BY ALL"""), "station:s obs_date:d lag1:f lag2:f lag3:f roll7:f roll30:f roll365:f nbr_lag1_avg:f nbr_roll7_avg:f")
def w11_seeded_features(spark, sf_dir):
    g = fx.grid(spark, sf_dir)
    hist = g.filter(F.col("obs_date") < F.lit("2001-07-01").cast("date"))
    fut = g.filter(F.col("obs_date") >= F.lit("2001-07-01").cast("date"))
    out = FE.features_with_seed(hist, fut, seed_days=365, rolls=(7, 30, 365))
    return out.select("station", "obs_date", "lag1", "lag2", "lag3", "roll7", "roll30", "roll365", "nbr_lag1_avg", "nbr_roll7_avg")


WIDE_SPEC = "obs_date:d " + " ".join(f"{s}:f" for s in fx.STATIONS)


@register("u3_to_wide", fx.sql(body=f"""
SELECT obs_date, {", ".join(f"avg(CASE WHEN station = '{s}' THEN rain_mm END) AS \"{s}\"" for s in fx.STATIONS)}
FROM grid GROUP BY obs_date"""), WIDE_SPEC)
def u3_to_wide(spark, sf_dir):
    return FE.to_wide(fx.grid(spark, sf_dir), fx.STATIONS)


@register("u4_to_long", fx.sql(body="SELECT obs_date, station, rain_mm FROM grid"),
          "obs_date:d station:s rain_mm:f")
def u4_to_long(spark, sf_dir):
    wide = FE.to_wide(fx.grid(spark, sf_dir), fx.STATIONS)
    return FE.to_long(wide, fx.STATIONS)


UPLOAD_STATIONS = fx.TARGETS + ("137199a",)


def upload_wide(spark, sf_dir):
    """FIXTURES §5 uploaded forecast: daily values of the three targets, wide (one column
    per station)."""
    return FE.to_wide(C.keep_stations(fx.grid(spark, sf_dir), "station", fx.TARGETS), fx.TARGETS)


UPLOAD_SQL = f"""
up AS (SELECT obs_date, {", ".join(f"avg(CASE WHEN station = '{s}' THEN rain_mm END) AS \"{s}\"" for s in fx.TARGETS)}
       FROM grid GROUP BY obs_date),
fc AS ({" UNION ALL ".join(f"SELECT obs_date, '{s}' AS station, coalesce(\"{s}\", 0e0) AS rain_mm FROM up"
                          for s in fx.TARGETS)}
       UNION ALL SELECT obs_date, '137199a' AS station, 0e0 AS rain_mm FROM up)"""


@register("u5_unpivot_forecast", fx.sql(UPLOAD_SQL, body="SELECT * FROM fc"),
          "obs_date:d station:s rain_mm:f")
def u5_unpivot_forecast(spark, sf_dir):
    return FE.unpivot_forecast(upload_wide(spark, sf_dir), UPLOAD_STATIONS)


ORACLES["w2_rolling_chunked"] = ORACLES["w2_rolling"]
ORACLES["s3_bucketed_lags"] = ORACLES["w1_lags"]


@register("w5_wet_run_chunked")
def w5_wet_run_chunked(spark, sf_dir):
    """W5 on (station, 2-year chunk) partitions with the two-pass carry (same oracle)."""
    wet = F.coalesce(F.col("rain_mm") > 0, F.lit(False))
    return FE.run_before_chunked(fx.grid(spark, sf_dir), ~wet, "consec_rain", first_null=False,
                                 chunk_days=730).select("station", "obs_date", "rain_mm", "consec_rain")


@register("w6_dry_run_chunked")
def w6_dry_run_chunked(spark, sf_dir):
    """W6 on (station, 2-year chunk) partitions with the two-pass carry (same oracle)."""
    wet = F.coalesce(F.col("rain_mm") > 0.1, F.lit(False))
    return FE.run_before_chunked(fx.grid(spark, sf_dir), wet, "dry_days", first_null=True,
                                 chunk_days=730).select("station", "obs_date", "rain_mm", "dry_days")


ORACLES["w5_wet_run_chunked"] = ORACLES["w5_wet_run"]
ORACLES["w6_dry_run_chunked"] = ORACLES["w6_dry_run"]


@register("w5_wet_run_of_intervals")
def w5_wet_run_of_intervals(spark, sf_dir):
    """W5 from the interval-coded panel (same oracle)."""
    from stormlens.operators import intervals as IV
    runs = IV.with_runs(IV.to_intervals(*fx.grid_input(spark, sf_dir)), "consec_rain", ~F.coalesce(F.col("value") > 0, F.lit(False)), False)
    return IV.days_with_run(runs, "consec_rain")


@register("w6_dry_run_of_intervals")
def w6_dry_run_of_intervals(spark, sf_dir):
    """W6 from the interval-coded panel (same oracle)."""
    from stormlens.operators import intervals as IV
    runs = IV.with_runs(IV.to_intervals(*fx.grid_input(spark, sf_dir)), "dry_days", F.col("value") > 0.1, True)
    return IV.days_with_run(runs, "dry_days")


ORACLES["w5_wet_run_of_intervals"] = ORACLES["w5_wet_run"]
ORACLES["w6_dry_run_of_intervals"] = ORACLES["w6_dry_run"]


@register("u5_upload_csv")
def u5_upload_csv(spark, sf_dir):
    """U5 + D8 from a file: the wide forecast is written as an upload CSV (date +
    one column per station) into the shared folder, read back with an explicit
    schema and unpivoted; a station absent from the file counts as 0 mm."""
    import os
    import uuid

    from pyspark.sql import types as T

    from stormlens.session import ensure_checkpoint_dir
    from stormlens.sources.readings import read_csv_typed, write_table
    path = os.path.join(ensure_checkpoint_dir(spark), f"upload-{uuid.uuid4().hex}")
    write_table(upload_wide(spark, sf_dir), path, fmt="csv")
    schema = T.StructType([T.StructField("obs_date", T.StringType())]
                          + [T.StructField(s, T.DoubleType()) for s in fx.TARGETS])
    wide = read_csv_typed(spark, path, schema, date_cols=("obs_date",))
    return FE.unpivot_forecast(wide, UPLOAD_STATIONS)


ORACLES["u5_upload_csv"] = ORACLES["u5_unpivot_forecast"]
