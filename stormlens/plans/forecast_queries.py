"""Registered queries: risk scalars and tables, monthly series, seasonal forecast,
disaggregation (X3-X7, X10, A15-A20, O7, P1, P3, P4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stormlens.functions import risk as R
from stormlens.operators import forecast as FC
from stormlens.operators import risk as RK
from stormlens.operators.clean import fill_level
from stormlens.operators.features import unpivot_forecast
from stormlens.operators.impute import knn_impute
from stormlens.plans import fixture as fx
from stormlens.plans.feature_queries import UPLOAD_SQL, UPLOAD_STATIONS, upload_wide
from stormlens.plans.impute_queries import WIDE_SQL, knn_sql, long_sql
from stormlens.plans.registry import register
from stormlens.session import cut_lineage


def even_sql(expr: str, digits: int) -> str:
    """Banker's rounding of a value from 0 on, on whole numbers of 1e-10."""
    x, unit = f"CAST(round(({expr}) * 1e10) AS BIGINT)", 10 ** (10 - digits)
    return (f"(({x} // {unit}) + CASE WHEN {x} % {unit} > {unit // 2} OR ({x} % {unit} = {unit // 2} "
            f"AND ({x} // {unit}) % 2 = 1) THEN 1 ELSE 0 END) / 1e{digits}")


def clip_sql(expr: str, scale: float, lo, hi, gain: float = 1.0) -> str:
    x = f"({expr}) / {scale}e0" + (f" * {gain}e0" if gain != 1.0 else "")
    x = f"least({hi}e0, {x})"
    if lo is not None:
        x = f"greatest({lo}e0, {x})"
    return f"CASE WHEN ({expr}) IS NOT NULL THEN {x} END"


def level_sql(expr: str, cuts=(0.25, 0.40, 0.60)) -> str:
    a, b, c = cuts
    return (f"CASE WHEN ({expr}) < {a} THEN 'Aman' WHEN ({expr}) < {b} THEN 'Waspada' "
            f"WHEN ({expr}) < {c} THEN 'Siaga' WHEN ({expr}) IS NOT NULL THEN 'Bahaya' END")


def severity_sql(expr: str) -> str:
    return (f"CASE {expr} WHEN 'Aman' THEN 0 WHEN 'Waspada' THEN 1 WHEN 'Siaga' THEN 2 "
            f"WHEN 'Bahaya' THEN 3 END")


CLIP80 = clip_sql("rain_mm", 80, 0.05, 0.95)
SCORED_SQL = UPLOAD_SQL + f""",
scored AS (SELECT obs_date, station, {even_sql("rain_mm", 1)} AS rain_mm,
                  {even_sql(CLIP80, 4)} AS risk, {level_sql(CLIP80)} AS level FROM fc)"""
FC_SPEC = "obs_date:d station:s rain_mm:f risk:f level:s"


def scored_upload(spark, sf_dir):
    """FIXTURES §5 long forecast: unpivoted upload scored with the clip80 variant."""
    return RK.score_forecast(unpivot_forecast(upload_wide(spark, sf_dir), UPLOAD_STATIONS), "clip80")


@register("p4_score_forecast", fx.sql(SCORED_SQL, body="SELECT * FROM scored"), FC_SPEC)
def p4_score_forecast(spark, sf_dir):
    return scored_upload(spark, sf_dir).select("obs_date", "station", "rain_mm", "risk", "level")


def _risk_variants_sql() -> str:
    cols = []
    for name, (scale, lo, hi, gain) in R.RISK_VARIANTS.items():
        cols.append(f"{clip_sql('rain_mm', scale, lo, hi, gain)} AS risk_{name}")
    return ", ".join(cols)


@register("x6_rain_to_risk", fx.sql(body=f"SELECT station, obs_date, {_risk_variants_sql()} FROM grid"),
          "station:s obs_date:d " + " ".join(f"risk_{n}:f" for n in R.RISK_VARIANTS))
def x6_rain_to_risk(spark, sf_dir):
    g = fx.grid(spark, sf_dir)
    return g.select("station", "obs_date",
                    *[R.rain_to_risk("rain_mm", n).alias(f"risk_{n}") for n in R.RISK_VARIANTS])


@register("x4_risk_level", fx.sql(body=f"""
SELECT station, obs_date, {level_sql(clip_sql('rain_mm', 100, 0.05, 0.95))} AS level_prob,
       {level_sql('rain_mm', (10, 20, 50))} AS level_rain FROM grid"""),
          "station:s obs_date:d level_prob:s level_rain:s")
def x4_risk_level(spark, sf_dir):
    """X4 + X5: level from probability cuts and from rain cuts."""
    g = fx.grid(spark, sf_dir)
    return g.select("station", "obs_date",
                    R.risk_level(R.rain_to_risk("rain_mm", "clip100")).alias("level_prob"),
                    R.risk_level_rain("rain_mm").alias("level_rain"))


@register("x3_rain_category", fx.sql(body="""
SELECT CASE WHEN rain_mm = 0 THEN 'Tidak Hujan' WHEN rain_mm < 10 THEN 'Ringan'
            WHEN rain_mm < 20 THEN 'Sedang' WHEN rain_mm < 50 THEN 'Lebat'
            WHEN rain_mm < 100 THEN 'Sangat Lebat' WHEN rain_mm IS NOT NULL THEN 'Ekstrem' END AS category,
       count(*) AS n_days FROM grid GROUP BY 1"""), "category:s n_days:i")
def x3_rain_category(spark, sf_dir):
    g = fx.grid(spark, sf_dir)
    return g.groupBy(R.rain_category("rain_mm").alias("category")).agg(F.count(F.lit(1)).alias("n_days"))


@register("x7_pct_text", fx.sql(body="""
SELECT station, """ + even_sql("avg(rain_mm)", 2) + """ AS mean_rain,
       printf('%.1f', count_if(rain_mm > 50) * 100.0 / count(*)) || '%' AS pct_heavy
FROM grid GROUP BY station"""), "station:s mean_rain:f pct_heavy:s")
def x7_pct_text(spark, sf_dir):
    """Half-even rounding and percent text."""
    g = fx.grid(spark, sf_dir)
    return g.groupBy("station").agg(
        R.round_half_even(F.avg("rain_mm"), 2).alias("mean_rain"),
        R.pct_text(F.count_if(F.col("rain_mm") > 50) / F.count(F.lit(1)), 1).alias("pct_heavy"))


@register("i8_fill_level", fx.sql(body=f"""
SELECT station, obs_date, coalesce({level_sql(clip_sql('rain_mm', 80, 0.05, 0.95))}, 'Aman') AS level
FROM grid"""), "station:s obs_date:d level:s")
def i8_fill_level(spark, sf_dir):
    g = fx.grid(spark, sf_dir).select(
        "station", "obs_date", R.risk_level(R.rain_to_risk("rain_mm", "clip80")).alias("level"))
    return fill_level(g)


@register("a17_daily_summary", fx.sql(SCORED_SQL, """
cnt AS (SELECT obs_date, level, count(*) AS n FROM scored GROUP BY 1, 2),
md AS (SELECT obs_date, arg_max(level, n * 10 + """ + severity_sql("level") + """) AS modal_level
       FROM cnt GROUP BY 1)""", body="""
SELECT s.obs_date, avg(risk) AS mean_risk, avg(rain_mm) AS mean_rain, any_value(md.modal_level) AS modal_level
FROM scored s JOIN md USING (obs_date) GROUP BY s.obs_date"""),
          "obs_date:d mean_risk:f mean_rain:f modal_level:s")
def a17_daily_summary(spark, sf_dir):
    return RK.daily_summary(scored_upload(spark, sf_dir))


@register("a18_monthly_summary", fx.sql(SCORED_SQL, """
cnt AS (SELECT date_trunc('month', obs_date) AS month, level, count(*) AS n FROM scored GROUP BY 1, 2),
md AS (SELECT month, arg_max(level, n * 10 + """ + severity_sql("level") + """) AS modal_level
       FROM cnt GROUP BY 1)""", body="""
SELECT CAST(date_trunc('month', s.obs_date) AS DATE) AS month, avg(risk) AS mean_risk,
       avg(rain_mm) AS mean_rain, any_value(md.modal_level) AS modal_level
FROM scored s JOIN md ON md.month = date_trunc('month', s.obs_date) GROUP BY 1"""),
          "month:d mean_risk:f mean_rain:f modal_level:s")
def a18_monthly_summary(spark, sf_dir):
    return RK.monthly_summary(scored_upload(spark, sf_dir))


@register("a19_alert_counters", fx.sql(SCORED_SQL, body="""
SELECT CAST(floor(count_if(level IN ('Siaga', 'Bahaya')) / 3) AS BIGINT) AS alert_days,
       CAST(floor(count_if(level = 'Bahaya') / 3) AS BIGINT) AS danger_days,
       count(DISTINCT CASE WHEN level IN ('Siaga', 'Bahaya') THEN obs_date END) AS alert_dates,
       avg(rain_mm) AS mean_rain FROM scored"""),
          "alert_days:i danger_days:i alert_dates:i mean_rain:f")
def a19_alert_counters(spark, sf_dir):
    return RK.alert_counters(scored_upload(spark, sf_dir), n_stations=3)


@register("a20_date_card", fx.sql(SCORED_SQL, body=f"""
SELECT avg(risk) AS mean_risk,
       CASE max({severity_sql('level')}) WHEN 0 THEN 'Aman' WHEN 1 THEN 'Waspada' WHEN 2 THEN 'Siaga'
            WHEN 3 THEN 'Bahaya' END AS max_level,
       avg(rain_mm) AS mean_rain, max(rain_mm) AS max_rain,
       count_if(level IN ('Siaga', 'Bahaya')) AS n_alert_stations
FROM scored WHERE obs_date = DATE '2001-07-12'"""),
          "mean_risk:f max_level:s mean_rain:f max_rain:f n_alert_stations:i")
def a20_date_card(spark, sf_dir):
    return RK.date_card(scored_upload(spark, sf_dir), "2001-07-12")


@register("a20_date_card_text_max", fx.sql(SCORED_SQL, body="""
SELECT avg(risk) AS mean_risk, max(level) AS max_level, avg(rain_mm) AS mean_rain,
       max(rain_mm) AS max_rain, count_if(level IN ('Siaga', 'Bahaya')) AS n_alert_stations
FROM scored WHERE obs_date = DATE '2001-07-12'"""),
          "mean_risk:f max_level:s mean_rain:f max_rain:f n_alert_stations:i")
def a20_date_card_text_max(spark, sf_dir):
    """A20 with the original dashboards' lexicographic "highest level" (T7)."""
    return RK.date_card(scored_upload(spark, sf_dir), "2001-07-12", lexicographic=True)


@register("o7_modal_level", fx.sql(f"""
lv AS (SELECT station, {level_sql(clip_sql('rain_mm', 100, 0.05, 0.95))} AS level FROM grid),
cnt AS (SELECT station, level, count(*) AS n FROM lv WHERE level IS NOT NULL GROUP BY 1, 2)""", body=f"""
SELECT station, arg_max(level, n * 10 + {severity_sql('level')}) AS modal_level FROM cnt GROUP BY 1"""),
          "station:s modal_level:s")
def o7_modal_level(spark, sf_dir):
    g = fx.grid(spark, sf_dir).withColumn("level", R.risk_level(R.rain_to_risk("rain_mm", "clip100")))
    return RK.modal_level(["station"], g)


@register("x10_next_day", fx.sql(body=f"""
SELECT CAST(obs_date + INTERVAL 1 DAY AS DATE) AS target_date, avg(rain_mm) AS mean_rain,
       {clip_sql('avg(rain_mm)', 80, 0.05, 0.95)} AS risk,
       {level_sql(clip_sql('avg(rain_mm)', 80, 0.05, 0.95))} AS level
FROM grid GROUP BY obs_date"""), "target_date:d mean_rain:f risk:f level:s")
def x10_next_day(spark, sf_dir):
    return RK.next_day_risk(fx.grid(spark, sf_dir))


# --- monthly series and forecasts ------------------------------------------------

MONTHLY_SQL = WIDE_SQL + "," + knn_sql("wide", fx.STATIONS) + f""",
hist AS ({long_sql("k_out", fx.STATIONS)}),
st_month AS (SELECT station, CAST(date_trunc('month', obs_date) AS DATE) AS month,
                    coalesce(sum(rain_mm), 0e0) AS station_total FROM hist GROUP BY 1, 2),
monthly AS (SELECT 'network' AS series, month, sum(station_total) AS total FROM st_month GROUP BY month),
clim AS (SELECT 'network' AS series, station, month(obs_date) AS cal_month, avg(rain_mm) AS clim
         FROM hist GROUP BY 2, 3)"""


def _hist(spark, sf_dir):
    """The whole history, gaps imputed first (a missing day isn't a dry one)."""
    return knn_impute(fx.grid(spark, sf_dir), fx.STATIONS).drop("imputed")


def _hist_once(spark, sf_dir):
    """``_hist`` written once for the forecasts, which read it twice (totals and climatology)."""
    return cut_lineage(_hist(spark, sf_dir))


def next_month(spark, sf_dir):
    """The first month after the history's last."""
    last = fx.bounds(spark, sf_dir)[1]
    return (last.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


@register("a15_monthly_totals", fx.sql(MONTHLY_SQL, body="SELECT * FROM monthly"),
          "series:s month:d total:f")
def a15_monthly_totals(spark, sf_dir):
    return FC.monthly_totals(_hist(spark, sf_dir), "sum")


@register("a15_monthly_mean", fx.sql(MONTHLY_SQL, body="""
SELECT 'network' AS series, month, avg(station_total) AS total FROM st_month GROUP BY month"""),
          "series:s month:d total:f")
def a15_monthly_mean(spark, sf_dir):
    return FC.monthly_totals(_hist(spark, sf_dir), "mean")


@register("a16_climatology", fx.sql(MONTHLY_SQL, body="SELECT * FROM clim"),
          "series:s station:s cal_month:i clim:f")
def a16_climatology(spark, sf_dir):
    return FC.monthly_climatology(_hist(spark, sf_dir))


SEASONAL_SQL = MONTHLY_SQL + f""",
cm AS (SELECT series, month(month) AS cal_month, avg(total) AS pred FROM monthly GROUP BY 1, 2),
fut AS (SELECT 'network' AS series,
               CAST((SELECT date_trunc('month', max(obs_date)) FROM hist) + to_months(CAST(k + 1 AS INTEGER)) AS DATE) AS month
        FROM range(36) t(k)),
mfc AS (SELECT f.series, f.month, cm.pred, cm.pred * 0.7 AS lower, cm.pred * 1.3 AS upper
        FROM fut f LEFT JOIN cm ON cm.series = f.series AND cm.cal_month = month(f.month))"""


@register("p1_seasonal_mean", fx.sql(SEASONAL_SQL, body="SELECT * FROM mfc"),
          "series:s month:d pred:f lower:f upper:f")
def p1_seasonal_mean(spark, sf_dir):
    monthly = FC.monthly_totals(_hist(spark, sf_dir), "sum")
    return FC.seasonal_mean_forecast(monthly, next_month(spark, sf_dir), 36)


DISAGG_SQL = SEASONAL_SQL + """,
fdays AS (SELECT series, month, pred, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY))
         AS DATE) AS obs_date, month(month) AS cal_month, day(last_day(month)) AS dim FROM mfc),
cfull AS (SELECT s.series, s.station, m.cal_month, coalesce(c.clim, 10e0 / 3e0) AS clim
          FROM (SELECT DISTINCT series, station FROM clim) s
          CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS cal_month) m
          LEFT JOIN clim c ON c.series = s.series AND c.station = s.station AND c.cal_month = m.cal_month),
cst AS (SELECT series, cal_month, sum(clim) AS csum, avg(clim) AS cmean, count(*) AS cn
        FROM cfull GROUP BY 1, 2),
dj AS (SELECT d.series, d.obs_date, c.station, d.pred / d.dim AS target, c.clim, s.csum, s.cmean, s.cn
       FROM fdays d JOIN cfull c ON c.series = d.series AND c.cal_month = d.cal_month
       JOIN cst s ON s.series = d.series AND s.cal_month = d.cal_month)"""


@register("p3_disaggregate_share", fx.sql(DISAGG_SQL, body="""
SELECT series, obs_date, station,
       greatest(target * CASE WHEN csum > 0 THEN clim / csum ELSE 1.0 / cn END, 0e0) AS rain_mm FROM dj"""),
          "series:s obs_date:d station:s rain_mm:f")
def p3_disaggregate_share(spark, sf_dir):
    hist = _hist_once(spark, sf_dir)
    mfc = FC.seasonal_mean_forecast(FC.monthly_totals(hist, "sum"), next_month(spark, sf_dir), 36)
    return FC.disaggregate(mfc, FC.monthly_climatology(hist), mode="share")


@register("p3_disaggregate_scale", fx.sql(DISAGG_SQL, body="""
SELECT series, obs_date, station,
       greatest(clim * CASE WHEN csum > 0 THEN target / cmean ELSE target END, 0e0) AS rain_mm FROM dj"""),
          "series:s obs_date:d station:s rain_mm:f")
def p3_disaggregate_scale(spark, sf_dir):
    hist = _hist_once(spark, sf_dir)
    mfc = FC.seasonal_mean_forecast(FC.monthly_totals(hist, "sum"), next_month(spark, sf_dir), 36)
    return FC.disaggregate(mfc, FC.monthly_climatology(hist), mode="scale")


LIN50 = clip_sql("rain_mm", 50, None, 1.0, 0.8)


@register("p4_score_disaggregated", fx.sql(DISAGG_SQL + """,
dd AS (SELECT obs_date, station,
              greatest(target * CASE WHEN csum > 0 THEN clim / csum ELSE 1.0 / cn END, 0e0) AS rain_mm
       FROM dj)""", body=f"""
SELECT obs_date, station, {even_sql("rain_mm", 1)} AS rain_mm, {even_sql(LIN50, 4)} AS risk,
       {level_sql('rain_mm', (10, 20, 50))} AS level FROM dd"""), FC_SPEC)
def p4_score_disaggregated(spark, sf_dir):
    """P4 on the simple hybrid path: lin50 risk, level from rain depth."""
    hist = _hist_once(spark, sf_dir)
    mfc = FC.seasonal_mean_forecast(FC.monthly_totals(hist, "sum"), next_month(spark, sf_dir), 36)
    daily = FC.disaggregate(mfc, FC.monthly_climatology(hist), mode="share")
    return RK.score_forecast(daily, "lin50", level_by="rain").select(
        "obs_date", "station", "rain_mm", "risk", "level")


UNIT100 = clip_sql("rain_mm", 100, 0, 1)


@register("p5_score_forecast_fallback", fx.sql(DISAGG_SQL + f""",
dd AS (SELECT obs_date, station,
              greatest(target * CASE WHEN csum > 0 THEN clim / csum ELSE 1.0 / cn END, 0e0) AS rain_mm
       FROM dj WHERE station IN {fx.in_list(fx.TARGETS)})""", body=f"""
SELECT obs_date, station, rain_mm, {UNIT100} AS risk, {level_sql(UNIT100)} AS level FROM dd"""), FC_SPEC)
def p5_score_forecast_fallback(spark, sf_dir):
    """P5 without a model: the rain depth decides on the rows whose features are complete."""
    hist = _hist_once(spark, sf_dir)
    mfc = FC.seasonal_mean_forecast(FC.monthly_totals(hist, "sum"), next_month(spark, sf_dir), 36)
    daily = FC.disaggregate(mfc, FC.monthly_climatology(hist)).select("station", "obs_date", "rain_mm")
    mine = F.col("station").isin(*fx.TARGETS)
    return RK.score_forecast_model(hist.filter(mine), daily.filter(mine), targets=fx.TARGETS, members=fx.TARGETS)
