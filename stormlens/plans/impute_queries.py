"""Registered queries: imputation (I4 KNN, I5 clip, I6 interpolation, I7 back-test).

The oracle for KNN is plain brute force in SQL: every (receiver, donor) pair,
the NaN-aware distance, ``row_number <= 5`` over (distance, date) - the same tie
rule the engine documents - and the weighted mean.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlens.operators import impute as I
from stormlens.operators.features import to_long, to_wide
from stormlens.plans import fixture as fx
from stormlens.plans.registry import register

ST = fx.STATIONS
P = len(ST)


def knn_sql(src: str, cols, k: int = 5, prefix: str = "k") -> str:
    """CTEs imputing the wide CTE ``src(obs_date, cols…)``; result CTE ``{prefix}_out``."""
    p = len(cols)
    v = [f"v{j}" for j in range(p)]
    sel = ", ".join(f'"{c}" AS {v[j]}' for j, c in enumerate(cols))
    both = [f"(r.{x} IS NOT NULL AND d.{x} IS NOT NULL)" for x in v]
    sq = " + ".join(f"(CASE WHEN {b} THEN (r.{x} - d.{x}) * (r.{x} - d.{x}) ELSE 0e0 END)"
                    for b, x in zip(both, v))
    m = " + ".join(f"CAST({b} AS INTEGER)" for b in both)
    cand = "\n  UNION ALL ".join(
        f"SELECT rkey, {j} AS col, dist, dkey, d{j} AS val FROM {prefix}_dist "
        f"WHERE r{j} IS NULL AND d{j} IS NOT NULL AND dist IS NOT NULL" for j in range(p))
    outs = ", ".join(
        f'CASE WHEN w.{v[j]} IS NULL THEN greatest(coalesce(e{j}.est, mm.m{j}), 0e0) '
        f'ELSE greatest(w.{v[j]}, 0e0) END AS "{c}"' for j, c in enumerate(cols))
    joins = " ".join(f"LEFT JOIN {prefix}_est e{j} ON e{j}.rkey = w.key AND e{j}.col = {j}" for j in range(p))
    return f"""
{prefix}_w AS (SELECT obs_date AS key, {sel} FROM {src}),
{prefix}_mean AS (SELECT {", ".join(f"avg({x}) AS m{j}" for j, x in enumerate(v))} FROM {prefix}_w),
{prefix}_rec AS (SELECT * FROM {prefix}_w WHERE {" OR ".join(f"{x} IS NULL" for x in v)}),
{prefix}_pair AS (SELECT r.key AS rkey, d.key AS dkey, {sq} AS sq, {m} AS m,
        {", ".join(f"r.{x} AS r{j}, d.{x} AS d{j}" for j, x in enumerate(v))}
        FROM {prefix}_rec r, {prefix}_w d),
{prefix}_dist AS (SELECT *, CASE WHEN m > 0 THEN sqrt(({p} / m) * sq) END AS dist FROM {prefix}_pair),
{prefix}_cand AS ({cand}),
{prefix}_top AS (SELECT *, row_number() OVER (PARTITION BY rkey, col ORDER BY dist, dkey) AS rn
        FROM {prefix}_cand),
{prefix}_sel AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY rkey, col) AS hz
        FROM {prefix}_top WHERE rn <= {k}),
{prefix}_est AS (SELECT rkey, col, sum(wt * val) / sum(wt) AS est FROM
        (SELECT *, CASE WHEN hz = 1 THEN CASE WHEN dist = 0 THEN 1e0 ELSE 0e0 END ELSE 1e0 / dist END AS wt
         FROM {prefix}_sel) GROUP BY rkey, col),
{prefix}_out AS (SELECT w.key AS obs_date, {outs} FROM {prefix}_w w CROSS JOIN {prefix}_mean mm {joins})"""


WIDE_SQL = "wide AS (SELECT obs_date, " + ", ".join(
    f"avg(CASE WHEN station = '{s}' THEN rain_mm END) AS \"{s}\"" for s in ST) + " FROM grid GROUP BY obs_date)"
WIDE_SPEC = "obs_date:d " + " ".join(f"{s}:f" for s in ST)


def long_sql(out: str, stations) -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS station, obs_date, \"{s}\" AS rain_mm FROM {out}" for s in stations)


@register("i4_knn_impute", fx.sql(WIDE_SQL, knn_sql("wide", ST), body="SELECT * FROM k_out"), WIDE_SPEC)
def i4_knn_impute(spark, sf_dir):
    """I4 + I5: KNN (k=5, distance weights) over the five stations, clipped at 0."""
    return I.knn_impute_wide(to_wide(fx.grid(spark, sf_dir), ST), ST, k=5)


@register("i4_knn_impute_long", fx.sql(WIDE_SQL, knn_sql("wide", ST), "ko AS (" + long_sql("k_out", ST) + ")", body="""
SELECT g.station, g.obs_date, ko.rain_mm, CAST(g.rain_mm IS NULL AS INT) AS imputed
FROM grid g JOIN ko ON ko.station = g.station AND ko.obs_date = g.obs_date"""), "station:s obs_date:d rain_mm:f imputed:i")
def i4_knn_impute_long(spark, sf_dir):
    """I4 on the long panel: every cell with its value and whether it was filled."""
    return I.knn_impute(fx.grid(spark, sf_dir), ST, k=5)


def _lowered(df):
    """Daily values less 5 mm, so that observed values below 0 exist."""
    return df.withColumn("rain_mm", F.col("rain_mm") - 5.0)


@register("i4_knn_clip_paths", fx.sql("low AS (SELECT station, obs_date, rain_mm - 5e0 AS rain_mm FROM grid)",
                                      WIDE_SQL.replace("FROM grid", "FROM low"), knn_sql("wide", ST),
                                      "ko AS (" + long_sql("k_out", ST) + ")", """
gapless AS (SELECT station, obs_date, CASE WHEN rain_mm < 0 THEN 0e0 ELSE rain_mm END AS rain_mm FROM low
            WHERE obs_date IN (SELECT obs_date FROM low GROUP BY obs_date HAVING count(rain_mm) = count(*)))""", body="""
SELECT p.path, ko.* FROM ko, (SELECT unnest(['wide', 'list', 'region']) AS path) p
UNION ALL SELECT 'gapless', * FROM gapless"""), "path:s station:s obs_date:d rain_mm:f")
def i4_knn_clip_paths(spark, sf_dir):
    """I4 + I5 with negative observed values: the wide, the list and the region path, and a
    frame without a gap, all clip in the same way."""
    low = _lowered(fx.grid(spark, sf_dir))
    wide = to_wide(low, ST)
    paths = {"wide": to_long(I.knn_impute_wide(wide, ST), ST), "list": I.knn_impute(low, ST),
             "region": I.knn_impute(low.withColumn("region", F.lit("r")), region_col="region"),
             "gapless": to_long(I.knn_impute_wide(wide.dropna(subset=list(ST)), ST), ST)}
    out = None
    for name, df in paths.items():
        part = df.select(F.lit(name).alias("path"), "station", "obs_date", "rain_mm")
        out = part if out is None else out.union(part)
    return out


@register("i6_interpolate", fx.sql(f"""
ip AS (SELECT station, obs_date, rain_mm, row_number() OVER w AS pos,
              last_value(rain_mm IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
              last_value(CASE WHEN rain_mm IS NOT NULL THEN obs_date END IGNORE NULLS)
                OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
              first_value(rain_mm IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
              first_value(CASE WHEN rain_mm IS NOT NULL THEN obs_date END IGNORE NULLS)
                OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
       FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))""", body="""
SELECT station, obs_date, CASE WHEN rain_mm IS NOT NULL THEN rain_mm WHEN pv IS NULL THEN nv
         WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (obs_date - pd) / (nd - pd) END AS rain_mm
FROM ip"""), "station:s obs_date:d rain_mm:f")
def i6_interpolate(spark, sf_dir):
    """I6 on the dense calendar (positions = days here, so the oracle uses dates)."""
    return I.interpolate_linear(fx.grid(spark, sf_dir)).select("station", "obs_date", "rain_mm")


# --- I7 back-test --------------------------------------------------------------------

BT_SQL = WIDE_SQL + """,
comp AS (SELECT * FROM wide WHERE """ + " AND ".join(f'"{s}" IS NOT NULL' for s in ST) + """),
ck AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS BIGINT) AS dn, count(*) OVER () AS n FROM comp),
hid AS (SELECT *, """ + ", ".join(
    f"CAST(row_number() OVER (ORDER BY (dn * 7919 + {101 * (j + 1)}) % 10007, dn) <= floor(n * 0.1) AS INT) AS h{j}"
    for j in range(P)) + """ FROM ck),
tst AS (SELECT obs_date, """ + ", ".join(f'CASE WHEN h{j} = 1 THEN NULL ELSE "{s}" END AS "{s}"'
                                         for j, s in enumerate(ST)) + """ FROM hid),
tl AS (""" + " UNION ALL ".join(f"SELECT '{s}' AS station, obs_date, \"{s}\" AS v FROM tst" for s in ST) + """),
tip AS (SELECT station, obs_date, v, row_number() OVER w AS pos,
               last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
               last_value(CASE WHEN v IS NOT NULL THEN row_number END IGNORE NULLS)
                 OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
               first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
               first_value(CASE WHEN v IS NOT NULL THEN row_number END IGNORE NULLS)
                 OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
        FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY obs_date) AS row_number FROM tl)
        WINDOW w AS (PARTITION BY station ORDER BY obs_date)),
lin AS (SELECT station, obs_date, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
               ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END AS est FROM tip),"""
BT_SQL += knn_sql("tst", ST, prefix="b") + """,
truth AS (""" + " UNION ALL ".join(
    f"SELECT '{s}' AS station, obs_date, \"{s}\" AS v, h{j} AS h FROM hid" for j, s in enumerate(ST)) + """),
kl AS (""" + " UNION ALL ".join(f"SELECT '{s}' AS station, obs_date, \"{s}\" AS est FROM b_out" for s in ST) + """),
err AS (SELECT t.station, sqrt(avg(pow(l.est - t.v, 2))) AS rmse_linear, sqrt(avg(pow(k.est - t.v, 2))) AS rmse_knn,
               count(*) AS n_hidden
        FROM truth t JOIN lin l USING (station, obs_date) JOIN kl k USING (station, obs_date)
        WHERE t.h = 1 GROUP BY t.station)"""


@register("i7_imputation_backtest", fx.sql(BT_SQL, body="""
SELECT station, rmse_linear, rmse_knn, n_hidden,
       CASE WHEN rmse_knn < rmse_linear THEN 'knn' ELSE 'linear' END AS best FROM err
UNION ALL SELECT 'mean', avg(rmse_linear), avg(rmse_knn), sum(n_hidden),
       CASE WHEN avg(rmse_knn) < avg(rmse_linear) THEN 'knn' ELSE 'linear' END FROM err"""),
          "station:s rmse_linear:f rmse_knn:f n_hidden:i best:s")
def i7_imputation_backtest(spark, sf_dir):
    """Hide 10 % of each station's values on complete days, impute them by
    linear interpolation (row positions) and by KNN, RMSE per station and mean."""
    return I.imputation_backtest(to_wide(fx.grid(spark, sf_dir), ST), ST)


# --- many regions at once ---------------------------------------------------------------

REGION_A = fx.STATIONS                                        # prefix 1371
REGION_B = tuple(s.replace("1371", "1301", 1) for s in fx.STATIONS)  # prefix 1301

ALL_GRID_SQL = f"""
cleaned_all AS (SELECT station_id AS station, CAST(substr(data_timestamp, 1, 10) AS DATE) AS obs_date,
                       CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
                            ELSE rain_mm END AS rain_mm FROM readings),
daily_all AS (SELECT station, obs_date, avg(rain_mm) AS rain_mm FROM cleaned_all GROUP BY station, obs_date),
days_all AS (SELECT CAST(unnest(generate_series((SELECT min(obs_date) FROM cleaned_all), (SELECT max(obs_date) FROM cleaned_all),
                                                INTERVAL 1 DAY)) AS DATE) AS obs_date),
grid_all AS (SELECT s.station, d.obs_date, a.rain_mm
             FROM (SELECT DISTINCT station FROM daily_all) s CROSS JOIN days_all d
             LEFT JOIN daily_all a ON a.station = s.station AND a.obs_date = d.obs_date),
wide_a AS (SELECT obs_date, {", ".join(f"avg(CASE WHEN station = '{s}' THEN rain_mm END) AS \"{s}\"" for s in REGION_A)}
           FROM grid_all GROUP BY obs_date),
wide_b AS (SELECT obs_date, {", ".join(f"avg(CASE WHEN station = '{s}' THEN rain_mm END) AS \"{s}\"" for s in REGION_B)}
           FROM grid_all GROUP BY obs_date),"""


@register("i4_knn_impute_regions", fx.sql(ALL_GRID_SQL + knn_sql("wide_a", REGION_A, prefix="ka") + ","
                                          + knn_sql("wide_b", REGION_B, prefix="kb").lstrip("\n"),
                                          body=long_sql("ka_out", REGION_A) + " UNION ALL "
                                          + long_sql("kb_out", REGION_B)),
          "station:s obs_date:d rain_mm:f")
def i4_knn_impute_regions(spark, sf_dir):
    """I4 over every station of the network, each region (id prefix) imputed from
    its own stations only, all regions in the same jobs."""
    from stormlens.operators.calendar import densify
    from stormlens.operators.clean import to_station_days
    from stormlens.operators.impute import knn_impute
    g = densify(to_station_days(fx.readings(spark, sf_dir)), *fx.bounds(spark, sf_dir, everything=True))
    g = g.withColumn("region", F.substring("station", 1, 4))
    return knn_impute(g, k=5, region_col="region").select("station", "obs_date", "rain_mm")


# --- flagship on the imputed calendar (the studied step chain: impute → features → label) ---

IMPUTED_FLAGSHIP_SQL = fx.sql(WIDE_SQL, knn_sql("wide", ST).lstrip("\n"), """
ig AS (""" + long_sql("k_out", ST) + """),
feats AS (
  SELECT *, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2, lag(rain_mm, 3) OVER w AS lag3,
         avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
         avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30
  FROM ig WINDOW w AS (PARTITION BY station ORDER BY obs_date)),
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS threshold FROM ig WHERE rain_mm IS NOT NULL
        GROUP BY station),
lab AS (SELECT f.*, CAST(coalesce(f.rain_mm > t.threshold, false) AS INT) AS label
        FROM feats f LEFT JOIN thr t USING (station))""", body="""
SELECT station, count(*) AS n_rows, sum(label) AS n_pos, sum(label) * 100.0 / count(*) AS pct_pos,
       CASE WHEN sum(label) > 0 THEN (100.0 - sum(label) * 100.0 / count(*))
            / (sum(label) * 100.0 / count(*)) END AS imbalance_ratio
FROM lab WHERE rain_mm IS NOT NULL AND lag1 IS NOT NULL AND lag2 IS NOT NULL AND lag3 IS NOT NULL
  AND roll7 IS NOT NULL AND roll30 IS NOT NULL
GROUP BY station""")


@register("a21_class_balance_imputed", IMPUTED_FLAGSHIP_SQL,
          "station:s n_rows:i n_pos:i pct_pos:f imbalance_ratio:f")
def a21_class_balance_imputed(spark, sf_dir):
    """Flagship: KNN-imputed dense calendar → lags / rolling means → per-station P95
    label → complete rows → class balance of extreme days per station."""
    from stormlens.operators import clean as C
    from stormlens.operators import features as FE
    from stormlens.operators import label as L
    from stormlens.operators import profile as PR
    from stormlens.operators.impute import knn_impute
    panel = knn_impute(fx.grid(spark, sf_dir), ST, k=5).drop("imputed")
    feats = FE.add_rolling(FE.add_lags(panel, (1, 2, 3)), (7, 30))
    lab = L.label_extreme(feats)
    complete = C.drop_incomplete(lab, ["rain_mm", "lag1", "lag2", "lag3", "roll7", "roll30"])
    return PR.class_balance(complete, "label", by="station")
