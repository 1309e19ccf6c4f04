"""Registered queries: evaluation and model preparation.

Scored rows come from the model-free fixture of FIXTURES §5:
``proba = ((rid·7919) mod 1000) / 1000`` and ``label = rain_mm > 50`` on cleaned
readings, so every metric is SQL-checkable before any model exists.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlens.functions.calendar import add_calendar, parse_obs_date
from stormlens.operators import evaluate as V
from stormlens.operators import features as FE
from stormlens.operators import prep as E
from stormlens.operators.clean import clean_sentinels
from stormlens.operators.model import POISSON, bag_class_weights
from stormlens.plans import fixture as fx
from stormlens.plans.registry import register
from stormlens.session import cut_lineage

PRED_SQL = """
pred AS (
  SELECT rid, station_id AS station, CAST(substr(data_timestamp, 1, 10) AS DATE) AS obs_date,
         CAST(rv > 50 AS INT) AS label, ((rid * 7919) % 1000) / 1000e0 AS proba,
         ((rid * 104729) % 1000) / 1000e0 AS proba_b
  FROM (SELECT *, CASE WHEN rain_mm = 9999e0 THEN NULL WHEN rain_mm = 8888e0 THEN 0e0
                       ELSE rain_mm END AS rv FROM region) r
  WHERE rv IS NOT NULL)"""


def predictions(spark, sf_dir):
    r = clean_sentinels(fx.region_readings(spark, sf_dir)).filter(F.col("rain_mm").isNotNull())
    return r.select("rid", F.col("station_id").alias("station"),
                    parse_obs_date("data_timestamp").alias("obs_date"),
                    (F.col("rain_mm") > 50).cast("int").alias("label"),
                    ((F.col("rid") * 7919) % 1000 / 1000.0).alias("proba"),
                    ((F.col("rid") * 104729) % 1000 / 1000.0).alias("proba_b"))


def _conf_sql(t: float, by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return (f"SELECT {sel}count_if(label = 1 AND proba >= {t}) AS tp, count_if(label <> 1 AND proba >= {t}) AS fp, "
            f"count_if(label = 1 AND proba < {t}) AS fn, count_if(label <> 1 AND proba < {t}) AS tn FROM pred{grp}")


def _sd(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) * 1.0 / ({b}) ELSE 0e0 END"


METRICS_SQL = (f"{_sd('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_sd('tp', 'tp + fp')} AS precision, "
               f"{_sd('tp', 'tp + fn')} AS recall, "
               f"{_sd('2 * ' + _sd('tp', 'tp + fp') + ' * ' + _sd('tp', 'tp + fn'), _sd('tp', 'tp + fp') + ' + ' + _sd('tp', 'tp + fn'))} AS f1")
CONF_SPEC = "tp:i fp:i fn:i tn:i"
MET_SPEC = CONF_SPEC + " accuracy:f precision:f recall:f f1:f"


@register("v1_confusion", fx.sql(PRED_SQL, body=_conf_sql(0.5)), CONF_SPEC)
def v1_confusion(spark, sf_dir):
    return V.confusion(predictions(spark, sf_dir), 0.5)


@register("v2_metrics", fx.sql(PRED_SQL, f"c AS ({_conf_sql(0.5, 'station')})",
                               body=f"SELECT *, {METRICS_SQL} FROM c"), "station:s " + MET_SPEC)
def v2_metrics(spark, sf_dir):
    return V.binary_metrics(predictions(spark, sf_dir), 0.5, by="station")


@register("v3_class_report", fx.sql(PRED_SQL, f"c AS ({_conf_sql(0.5)})", f"""
m AS (SELECT {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1, {_sd('tn', 'tn + fn')} AS p0,
             {_sd('tn', 'tn + fp')} AS r0, tp + fn AS s1, tn + fp AS s0, tp + tn AS ok FROM c),
f AS (SELECT *, {_sd('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_sd('2 * p0 * r0', 'p0 + r0')} AS f1_0,
             s0 + s1 AS n FROM m)""", body=f"""
SELECT '0' AS class, p0 AS precision, r0 AS recall, f1_0 AS f1, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1_1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {_sd('ok', 'n')}, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', {_sd('p0 * s0 + p1 * s1', 'n')}, {_sd('r0 * s0 + r1 * s1', 'n')},
                 {_sd('f1_0 * s0 + f1_1 * s1', 'n')}, n FROM f"""),
          "class:s precision:f recall:f f1:f support:i")
def v3_class_report(spark, sf_dir):
    return V.class_report(predictions(spark, sf_dir), 0.5)


@register("v4_period_metrics", fx.sql(PRED_SQL, f"""
c AS ({_conf_sql(0.3).replace('FROM pred', "FROM pred WHERE obs_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'")})""",
                                      body=f"""
SELECT *, {METRICS_SQL}, (SELECT count(DISTINCT obs_date) FROM pred
   WHERE obs_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31') AS n_days FROM c"""),
          MET_SPEC + " n_days:i")
def v4_period_metrics(spark, sf_dir):
    return V.period_metrics(predictions(spark, sf_dir), "1998-01-01", "1999-12-31", 0.3)


SWEEP_SQL = PRED_SQL + """,
thr AS (SELECT c / 100.0 AS threshold FROM range(5, 100, 5) t(c)),
cs AS (SELECT threshold, count_if(label = 1 AND proba >= threshold) AS tp,
              count_if(label <> 1 AND proba >= threshold) AS fp,
              count_if(label = 1 AND proba < threshold) AS fn,
              count_if(label <> 1 AND proba < threshold) AS tn
       FROM thr, pred GROUP BY threshold),
sweep AS (SELECT threshold, """ + f"""{_sd('tp', 'tp + fp')} AS precision, {_sd('tp', 'tp + fn')} AS recall,
          {_sd('2 * ' + _sd('tp', 'tp + fp') + ' * ' + _sd('tp', 'tp + fn'), _sd('tp', 'tp + fp') + ' + ' + _sd('tp', 'tp + fn'))} AS f1,
          tp, fp, fn, tn, tp + fp AS total_alert FROM cs)"""
SWEEP_SPEC = "threshold:f precision:f recall:f f1:f tp:i fp:i fn:i tn:i total_alert:i"


@register("v5_threshold_sweep", fx.sql(SWEEP_SQL, body="SELECT * FROM sweep"), SWEEP_SPEC)
def v5_threshold_sweep(spark, sf_dir):
    return V.threshold_sweep(predictions(spark, sf_dir))


@register("v6_pick_threshold", fx.sql(SWEEP_SQL, body="""
SELECT 'max_f1' AS rule, * FROM (SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1)
UNION ALL SELECT 'recall50_max_precision', * FROM (SELECT * FROM sweep WHERE recall >= 0.5
                                                   ORDER BY precision DESC, threshold LIMIT 1)
UNION ALL SELECT 'recall50_last', * FROM (SELECT * FROM sweep WHERE recall >= 0.5
                                          ORDER BY threshold DESC LIMIT 1)
UNION ALL SELECT 'recall70_min_fp', * FROM (SELECT * FROM sweep WHERE recall >= 0.7
                                            ORDER BY fp, threshold LIMIT 1)
UNION ALL SELECT 'default', * FROM sweep WHERE round(threshold * 100) = 50"""), "rule:s " + SWEEP_SPEC)
def v6_pick_threshold(spark, sf_dir):
    # The sweep is a 19-row result read by five rules: compute it once.
    sweep = cut_lineage(V.threshold_sweep(predictions(spark, sf_dir)))
    out = None
    for rule in V.RULES:
        r = V.pick_threshold(sweep, rule).select(F.lit(rule).alias("rule"), *sweep.columns)
        out = r if out is None else out.unionByName(r)
    return out


MODELS_SQL = PRED_SQL + f""",
ca AS ({_conf_sql(0.5)}),
cb AS ({_conf_sql(0.5).replace('proba', 'proba_b')}),
mets AS (SELECT 'hash_a' AS model, *, {METRICS_SQL} FROM ca
         UNION ALL SELECT 'hash_b' AS model, *, {METRICS_SQL} FROM cb)"""


def _model_metrics(spark, sf_dir):
    p = predictions(spark, sf_dir)
    a = V.binary_metrics(p, 0.5).withColumn("model", F.lit("hash_a"))
    b = V.binary_metrics(p.withColumn("proba", F.col("proba_b")), 0.5).withColumn("model", F.lit("hash_b"))
    return a.unionByName(b)


@register("v7_compare_models", fx.sql(MODELS_SQL, body="""
SELECT m.*, m.f1 - b.f1 AS delta_f1, m.recall - b.recall AS delta_recall
FROM mets m, (SELECT * FROM mets WHERE model = 'hash_a') b"""),
          "model:s " + MET_SPEC + " delta_f1:f delta_recall:f")
def v7_compare_models(spark, sf_dir):
    return V.compare_models(_model_metrics(spark, sf_dir), "hash_a")


@register("o6_best_model", fx.sql(MODELS_SQL, body="SELECT * FROM mets ORDER BY f1 DESC, model LIMIT 1"),
          "model:s " + MET_SPEC)
def o6_best_model(spark, sf_dir):
    return V.best_model(_model_metrics(spark, sf_dir))


@register("o5_arg_extrema", fx.sql(SWEEP_SQL, body="""
SELECT (SELECT threshold FROM sweep ORDER BY f1 DESC, threshold LIMIT 1) AS best_f1_threshold,
       (SELECT threshold FROM sweep WHERE recall >= 0.7 ORDER BY fp, threshold LIMIT 1) AS min_fp_threshold"""),
          "best_f1_threshold:f min_fp_threshold:f")
def o5_arg_extrema(spark, sf_dir):
    """Arg-max / arg-min over the sweep with deterministic ties (max_by / min_by)."""
    s = V.threshold_sweep(predictions(spark, sf_dir))
    a = s.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("best_f1_threshold"))
    b = s.filter(F.col("recall") >= 0.7).agg(
        F.min_by("threshold", F.struct(F.col("fp"), F.col("threshold"))).alias("min_fp_threshold"))
    return a.withColumn("min_fp_threshold", b.scalar())


LR7_SQL = """
lr AS (SELECT station, obs_date, rain_mm, lag(rain_mm, 1) OVER w AS lag1,
              avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7
       FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))"""


def _lr7(spark, sf_dir):
    return FE.add_rolling(FE.add_lags(fx.grid(spark, sf_dir), (1,)), (7,))


@register("v8_rmse", fx.sql(LR7_SQL, body="""
SELECT station, sqrt(avg(pow(roll7 - rain_mm, 2))) AS rmse, count(*) AS n FROM lr
WHERE rain_mm IS NOT NULL AND roll7 IS NOT NULL GROUP BY station"""), "station:s rmse:f n:i")
def v8_rmse(spark, sf_dir):
    """V8: RMSE of the 7-day mean as a naive estimate of the day's rain."""
    lr = _lr7(spark, sf_dir).dropna(subset=["rain_mm", "roll7"])
    return V.rmse(lr, "rain_mm", "roll7", by="station")


# --- scaling ---------------------------------------------------------------------------

TRAIN_END = "2000-01-01"
SCALE_COLS = ("lag1", "roll7")


def _scale_sql(kind: str) -> str:
    if kind == "robust":
        p = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}"
                      for c in SCALE_COLS)
    elif kind == "minmax":
        p = ", ".join(f"min({c}) AS c_{c}, max({c}) - min({c}) AS s_{c}" for c in SCALE_COLS)
    else:
        p = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS)
    cols = ", ".join(f"({c} - c_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}"
                     for c in SCALE_COLS)
    return fx.sql(LR7_SQL, f"prm AS (SELECT {p} FROM lr WHERE obs_date < DATE '{TRAIN_END}')",
                  body=f"SELECT station, obs_date, {cols} FROM lr, prm")


SCALED_SPEC = "station:s obs_date:d lag1:f roll7:f"


def _scaled(spark, sf_dir, fn):
    lr = _lr7(spark, sf_dir)
    train = lr.filter(F.col("obs_date") < F.lit(TRAIN_END).cast("date"))
    return fn(train, lr, list(SCALE_COLS)).select("station", "obs_date", *SCALE_COLS)


@register("e1_robust_scale", _scale_sql("robust"), SCALED_SPEC)
def e1_robust_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, E.robust_scale)


@register("e2_minmax", _scale_sql("minmax"), SCALED_SPEC)
def e2_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, E.minmax_scale)


@register("e3_standard", _scale_sql("standard"), SCALED_SPEC)
def e3_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, E.standard_scale)


@register("e4_scaler_sensitivity", fx.sql(LR7_SQL, """
r AS (SELECT quantile_cont(lag1, 0.5) AS m, quantile_cont(lag1, 0.75) - quantile_cont(lag1, 0.25) AS s,
             min(lag1) AS mn, max(lag1) AS mx, avg(lag1) AS mu, stddev_pop(lag1) AS sd FROM lr)""", body="""
SELECT 'robust' AS method, (mx - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS lag1 FROM r
UNION ALL SELECT 'minmax', (mx - mn) / CASE WHEN mx = mn THEN 1 ELSE mx - mn END FROM r
UNION ALL SELECT 'standard', (mx - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END FROM r"""),
          "method:s lag1:f")
def e4_scaler_sensitivity(spark, sf_dir):
    return E.scaler_sensitivity(_lr7(spark, sf_dir), ["lag1"])


# --- encoding and splitting ---------------------------------------------------------------

SEASONS = ("Hujan_Intensif", "Kemarau", "Peralihan_1", "Peralihan_2")


@register("e5_one_hot", fx.sql(body=", ".join(
    ["SELECT station, obs_date"]
    + [f"CAST(station = '{s}' AS INT) AS \"STASIUN_{s}\"" for s in fx.STATIONS]
    + [f"""CAST((CASE WHEN month(obs_date) IN (12, 1, 2, 3) THEN 'Hujan_Intensif'
     WHEN month(obs_date) IN (4, 5) THEN 'Peralihan_1' WHEN month(obs_date) IN (6, 7, 8, 9) THEN 'Kemarau'
     ELSE 'Peralihan_2' END) = '{m}' AS INT) AS "Musim_{m}\"""" for m in SEASONS]) + " FROM grid"),
    "station:s obs_date:d " + " ".join(f"STASIUN_{s}:i" for s in fx.STATIONS) + " "
    + " ".join(f"Musim_{m}:i" for m in SEASONS))
def e5_one_hot(spark, sf_dir):
    g = add_calendar(fx.grid(spark, sf_dir)).select("station", "obs_date", "musim")
    out = E.one_hot(g, ["station", "musim"], levels={"musim": SEASONS},
                    prefix={"station": "STASIUN", "musim": "Musim"})
    return out.drop("musim")


FEAT_LABEL_SQL = """
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS t FROM grid GROUP BY station),
lab AS (SELECT g.station, g.obs_date, CAST(coalesce(g.rain_mm > thr.t, false) AS INT) AS label
        FROM grid g JOIN thr USING (station)),
dd AS (SELECT DISTINCT obs_date FROM lab),
rk AS (SELECT obs_date, row_number() OVER (ORDER BY obs_date) AS r, count(*) OVER () AS n FROM dd)"""


def _labelled(spark, sf_dir):
    from stormlens.operators.label import label_extreme
    return label_extreme(fx.grid(spark, sf_dir)).select("station", "obs_date", "label")


@register("e6_date_split", fx.sql(FEAT_LABEL_SQL, """
cut AS (SELECT obs_date AS cut_date FROM rk WHERE r = CAST(floor(n * 0.8) AS BIGINT) + 1)""", body="""
SELECT CASE WHEN obs_date < cut_date THEN 'train' ELSE 'test' END AS split, cut_date,
       count(*) AS n_rows, sum(label) AS n_pos FROM lab, cut GROUP BY 1, 2"""),
          "split:s cut_date:d n_rows:i n_pos:i")
def e6_date_split(spark, sf_dir):
    s = E.date_split(_labelled(spark, sf_dir))
    return s.groupBy("split", "cut_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_pos"))


@register("e7_class_weights", fx.sql(FEAT_LABEL_SQL, """
cc AS (SELECT label, count(*) AS nc FROM lab GROUP BY label),
tt AS (SELECT sum(nc) AS n, sum(CASE WHEN label = 1 THEN nc END) AS pos,
              sum(CASE WHEN label <> 1 THEN nc END) AS neg FROM cc)""", body="""
SELECT label, nc AS n_rows, n / (2.0 * nc) AS weight_balanced,
       CASE WHEN label = 1 THEN neg * 1.0 / pos ELSE 1.0 END AS weight_ratio FROM cc, tt"""),
          "label:i n_rows:i weight_balanced:f weight_ratio:f")
def e7_class_weights(spark, sf_dir):
    lab = _labelled(spark, sf_dir)
    b = E.class_weights(lab, mode="balanced", out="weight_balanced")
    r = E.class_weights(b, mode="ratio", out="weight_ratio")
    return r.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.first("weight_balanced").alias("weight_balanced"),
                                  F.first("weight_ratio").alias("weight_ratio"))


@register("m2_bag_weights", fx.sql(FEAT_LABEL_SQL, f"""
drawn AS (SELECT b AS bag, label, len(list_filter([{", ".join(f"CAST({c} AS DOUBLE)" for c in POISSON)}], lambda c: c <= u)) AS d
          FROM (SELECT b, label, CAST('0x' || substr(md5(station || '|' || CAST(obs_date AS VARCHAR) || ':' || b), 1, 8) AS BIGINT) / 4294967296e0 AS u FROM lab, range(20) r(b))),
bagn AS (SELECT bag, label, sum(d) AS n_drawn FROM drawn GROUP BY bag, label)""", body="""
SELECT bag, label, n_drawn, sum(n_drawn) OVER (PARTITION BY bag) / (2e0 * n_drawn) AS class_weight FROM bagn"""),
          "bag:i label:i n_drawn:i class_weight:f")
def m2_bag_weights(spark, sf_dir):
    """M2 with ``balanced_subsample``: draws and class weights of 20 bags."""
    key = F.concat_ws("|", "station", F.col("obs_date").cast("string"))
    return bag_class_weights(_labelled(spark, sf_dir), key, 20)


@register("e8_time_folds", fx.sql(FEAT_LABEL_SQL, """
fd AS (SELECT obs_date, CASE WHEN r - 1 >= n - floor(n / 6) * 5 THEN floor((r - 1 - (n - floor(n / 6) * 5))
          / floor(n / 6)) ELSE -1 END AS fold FROM rk)""", body="""
SELECT l.station, l.obs_date, l.label, CAST(fold AS INT) AS fold FROM lab l JOIN fd USING (obs_date)"""),
          "station:s obs_date:d label:i fold:i")
def e8_time_folds(spark, sf_dir):
    return E.time_folds(_labelled(spark, sf_dir), 5).select("station", "obs_date", "label", "fold")


@register("e9_stratified_folds", fx.sql(PRED_SQL, """
rk AS (SELECT rid, label, row_number() OVER (PARTITION BY label ORDER BY (rid * 7919 + 3) % 10007, rid) AS r FROM pred)""",
                                       body="SELECT rid, label, (r - 1) % 5 AS fold FROM rk"),
          "rid:i label:i fold:i")
def e9_stratified_folds(spark, sf_dir):
    return E.stratified_folds(predictions(spark, sf_dir), "rid", "label", k=5, seed=3).select("rid", "label", "fold")


@register("e11_hide_mask", fx.sql(PRED_SQL, """
rk AS (SELECT rid, proba, row_number() OVER (ORDER BY (rid * 7919 + 101) % 10007, rid) AS r,
              count(*) OVER () AS n FROM pred)""", body="""
SELECT rid, proba, CAST(r <= floor(n * 0.1) AS INT) AS hide_proba FROM rk"""), "rid:i proba:f hide_proba:i")
def e11_hide_mask(spark, sf_dir):
    return E.hide_mask(predictions(spark, sf_dir), "rid", ["proba"], 0.1).select("rid", "proba", "hide_proba")
