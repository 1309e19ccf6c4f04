"""Registered queries: modelling (M1-M11, E10, S6, S7) and forecasts needing a fit
(P2, P5).

The modelling panel follows the studied trainer: dense calendar → lags / rolling
means / neighbour means of the target stations → per-station P95 label → complete
rows → one-hot station → 80/20 date split → robust scaling fitted on the training
dates → class weights. Model fits have no SQL equivalent: these entries are
checked by rows and by the property tests in ``tests/test_properties.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlens.operators import attribution as AT
from stormlens.operators import evaluate as V
from stormlens.operators import forecast as FC
from stormlens.operators import model as M
from stormlens.operators import prep as E
from stormlens.operators.clean import drop_incomplete
from stormlens.operators.features import build_features
from stormlens.operators.label import label_extreme
from stormlens.operators.resample import smote
from stormlens.operators.seasonal_ar import seasonal_ar_forecast
from stormlens.plans import fixture as fx
from stormlens.plans.eval_queries import FEAT_LABEL_SQL
from stormlens.plans.forecast_queries import MONTHLY_SQL, next_month
from stormlens.plans.registry import register
from stormlens.session import cut_lineage, ensure_checkpoint_dir

NUMERIC = ["bulan", "hari_tahun", "hari_minggu", "lag1", "lag2", "lag3", "roll7", "roll30",
           "nbr_lag1_avg", "nbr_roll7_avg"]
ONE_HOT = [f"STASIUN_{s}" for s in fx.TARGETS]
FEATURES = NUMERIC + ONE_HOT
SMOTE_FEATURES = ["lag1", "roll7", "roll30", "nbr_lag1_avg", "nbr_roll7_avg"]


def imputed_grid(spark, sf_dir):
    """The dense calendar with gaps filled by KNN (as the trainer does before any feature)."""
    from stormlens.operators.impute import knn_impute
    return _memo(("imputed", _state(spark, sf_dir)), lambda: cut_lineage(
        knn_impute(fx.grid(spark, sf_dir), fx.STATIONS).drop("imputed")))


def labelled_panel(spark, sf_dir):
    g = imputed_grid(spark, sf_dir)
    feats = build_features(g, targets=fx.TARGETS, members=fx.TARGETS, rolls=(7, 30))
    lab = label_extreme(feats)
    lab = drop_incomplete(lab, ["rain_mm"] + NUMERIC)
    lab = E.one_hot(lab, ["station"], levels={"station": fx.TARGETS}, prefix={"station": "STASIUN"})
    return lab.withColumn("rid", F.xxhash64("station", "obs_date"))


# Fitted artifacts are deterministic functions of (session, data folder): the
# checkpointed frames and the boosted model are built once per session and reused
# by every query that needs them (as one training job would).
_MEMO: dict = {}


def _memo(key, build):
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def _state(spark, sf_dir) -> tuple:
    """What the readings' files are now: new data in the same folder is a new key."""
    jvm, found = spark.sparkContext._jvm, []
    for f in fx.readings(spark, sf_dir).inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(f)
        s = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append((f, s.getLen(), s.getModificationTime()))
    return (_app(spark), sf_dir, *sorted(found))


def clear_memo() -> None:
    _MEMO.clear()


def _app(spark) -> str:
    return spark.sparkContext.applicationId


def model_frames(spark, sf_dir):
    return _memo(("frames", _state(spark, sf_dir)), lambda: _model_frames(spark, sf_dir))


def trained_gbt(spark, sf_dir):
    """(train, test, fitted boosted model) of the standard frames, fitted once."""
    def build():
        train, test = model_frames(spark, sf_dir)
        return train, test, _gbt(train)
    return _memo(("gbt", _state(spark, sf_dir)), build)


def _model_frames(spark, sf_dir):
    """(train, test) scaled, weighted and materialised once (several fits read them)."""
    lab = E.date_split(labelled_panel(spark, sf_dir))
    lab = cut_lineage(lab)
    train, test = lab.filter("split = 'train'"), lab.filter("split = 'test'")
    params = E.fit_robust(train, NUMERIC)
    train, test = E.apply_scaler(train, params), E.apply_scaler(test, params)
    train = E.class_weights(E.class_weights(train, mode="balanced", out="weight"), mode="ratio", out="weight_ratio")
    return cut_lineage(train), cut_lineage(test)


def _gbt(train):
    return M.fit_gbt(train, FEATURES, weight="weight_ratio", max_iter=100, max_depth=3, step=0.1)


@register("m1_logistic")
def m1_logistic(spark, sf_dir):
    """M1: balanced logistic regression - coefficient table."""
    train, _ = model_frames(spark, sf_dir)
    return M.coefficient_table(M.fit_logistic(train, FEATURES), FEATURES)


@register("m1_logistic_optimum", "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*FEATURES, "(intercept)"]) + "]) AS feature, TRUE AS at_optimum", "feature:s at_optimum:i")
def m1_logistic_optimum(spark, sf_dir):
    """M1: the fitted model is the optimum of its objective - every partial derivative, taken anew over the
    training rows, is below 1e-5."""
    train, _ = model_frames(spark, sf_dir)
    grad = M.logistic_gradient(M.fit_logistic(train, FEATURES), train, FEATURES)
    return grad.select("feature", (F.abs("gradient") < 1e-5).alias("at_optimum"))


@register("m2_balanced_subsample")
def m2_balanced_subsample(spark, sf_dir):
    """M2 with class weights per bag: 20 trees on Poisson bags, votes averaged - metrics at .5."""
    train, test = model_frames(spark, sf_dir)
    models = M.fit_balanced_forest(train, FEATURES, F.col("rid").cast("string"))
    return V.binary_metrics(M.score_votes(models, test), 0.5).withColumn("model", F.lit("balanced_subsample"))


@register("m2_forest")
def m2_forest(spark, sf_dir):
    """M2: balanced random forest (100 trees, depth 5, leaf 10) - metrics at .5."""
    train, test = model_frames(spark, sf_dir)
    model = M.fit_forest(train, FEATURES)
    return V.binary_metrics(M.score(model, test), 0.5).withColumn("model", F.lit("forest"))


@register("m3_gbt")
def m3_gbt(spark, sf_dir):
    """M3 + V2: boosted trees, test metrics at thresholds .5 and .4."""
    train, test, model = trained_gbt(spark, sf_dir)
    scored = cut_lineage(M.score(model, test))
    return V.binary_metrics(scored, 0.5).withColumn("threshold", F.lit(0.5)).unionByName(
        V.binary_metrics(scored, 0.4).withColumn("threshold", F.lit(0.4)))


@register("m4_grid_search")
def m4_grid_search(spark, sf_dir):
    """M4: forest grid × 3 expanding time folds on the training dates, scored by recall."""
    train, _ = model_frames(spark, sf_dir)
    folded = cut_lineage(E.time_folds(train, n_splits=3))
    folds = [E.fold_train_test(folded, i) for i in range(3)]
    grid = {"num_trees": [20, 50], "max_depth": [3, 5]}
    results, best = M.grid_search(folds, lambda tr, **kw: M.fit_forest(tr, FEATURES, **kw), grid, "recall")
    rows = [(str(sorted(p.items())), float(s), int(p == best)) for p, s in results]
    return spark.createDataFrame(rows, "params string, mean_recall double, best int")


@register("m5_predictions")
def m5_predictions(spark, sf_dir):
    """M5 + S7: class probability on the test dates, exported as the predictions table."""
    train, test, model = trained_gbt(spark, sf_dir)
    return M.predictions_table(M.score(model, test))


@register("m6_production")
def m6_production(spark, sf_dir):
    """M6: production fit on every row (no split) - importance table."""
    train, test = model_frames(spark, sf_dir)
    full = train.unionByName(test.withColumn("weight", F.lit(1.0)).withColumn("weight_ratio", F.lit(1.0)),
                             allowMissingColumns=True)
    full = E.class_weights(full.drop("weight_ratio"), mode="ratio", out="weight_ratio")
    return M.importance_table(_gbt(full), FEATURES)


@register("m7_importance")
def m7_importance(spark, sf_dir):
    _, _, model = trained_gbt(spark, sf_dir)
    return M.importance_table(model, FEATURES)


@register("s6_save_load")
def s6_save_load(spark, sf_dir):
    """Persist the fitted pipeline in the shared folder, load it, score again;
    the reloaded model must give the same probabilities."""
    import os
    import uuid
    train, test, model = trained_gbt(spark, sf_dir)
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    M.save_model(model, path)
    again = M.load_model(path)
    a = M.score(model, test).select("rid", F.col("proba").alias("p1"))
    b = M.score(again, test).select("rid", F.col("proba").alias("p2"))
    return a.join(b, "rid").agg(F.count(F.lit(1)).alias("n_rows"),
                                F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))


@register("s6_saved_equals_fitted", fx.sql(FEAT_LABEL_SQL, """
sf AS (SELECT station, obs_date, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2 FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))""", body="""
SELECT count(*) AS n_rows, 0 AS n_different FROM sf JOIN lab USING (station, obs_date) WHERE lag1 IS NOT NULL AND lag2 IS NOT NULL"""), "n_rows:i n_different:i")
def s6_saved_equals_fitted(spark, sf_dir):
    """A model read from its folder gives the probability of the fitted one on every row."""
    import os
    import uuid

    from stormlens.operators.features import add_lags
    rows = label_extreme(add_lags(fx.grid(spark, sf_dir), (1, 2))).dropna(subset=["lag1", "lag2"])
    rows = cut_lineage(E.class_weights(rows.select("station", "obs_date", "lag1", "lag2", "label"), out="weight"))
    model = M.fit_logistic(rows, ["lag1", "lag2"], max_iter=20)
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    M.save_model(model, path)
    keys = ["station", "obs_date"]
    a = M.score(model, rows).select(*keys, F.col("proba").alias("p1"))
    b = M.score(M.load_model(path), rows).select(*keys, F.col("proba").alias("p2"))
    return a.join(b, keys, "full").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("p1").eqNullSafe(F.col("p2"))).alias("n_different"))


def _smote_train(spark, sf_dir):
    """Training rows of the observed (not imputed) panel - the SQL oracle rebuilds them."""
    g = fx.grid(spark, sf_dir)
    feats = build_features(g, targets=fx.TARGETS, members=fx.TARGETS, rolls=(7, 30))
    lab = drop_incomplete(label_extreme(feats), ["rain_mm"] + NUMERIC)
    lab = lab.withColumn("rid", F.datediff("obs_date", F.lit("1970-01-01")) * 10
                         + F.substring("station", 5, 1).cast("int"))
    return E.date_split(lab).filter("split = 'train'").select("rid", "label", *SMOTE_FEATURES)


SMOTE_SQL = """
thr AS (SELECT station, quantile_cont(rain_mm, 0.95) AS t FROM grid WHERE rain_mm IS NOT NULL GROUP BY station),
ft AS (SELECT station, obs_date, rain_mm, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2,
              lag(rain_mm, 3) OVER w AS lag3,
              avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7,
              avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30
       FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date)),
nb AS (SELECT a.station, a.obs_date, avg(b.lag1) AS nbr_lag1_avg, avg(b.roll7) AS nbr_roll7_avg
       FROM ft a LEFT JOIN ft b ON b.obs_date = a.obs_date AND b.station <> a.station
            AND b.station IN ('137110a', '137120a', '137130a')
       WHERE a.station IN ('137110a', '137120a', '137130a') GROUP BY a.station, a.obs_date),
lab AS (SELECT f.*, n.nbr_lag1_avg, n.nbr_roll7_avg, CAST(coalesce(f.rain_mm > thr.t, false) AS INT) AS label,
               CAST(f.obs_date - DATE '1970-01-01' AS BIGINT) * 10 + CAST(substr(f.station, 5, 1) AS INT) AS rid
        FROM ft f JOIN nb n USING (station, obs_date) JOIN thr USING (station)
        WHERE f.rain_mm IS NOT NULL AND lag1 IS NOT NULL AND lag2 IS NOT NULL AND lag3 IS NOT NULL
          AND roll7 IS NOT NULL AND roll30 IS NOT NULL AND nbr_lag1_avg IS NOT NULL AND nbr_roll7_avg IS NOT NULL),
dd AS (SELECT obs_date, row_number() OVER (ORDER BY obs_date) AS r, count(*) OVER () AS n
       FROM (SELECT DISTINCT obs_date FROM lab)),
cut AS (SELECT obs_date AS cut_date FROM dd WHERE r = CAST(floor(n * 0.8) AS BIGINT) + 1),
tr AS (SELECT lab.* FROM lab, cut WHERE obs_date < cut_date),
mi AS (SELECT rid, lag1, roll7, roll30, nbr_lag1_avg, nbr_roll7_avg,
              row_number() OVER (ORDER BY rid) - 1 AS idx FROM tr WHERE label = 1),
cnt AS (SELECT count_if(label = 1) AS n_min, count_if(label <> 1) AS n_maj FROM tr),
pr AS (SELECT a.rid AS lid, b.rid AS rid,
              sqrt((a.lag1 - b.lag1) * (a.lag1 - b.lag1) + (a.roll7 - b.roll7) * (a.roll7 - b.roll7)
                   + (a.roll30 - b.roll30) * (a.roll30 - b.roll30)
                   + (a.nbr_lag1_avg - b.nbr_lag1_avg) * (a.nbr_lag1_avg - b.nbr_lag1_avg)
                   + (a.nbr_roll7_avg - b.nbr_roll7_avg) * (a.nbr_roll7_avg - b.nbr_roll7_avg)) AS dist
       FROM mi a, mi b WHERE a.rid <> b.rid),
rk AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY dist, rid) AS rank FROM pr),
syn AS (SELECT i, i % n_min AS idx, CAST((i // n_min) % 5 + 1 AS BIGINT) AS rank,
               ((i * 7919) % 1000) / 1000e0 AS lam FROM cnt, range(0, CAST((SELECT n_maj - n_min FROM cnt) AS BIGINT)) t(i))"""


@register("e10_smote", fx.sql(SMOTE_SQL, body="""
SELECT s.i AS _syn_index, b.lag1 + s.lam * (o.lag1 - b.lag1) AS lag1, b.roll7 + s.lam * (o.roll7 - b.roll7) AS roll7,
       b.roll30 + s.lam * (o.roll30 - b.roll30) AS roll30,
       b.nbr_lag1_avg + s.lam * (o.nbr_lag1_avg - b.nbr_lag1_avg) AS nbr_lag1_avg,
       b.nbr_roll7_avg + s.lam * (o.nbr_roll7_avg - b.nbr_roll7_avg) AS nbr_roll7_avg
FROM syn s JOIN mi b ON b.idx = s.idx JOIN rk ON rk.lid = b.rid AND rk.rank = s.rank
JOIN mi o ON o.rid = rk.rid"""),
          "_syn_index:i lag1:f roll7:f roll30:f nbr_lag1_avg:f nbr_roll7_avg:f")
def e10_smote(spark, sf_dir):
    """Deterministic SMOTE to class parity on the training dates; the
    synthetic rows (the oracle rebuilds them by brute force)."""
    out = smote(_smote_train(spark, sf_dir), SMOTE_FEATURES, "rid", k=5)
    return out.filter("synthetic = 1").select("_syn_index", *SMOTE_FEATURES)


@register("e10_smote_balance", fx.sql(SMOTE_SQL, body="""
SELECT label, CASE WHEN label = 1 THEN (SELECT n_maj FROM cnt) ELSE count(*) END AS n_rows,
       CASE WHEN label = 1 THEN (SELECT n_maj - n_min FROM cnt) ELSE 0 END AS n_synthetic
FROM tr GROUP BY label"""), "label:i n_rows:i n_synthetic:i")
def e10_smote_balance(spark, sf_dir):
    """Class counts before / after over-sampling (parity after)."""
    out = smote(_smote_train(spark, sf_dir), SMOTE_FEATURES, "rid", k=5)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("synthetic").alias("n_synthetic"))


def _attr(spark, sf_dir):
    def build():
        train, test, model = trained_gbt(spark, sf_dir)
        return cut_lineage(AT.tree_attribution(model, test, FEATURES))
    return _memo(("attr", _state(spark, sf_dir)), build)


@register("m8_attribution")
def m8_attribution(spark, sf_dir):
    """M8: per-row attribution on the test rows, with the additivity residual."""
    a = _attr(spark, sf_dir)
    resid = F.col("base") + sum(F.col(f"phi_{c}") for c in FEATURES) - F.col("margin")
    return a.withColumn("additivity_residual", resid)


@register("m9_attribution_summary")
def m9_attribution_summary(spark, sf_dir):
    return AT.attribution_summary(_attr(spark, sf_dir), FEATURES)


@register("m10_attribution_direction")
def m10_attribution_direction(spark, sf_dir):
    return AT.attribution_direction(_attr(spark, sf_dir), FEATURES)


# M9-M11 on an attribution table that SQL can build as well: linear parts of a made-up score.
TABLE_FEATURES = ["lag1", "lag2", "roll7"]
ATTR_SQL = """
attr AS (SELECT station, obs_date, lag1, lag2, roll7, 0.04 * lag1 - 0.1 AS phi_lag1, -0.02 * lag2 AS phi_lag2,
              0.01 * roll7 * roll7 - 0.3 * lag1 AS phi_roll7
       FROM (SELECT *, lag(rain_mm, 1) OVER w AS lag1, lag(rain_mm, 2) OVER w AS lag2,
                    avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7
             FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date)) q
       WHERE lag1 IS NOT NULL AND lag2 IS NOT NULL AND roll7 IS NOT NULL),
al AS (SELECT 'lag1' AS feature, lag1 AS x, phi_lag1 AS phi FROM attr UNION ALL SELECT 'lag2', lag2, phi_lag2 FROM attr
       UNION ALL SELECT 'roll7', roll7, phi_roll7 FROM attr),
sm AS (SELECT feature, avg(abs(phi)) AS mean_abs FROM al GROUP BY feature),
share AS (SELECT feature, mean_abs, mean_abs * 100.0 / (SELECT sum(mean_abs) FROM sm) AS share_pct FROM sm),
less AS (SELECT feature, mean_abs * 100.0 / (SELECT sum(mean_abs) FROM sm WHERE feature <> 'lag2') AS share_pct
         FROM sm WHERE feature <> 'lag2')"""


def _attr_table(spark, sf_dir):
    from stormlens.operators.features import add_lags, add_rolling
    f = add_rolling(add_lags(fx.grid(spark, sf_dir), (1, 2)), (7,)).dropna(subset=TABLE_FEATURES)
    return f.select("station", "obs_date", *TABLE_FEATURES, (F.col("lag1") * 0.04 - 0.1).alias("phi_lag1"),
                    (F.col("lag2") * -0.02).alias("phi_lag2"),
                    (F.col("roll7") * F.col("roll7") * 0.01 - F.col("lag1") * 0.3).alias("phi_roll7"))


# --- M8 on fixed trees: two of depth 7, their nodes by rule (SQL states the same rules) ---------------

DEEP = ["lag1", "lag2", "lag3", "lag7", "roll7", "roll30", "month", "day"]
DEEP_WEIGHTS = [1.0, 0.1]


def deep_tree(t: int) -> dict:
    """Nodes 1 to 255 of a heap; node n has the children 2n and 2n + 1."""
    cover = {n: 1 + (13 * n + 7 * t) % 19 for n in range(128, 256)}
    for n in range(127, 0, -1):
        cover[n] = cover[2 * n] + cover[2 * n + 1]
    nodes = {}
    for n in range(1, 256):
        f = (5 * n + 3 * t + n // 4) % 8
        thr = {6: n % 12 + 0.5, 7: 7 * n % 30 + 0.5}.get(f, (37 * n + 11 * t) % 50 / 2.0)
        nodes[n - 1] = (0.0, cover[n], 2 * n - 1, 2 * n, f, thr) if n < 128 else (((29 * n + 17 * t) % 41 - 20) / 10.0, cover[n], -1, -1, -1, 0.0)
    return nodes


DEEP_SQL = f"""
deep AS MATERIALIZED (SELECT station, obs_date, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DEEP)}, [{", ".join(f"CAST({c} AS DOUBLE)" for c in DEEP)}] AS x
  FROM (SELECT station, obs_date, month(obs_date) AS month, day(obs_date) AS day, {", ".join(f"lag(rain_mm, {k}) OVER w AS lag{k}" for k in (1, 2, 3, 7))},
          avg(rain_mm) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7, avg(rain_mm) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS roll30
        FROM grid WINDOW w AS (PARTITION BY station ORDER BY obs_date))
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in DEEP)}),
leafs AS (SELECT t, l, 1 + (13 * l + 7 * t) % 19 AS cover, ((29 * l + 17 * t) % 41 - 20) / 10e0 AS v FROM range(128, 256) a(l), range(2) b(t)),
cov AS MATERIALIZED (SELECT t, l >> s AS n, sum(cover) AS cover FROM leafs, range(8) c(s) GROUP BY t, n),
turn AS (SELECT t, l, l >> s AS child, l >> (s + 1) AS n FROM leafs, range(7) c(s)),
turnf AS MATERIALIZED (SELECT r.t, r.l, (5 * r.n + 3 * r.t + r.n // 4) % 8 AS f, r.child % 2 = 0 AS is_left, c.cover / p.cover AS frac,
    CASE (5 * r.n + 3 * r.t + r.n // 4) % 8 WHEN 6 THEN r.n % 12 + 0.5e0 WHEN 7 THEN 7 * r.n % 30 + 0.5e0 ELSE (37 * r.n + 11 * r.t) % 50 / 2e0 END AS thr
  FROM turn r JOIN cov c ON c.t = r.t AND c.n = r.child JOIN cov p ON p.t = r.t AND p.n = r.n),
fz AS MATERIALIZED (SELECT t, l, f, product(frac) AS z, row_number() OVER (PARTITION BY t, l ORDER BY f) - 1 AS pos, count(*) OVER (PARTITION BY t, l) AS m FROM turnf GROUP BY t, l, f),
sub AS MATERIALIZED (SELECT t, l, any_value(m) AS m, s, product(CASE WHEN (s >> pos) & 1 = 0 THEN z ELSE 1e0 END) AS rest FROM fz, range(128) r(s) WHERE s < (1 << m) GROUP BY t, l, s),
seen AS MATERIALIZED (SELECT station, obs_date, t, l, CAST(sum(CASE WHEN o THEN 1 << pos ELSE 0 END) AS BIGINT) AS mask
  FROM (SELECT station, obs_date, r.t, r.l, any_value(z.pos) AS pos, bool_and((x[r.f + 1] <= thr) = is_left) AS o
        FROM deep, turnf r JOIN fz z ON z.t = r.t AND z.l = r.l AND z.f = r.f GROUP BY station, obs_date, r.t, r.l, r.f)
  GROUP BY station, obs_date, t, l),
masks AS MATERIALIZED (SELECT DISTINCT t, l, mask FROM seen),
part AS MATERIALIZED (SELECT k.t, k.l, k.mask, f.f,
    any_value((k.mask >> pos) & 1) - any_value(z) AS gain,
    sum(s.rest / z * (gamma(bit_count(s.s) + 1) * gamma(f.m - bit_count(s.s)) / gamma(f.m + 1))) AS weight
  FROM masks k JOIN fz f ON f.t = k.t AND f.l = k.l JOIN sub s ON s.t = k.t AND s.l = k.l AND s.s & ~k.mask = 0 AND (s.s >> pos) & 1 = 0
  GROUP BY k.t, k.l, k.mask, f.f),
phis AS (SELECT station, obs_date, f, sum(CASE WHEN e.t = 0 THEN 1e0 ELSE 0.1e0 END * v * gain * weight) AS phi
  FROM seen e JOIN part p ON p.t = e.t AND p.l = e.l AND p.mask = e.mask JOIN leafs ON leafs.t = e.t AND leafs.l = e.l GROUP BY station, obs_date, f),
tops AS (SELECT station, obs_date, sum(CASE WHEN e.t = 0 THEN 1e0 ELSE 0.1e0 END * v * CASE WHEN mask = (1 << m) - 1 THEN 1 ELSE 0 END) AS margin,
    sum(CASE WHEN e.t = 0 THEN 1e0 ELSE 0.1e0 END * v * rest) AS base
  FROM seen e JOIN sub ON sub.t = e.t AND sub.l = e.l AND sub.s = 0 JOIN leafs ON leafs.t = e.t AND leafs.l = e.l GROUP BY station, obs_date)"""


def _deep_scored(spark, sf_dir):
    from stormlens.operators.features import add_lags, add_rolling
    f = add_rolling(add_lags(fx.grid(spark, sf_dir), (1, 2, 3, 7)), (7, 30)) \
        .withColumns({"month": F.month("obs_date").cast("double"), "day": F.day("obs_date").cast("double")}).dropna(subset=DEEP)
    return AT.attribute([deep_tree(0), deep_tree(1)], DEEP_WEIGHTS, f.select("station", "obs_date", *DEEP), DEEP)


@register("m8_attribution_of_trees", fx.sql(DEEP_SQL, body=f"""
SELECT station, obs_date, any_value(margin) AS margin, any_value(base) AS base, {", ".join(f"coalesce(sum(CASE WHEN f = {j} THEN phi END), 0e0) AS phi_{c}" for j, c in enumerate(DEEP))}
FROM phis JOIN tops USING (station, obs_date) GROUP BY station, obs_date"""),
          "station:s obs_date:d margin:f base:f " + " ".join(f"phi_{c}:f" for c in DEEP))
def m8_attribution_of_trees(spark, sf_dir):
    """M8 on two fixed trees of depth 7 over eight features of the dense calendar."""
    return _deep_scored(spark, sf_dir).select("station", "obs_date", "margin", "base", *[f"phi_{c}" for c in DEEP])


@register("s7_predictions_of_trees", fx.sql(FEAT_LABEL_SQL, DEEP_SQL, body="""
SELECT obs_date, station, label AS y_true, CAST(1 / (1 + exp(-2 * margin)) >= 0.4 AS INT) AS y_pred, 1 / (1 + exp(-2 * margin)) AS y_pred_proba
FROM tops JOIN lab USING (station, obs_date)"""), "obs_date:d station:s y_true:i y_pred:i y_pred_proba:f")
def s7_predictions_of_trees(spark, sf_dir):
    """M5 + S7: probability, class at threshold 0.4 and the exported columns for the fixed trees."""
    p = 1 / (1 + F.exp(-2 * F.col("margin")))
    scored = _deep_scored(spark, sf_dir).select("station", "obs_date", p.alias("proba"), (p >= 0.4).cast("int").alias("pred"))
    labels = label_extreme(fx.grid(spark, sf_dir)).select("station", "obs_date", "label")
    return M.predictions_table(scored.join(labels, ["station", "obs_date"]))


@register("m9_summary_of_table", fx.sql(ATTR_SQL, body="SELECT * FROM share"), "feature:s mean_abs:f share_pct:f")
def m9_summary_of_table(spark, sf_dir):
    return AT.attribution_summary(_attr_table(spark, sf_dir), TABLE_FEATURES)


@register("m10_direction_of_table", fx.sql(ATTR_SQL, body="""
SELECT feature, corr(x, phi) AS corr, CASE WHEN corr(x, phi) > 0 THEN 'up=extreme' WHEN corr(x, phi) < 0 THEN 'up=normal' END AS direction
FROM al GROUP BY feature"""), "feature:s corr:f direction:s")
def m10_direction_of_table(spark, sf_dir):
    return AT.attribution_direction(_attr_table(spark, sf_dir), TABLE_FEATURES)


@register("m11_compare_tables", fx.sql(ATTR_SQL, body="""
SELECT o.feature, o.share_pct AS old_share, n.share_pct AS new_share,
       CASE WHEN n.share_pct IS NULL THEN 'N/A' ELSE printf('%.2f', n.share_pct) END AS new_share_text
FROM share o LEFT JOIN less n USING (feature)"""), "feature:s old_share:f new_share:f new_share_text:s")
def m11_compare_tables(spark, sf_dir):
    """M11 on the table: a later model without ``lag2`` (N/A there)."""
    t = _attr_table(spark, sf_dir)
    return AT.compare_attribution(AT.attribution_summary(t, TABLE_FEATURES),
                                  AT.attribution_summary(t, [c for c in TABLE_FEATURES if c != "lag2"]))


@register("m11_compare_attribution")
def m11_compare_attribution(spark, sf_dir):
    """Shares of the full model against a model without the neighbour features."""
    train, test, model = trained_gbt(spark, sf_dir)
    full = AT.attribution_summary(_attr(spark, sf_dir), FEATURES)
    reduced_feats = [c for c in FEATURES if not c.startswith("nbr_")]
    reduced = M.fit_gbt(train, reduced_feats, weight="weight_ratio", max_iter=100, max_depth=3, step=0.1)
    red = AT.attribution_summary(AT.tree_attribution(reduced, test, reduced_feats), reduced_feats)
    return AT.compare_attribution(full, red)


def solve_sql(name: str, src: str, keys: str, n: int) -> str:
    """CTEs that solve the equations ``src({keys}, i, j, v)`` (j = n + 1 the right side) by elimination, one step a
    CTE; result ``{name}(keys, i, coef)``. The diagonal is scaled to 1; a pivot up to 1e-10 gives 0."""
    same = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))
    own = lambda a: ", ".join(f"{a}.{k}" for k in keys.split(", "))
    steps = [f"""{name}_scale AS MATERIALIZED (SELECT {keys}, i, CASE WHEN v > 0 THEN sqrt(v) ELSE CAST('inf' AS DOUBLE) END AS w FROM {src} WHERE i = j),
{name}_0 AS MATERIALIZED (SELECT {own('a')}, a.i, a.j, a.v / r.w / coalesce(c.w, 1e0) AS v FROM {src} a JOIN {name}_scale r ON {same('a', 'r')} AND a.i = r.i
        LEFT JOIN {name}_scale c ON {same('a', 'c')} AND a.j = c.i)"""]
    for k in range(1, n + 1):
        steps.append(f"""{name}_{k} AS MATERIALIZED (SELECT {own('a')}, a.i, a.j,
        CASE WHEN a.i = {k} THEN CASE WHEN p.v > 1e-10 THEN a.v / p.v ELSE 0e0 END WHEN p.v > 1e-10 THEN a.v - c.v / p.v * r.v ELSE a.v END AS v
        FROM {name}_{k - 1} a JOIN {name}_{k - 1} p ON {same('a', 'p')} AND p.i = {k} AND p.j = {k}
        JOIN {name}_{k - 1} r ON {same('a', 'r')} AND r.i = {k} AND r.j = a.j JOIN {name}_{k - 1} c ON {same('a', 'c')} AND c.i = a.i AND c.j = {k})""")
    steps.append(f"{name} AS MATERIALIZED (SELECT {own('a')}, a.i, a.v / s.w AS coef FROM {name}_{n} a JOIN {name}_scale s ON {same('a', 's')} AND a.i = s.i WHERE a.j = {n + 1})")
    return ",\n".join(steps)


def seasonal_ar_sql(horizon: int = 36, season: int = 12, long_ar: int = 13) -> str:
    """P2 from ``monthly2(series, month, total)``: both least-squares fits as unpivoted equations, the forecast as a recursion."""
    lags = ", ".join(f"lag(z, {k}) OVER w" for k in range(1, long_ar + 1))
    return f"""
dz AS MATERIALIZED (SELECT series, month, total AS y, total - lag(total, {season}) OVER w AS z FROM monthly2 WINDOW w AS (PARTITION BY series ORDER BY month)),
lz AS MATERIALIZED (SELECT *, [{lags}] AS x FROM dz WINDOW w AS (PARTITION BY series ORDER BY month)),
ok AS MATERIALIZED (SELECT *, z IS NOT NULL AND len(list_filter(x, lambda v: v IS NULL)) = 0 AS whole FROM lz),
leq AS MATERIALIZED (SELECT series, i, j, sum(x[i] * CASE WHEN j > {long_ar} THEN z ELSE x[j] END) AS v
        FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM ok WHERE whole), range(1, {long_ar + 1}) a(i), range(1, {long_ar + 2}) b(j)
        WHERE n > {long_ar + 2} GROUP BY series, i, j),
{solve_sql("lc", "leq", "series", long_ar)},
lcoef AS (SELECT series, list(coef ORDER BY i) AS b FROM lc GROUP BY series),
ez AS MATERIALIZED (SELECT o.series, month, y, z, CASE WHEN whole AND b IS NOT NULL THEN z - list_dot_product([coalesce(v, 0e0) FOR v IN x], b) WHEN z IS NOT NULL THEN 0e0 END AS e
        FROM ok o LEFT JOIN lcoef USING (series)),
reg AS MATERIALIZED (SELECT *, [lag(z, 1) OVER w, lag(e, 1) OVER w, lag(z, {season}) OVER w, lag(e, {season}) OVER w] AS x FROM ez WINDOW w AS (PARTITION BY series ORDER BY month)),
grid16 AS (SELECT CAST(p * 8 + q * 4 + sp * 2 + sq AS INTEGER) AS idx, [p, q, sp, sq] AS fl FROM range(2) a(p), range(2) b(q), range(2) c(sp), range(2) d(sq)),
each16 AS MATERIALIZED (SELECT series, idx, fl, z, [CASE WHEN fl[k] = 1 THEN x[k] ELSE 0e0 END FOR k IN [1, 2, 3, 4]] AS x FROM reg, grid16
        WHERE z IS NOT NULL AND len([k FOR k IN [1, 2, 3, 4] IF fl[k] = 1 AND x[k] IS NULL]) = 0),
cnt16 AS (SELECT series, idx, fl, count(*) AS n, list_sum(fl) AS k FROM each16 GROUP BY series, idx, fl HAVING count(*) > list_sum(fl) + 1),
oeq AS MATERIALIZED (SELECT series, idx, i, j, sum(x[i] * CASE WHEN j > 4 THEN z ELSE x[j] END) AS v FROM each16 JOIN cnt16 USING (series, idx), range(1, 5) a(i), range(1, 6) b(j)
        GROUP BY series, idx, i, j),
{solve_sql("oc", "oeq", "series, idx", 4)},
ocoef AS (SELECT series, idx, list(coef ORDER BY i) AS b FROM oc GROUP BY series, idx),
fit16 AS (SELECT t.series, t.idx, any_value(c.fl) AS fl, any_value(b) AS b, any_value(n) AS n, any_value(k) AS k, sum(pow(z - list_dot_product(x, b), 2)) AS sse
        FROM each16 t JOIN cnt16 c ON t.series = c.series AND t.idx = c.idx JOIN ocoef o ON t.series = o.series AND t.idx = o.idx GROUP BY t.series, t.idx),
aic16 AS (SELECT *, n * ln(greatest(sse, 1e-300) / n) + 2 * k AS aic FROM fit16),
best16 AS MATERIALIZED (SELECT * FROM aic16 QUALIFY row_number() OVER (PARTITION BY series ORDER BY round(aic, 9), idx) = 1),
tails AS (SELECT series, max(month) AS last, list(y ORDER BY month) AS y, list(coalesce(z, 0e0) ORDER BY month) AS z, list(coalesce(e, 0e0) ORDER BY month) AS e FROM ez GROUP BY series),
fc AS MATERIALIZED (WITH RECURSIVE f AS (
        SELECT series, 0 AS h, b, y, z, e, [0e0 FOR v IN y] AS py, [0e0 FOR v IN y] AS pz, [0e0 FOR v IN y] AS pe FROM tails JOIN best16 USING (series)
        UNION ALL SELECT series, h + 1, b, list_append(y, zt + y[-{season}]), list_append(z, zt), list_append(e, 0e0), list_append(py, pt + py[-{season}]), list_append(pz, pt),
               list_append(pe, CASE WHEN h = 0 THEN 1e0 ELSE 0e0 END)
        FROM (SELECT *, b[1] * z[-1] + b[2] * e[-1] + b[3] * z[-{season}] + b[4] * e[-{season}] AS zt,
                     b[1] * pz[-1] + b[2] * pe[-1] + b[3] * pz[-{season}] + b[4] * pe[-{season}] + CASE WHEN h = 0 THEN 1e0 ELSE 0e0 END AS pt FROM f WHERE h < {horizon}))
        SELECT series, h, y[-1] AS pred, sum(pow(py[-1], 2)) OVER (PARTITION BY series ORDER BY h) AS psi2 FROM f WHERE h > 0),
p2 AS (SELECT f.series, CAST(date_trunc('month', last) + to_months(CAST(h AS INTEGER)) AS DATE) AS month, pred, 1.96e0 * sqrt(sse / n * psi2) AS half,
              '(' || fl[1] || ',0,' || fl[2] || ')x(' || fl[3] || ',1,' || fl[4] || ',{season})' AS model_order, aic
       FROM fc f JOIN best16 USING (series) JOIN tails USING (series))"""


P2_SQL = MONTHLY_SQL + """,
monthly2 AS (SELECT series, month, total FROM monthly UNION ALL SELECT station, month, station_total FROM st_month),""" + seasonal_ar_sql()


@register("p2_seasonal_ar", fx.sql(P2_SQL, body="SELECT series, month, pred, pred - half AS lower, pred + half AS upper, model_order, aic FROM p2"),
          "series:s month:d pred:f lower:f upper:f model_order:s aic:f")
def p2_seasonal_ar(spark, sf_dir):
    """Seasonal ARMA (order chosen by AIC) on the monthly totals of the network and of each station, 36 months."""
    hist = imputed_grid(spark, sf_dir)
    monthly = FC.monthly_totals(hist, "sum")
    per_station = FC.monthly_totals(hist.withColumn("series", F.col("station")), "sum", series_col="series")
    return seasonal_ar_forecast(monthly.unionByName(per_station), next_month(spark, sf_dir), 36)


@register("p5_score_forecast_model")
def p5_score_forecast_model(spark, sf_dir):
    """P5: the disaggregated seasonal forecast scored by the boosted model, features
    rebuilt from the last 365 days of the imputed history (W11) and scaled with the
    training parameters; levels from the probability."""
    from stormlens.functions.calendar import add_calendar
    from stormlens.operators.risk import score_forecast_model
    # history as the forecast job uses it: KNN-imputed, so the seeded features are complete
    hist = imputed_grid(spark, sf_dir)
    mfc = FC.seasonal_mean_forecast(FC.monthly_totals(hist, "sum"), next_month(spark, sf_dir), 36)
    daily = FC.disaggregate(mfc, FC.monthly_climatology(hist)).select("station", "obs_date", "rain_mm")
    daily = daily.filter(F.col("station").isin(*fx.TARGETS))
    lab = E.date_split(labelled_panel(spark, sf_dir))
    train = lab.filter("split = 'train'")
    params = E.fit_robust(train, NUMERIC)
    train = E.class_weights(E.apply_scaler(train, params), mode="ratio", out="weight_ratio")
    model = _gbt(train)

    def score(feats):
        feats = E.one_hot(add_calendar(feats) if "bulan" not in feats.columns else feats, ["station"],
                          levels={"station": fx.TARGETS}, prefix={"station": "STASIUN"})
        return M.score(model, E.apply_scaler(feats, params))

    return score_forecast_model(hist.filter(F.col("station").isin(*fx.TARGETS)), daily, score,
                                targets=fx.TARGETS, members=fx.TARGETS)
