"""Property tests for the operators without an SQL oracle (and brute-force checks
of the distributed algorithms on small fixtures)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stormlens.operators import attribution as AT
from stormlens.operators import evaluate as V
from stormlens.operators import forecast as FC
from stormlens.operators import impute as I
from stormlens.operators import model as M
from stormlens.operators import prep as E
from stormlens.operators.neighbours import knn_join
from stormlens.operators.resample import smote
from stormlens.operators.seasonal_ar import seasonal_ar_forecast

D0 = dt.date(2020, 1, 1)


def _knn_bruteforce(W: np.ndarray, k: int):
    """Independent numpy reference of the documented KNN-impute semantics."""
    n, p = W.shape
    out = W.copy()
    means = np.nanmean(W, axis=0)
    for i in range(n):
        for c in range(p):
            if not np.isnan(W[i, c]):
                continue
            cands = []
            for j in range(n):
                if np.isnan(W[j, c]):
                    continue
                both = ~np.isnan(W[i]) & ~np.isnan(W[j])
                m = both.sum()
                if m == 0:
                    continue
                sq = 0.0
                for q in range(p):
                    if both[q]:
                        sq += (W[i, q] - W[j, q]) ** 2
                cands.append((np.sqrt(p / m * sq), j))
            if not cands:
                out[i, c] = max(means[c], 0.0)
                continue
            cands.sort()
            sel = cands[:k]
            d = np.array([s[0] for s in sel])
            v = np.array([W[s[1], c] for s in sel])
            w = (d == 0).astype(float) if (d == 0).any() else 1.0 / d
            out[i, c] = max((w * v).sum() / w.sum(), 0.0)
    return out


def test_knn_impute_matches_bruteforce_with_ties(spark):
    rng = np.random.default_rng(7)
    n, p = 60, 4
    W = rng.choice([0.0, 0.0, 0.0, 1.5, 3.0, 10.0], size=(n, p))  # many exact ties
    W[rng.random((n, p)) < 0.25] = np.nan
    W[5] = np.nan  # a day with every station missing → column means
    cols = [f"s{j}" for j in range(p)]
    pdf = pd.DataFrame(W, columns=cols)
    pdf.insert(0, "obs_date", [D0 + dt.timedelta(days=i) for i in range(n)])
    wide = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None))
    got = I.knn_impute_wide(wide, cols, k=3, block=16).orderBy("obs_date").toPandas()[cols].to_numpy(float)
    exp = _knn_bruteforce(W, 3)
    assert np.allclose(got, exp, atol=1e-9)
    assert not np.isnan(got).any()


def test_knn_prunes_blocks_and_stays_exact(spark):
    """Days in clusters far from each other: most blocks of donors are never searched, the result is brute force's."""
    rng = np.random.default_rng(8)
    centre = rng.uniform(0, 200, (12, 1)) + rng.uniform(0, 20, (12, 3))
    V = np.round(centre[rng.integers(0, 12, 3000)] + rng.normal(0, 0.5, (3000, 3)), 1)
    gaps = rng.random((3000, 3)) < 0.12
    gaps[gaps.sum(1) > 1] = False
    V[gaps] = np.nan
    days = pd.date_range("2001-01-01", periods=3000).date
    wide = spark.createDataFrame([(d, *[None if np.isnan(x) else float(x) for x in row]) for d, row in zip(days, V)],
                                 "obs_date date, a double, b double, c double")
    got = I.knn_impute_wide(wide, ["a", "b", "c"], k=5, block=16).orderBy("obs_date").toPandas()[["a", "b", "c"]].to_numpy(float)
    np.testing.assert_allclose(got, np.maximum(_knn_bruteforce(V, 5), 0), atol=1e-9)
    report = I.knn_search_report(I.to_long(wide, ["a", "b", "c"]), block=16).first()
    assert report.evaluated_pairs < 0.5 * report.all_pairs
    assert report.packed_rows < 0.5 * -(-report.receivers // 16) * -(-report.donors // 16) * 32


def test_interpolation_matches_pandas(spark):
    rng = np.random.default_rng(3)
    v = rng.random(40) * 10
    v[[0, 1, 7, 8, 9, 20, 39]] = np.nan
    pdf = pd.DataFrame({"station": "a", "obs_date": [D0 + dt.timedelta(days=i) for i in range(40)], "rain_mm": v})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None))
    got = I.interpolate_linear(df).orderBy("obs_date").toPandas()["rain_mm"].to_numpy(float)
    exp = pd.Series(v).interpolate(method="linear", limit_direction="both").to_numpy()
    assert np.allclose(got, exp)


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(11)
    n = 400
    x1, x2, x3 = rng.random(n), rng.random(n), rng.integers(0, 3, n).astype(float)
    y = ((x1 + 0.5 * x2 + rng.normal(0, 0.2, n)) > 1.35).astype(int)
    pdf = pd.DataFrame({"rid": np.arange(n), "x1": x1, "x2": x2, "x3": x3, "label": y,
                        "weight": 1.0, "obs_date": [D0 + dt.timedelta(days=i // 2) for i in range(n)]})
    return spark.createDataFrame(pdf)


def test_tree_attribution_is_additive(spark, toy):
    feats = ["x1", "x2", "x3"]
    model = M.fit_gbt(toy, feats, max_iter=15, max_depth=3, step=0.3)
    attr = AT.tree_attribution(model, toy, feats, keep=("rid",)).toPandas()
    resid = attr["base"] + attr[[f"phi_{c}" for c in feats]].sum(axis=1) - attr["margin"]
    assert np.abs(resid).max() < 1e-9
    raw = M.score(model, toy).select("rid", "proba").toPandas().set_index("rid")["proba"]
    margin = attr.set_index("rid")["margin"]
    assert np.allclose(1.0 / (1.0 + np.exp(-2.0 * margin)), raw.loc[margin.index], atol=1e-9)


def _coalition_value(nodes, X, inside, nid=0):
    pred, _, left, right, feat, thr = nodes[nid]
    if left < 0:
        return np.full(len(X), pred)
    a, b = _coalition_value(nodes, X, inside, left), _coalition_value(nodes, X, inside, right)
    if feat in inside:
        return np.where(X[:, feat] <= thr, a, b)
    return (nodes[left][1] * a + nodes[right][1] * b) / (nodes[left][1] + nodes[right][1])


def test_deep_attribution_equals_all_coalitions():
    """Depth 7 with 15 features against the definition over all 2^15 coalitions."""
    rng = np.random.default_rng(5)
    nodes, covers = {}, {}
    for n in range(255, 0, -1):
        covers[n] = int(rng.integers(1, 9)) if n > 127 else covers[2 * n] + covers[2 * n + 1]
        nodes[n - 1] = (float(rng.normal()), covers[n], -1, -1, -1, 0.0) if n > 127 else (0.0, covers[n], 2 * n - 1, 2 * n, n % 15 if n < 16 else int(rng.integers(15)), float(rng.normal()))
    X = rng.normal(size=(4, 15))
    phi, base, margin = AT.shapley_batch([nodes], [1.0], X, 15)
    values = [_coalition_value(nodes, X, {f for f in range(15) if s >> f & 1}) for s in range(1 << 15)]
    V = np.array(values)
    sizes = np.array([bin(s).count("1") for s in range(1 << 15)])
    share = np.array([math.factorial(k) * math.factorial(14 - k) / math.factorial(15) for k in range(15)])
    for f in range(15):
        without = np.flatnonzero((np.arange(1 << 15) >> f & 1) == 0)
        want = share[sizes[without]] @ (V[without | 1 << f] - V[without])
        assert np.allclose(phi[:, f], want, atol=1e-9)
    assert np.allclose(base, V[0]) and np.allclose(margin, V[-1]) and np.allclose(phi.sum(1) + base, margin)


def test_attribution_with_empty_branches():
    """A branch without training rows has a share of 0."""
    nodes = {0: (0.0, 4, 1, 2, 0, 0.0), 1: (0.0, 0, 3, 4, 1, 0.0), 2: (2.0, 4, -1, -1, -1, 0.0), 3: (5.0, 1, -1, -1, -1, 0.0), 4: (7.0, 1, -1, -1, -1, 0.0)}
    X = np.array([[-1.0, -1.0], [-1.0, 1.0], [1.0, -1.0]])
    phi, base, margin = AT.shapley_batch([nodes], [1.0], X, 2)
    V = [_coalition_value(nodes, X, s) for s in (set(), {0}, {1}, {0, 1})]
    assert np.allclose(phi[:, 0], (V[1] - V[0] + V[3] - V[2]) / 2) and np.allclose(phi[:, 1], (V[2] - V[0] + V[3] - V[1]) / 2)
    assert np.allclose(margin, V[3]) and np.allclose(base, V[0])


def test_smote_parity_and_segments(spark, toy):
    feats = ["x1", "x2"]
    out = smote(toy.select("rid", "label", *feats), feats, "rid", k=5)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    # every synthetic row lies on a segment between its base and one of its 5 nearest minority rows
    mino = toy.filter("label = 1").select("rid", *feats).toPandas().set_index("rid")
    syn = out.filter("synthetic = 1").toPandas()
    X = mino[feats].to_numpy()
    for _, r in syn.head(50).iterrows():
        pt = r[feats].to_numpy(float)
        ok = False
        for a in range(len(X)):
            d = np.sqrt(((X - X[a]) ** 2).sum(axis=1))
            d[a] = np.inf
            for b in np.argsort(d, kind="stable")[:5]:
                seg = X[b] - X[a]
                lam = np.dot(pt - X[a], seg) / max(np.dot(seg, seg), 1e-300)
                if -1e-9 <= lam <= 1 + 1e-9 and np.allclose(X[a] + lam * seg, pt, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok


def test_knn_join_matches_bruteforce(spark, toy):
    feats = ["x1", "x2", "x3"]
    got = knn_join(toy, toy, "rid", "rid", feats, k=4, exclude_self=True, block=64).toPandas()
    X = toy.orderBy("rid").toPandas()[feats].to_numpy()
    for lid in [0, 17, 399]:
        d = np.sqrt(((X - X[lid]) ** 2).sum(axis=1))
        d[lid] = np.inf
        exp = list(np.lexsort((np.arange(len(d)), d))[:4])
        assert list(got[got.lid == lid].sort_values("rank")["rid"]) == exp


@pytest.mark.parametrize("k, exclude_self", [(4, True), (3, False)])
def test_knn_join_by_pivots_is_exact_and_sends_little(spark, k, exclude_self):
    """Clusters, one point many times (ties by id, a cell above a tile), an outlier, few rows on one side."""
    from stormlens.operators.neighbours import replicated
    rng = np.random.default_rng(11)
    X = rng.uniform(0, 1000, (20, 2))[rng.integers(0, 20, 1500)] + rng.normal(0, 1, (1500, 2))
    X[:300] = X[0]
    X[-1] = [1e7, -1e7]
    right = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "rid long, a double, b double").repartition(5)
    left = right if exclude_self else spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(rng.uniform(-100, 1100, (200, 2)))], "rid long, a double, b double")
    Y = X if exclude_self else left.orderBy("rid").toPandas()[["a", "b"]].to_numpy()
    got = knn_join(left, right, "rid", "rid", ["a", "b"], k=k, exclude_self=exclude_self, block=50).toPandas()
    d = np.sqrt((Y[:, None, 0] - X[None, :, 0]) ** 2 + (Y[:, None, 1] - X[None, :, 1]) ** 2)
    if exclude_self:
        np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :k]
    have = got.sort_values(["lid", "rank"])["rid"].to_numpy().reshape(-1, k)
    assert have.shape == want.shape and (have == want).all()
    if exclude_self:
        assert replicated(left, right, "rid", "rid", ["a", "b"], k=k, exclude_self=True, block=50) < 6  # of 30 cells
    odd = right.unionByName(spark.createDataFrame([(9000, None, 1.0), (9001, float("nan"), 2.0)], "rid long, a double, b double"))
    with_odd = knn_join(odd, odd, "rid", "rid", ["a", "b"], k=k, exclude_self=exclude_self, block=50)
    plain = knn_join(right, right, "rid", "rid", ["a", "b"], k=k, exclude_self=exclude_self, block=50)
    assert sorted(map(tuple, with_odd.collect())) == sorted(map(tuple, plain.collect()))  # rows without a feature have none and are none
    none = right.limit(0)
    assert knn_join(none, right, "rid", "rid", ["a", "b"]).count() == 0 and knn_join(left, none, "rid", "rid", ["a", "b"]).count() == 0
    assert knn_join(left.limit(3), right.limit(2), "rid", "rid", ["a", "b"], k=5).count() == 6


def test_time_folds_never_train_on_later_dates(spark, toy):
    folded = E.time_folds(toy, n_splits=3)
    for i in range(3):
        tr, te = E.fold_train_test(folded, i)
        assert tr.agg(F.max("obs_date")).first()[0] < te.agg(F.min("obs_date")).first()[0]


def test_sweep_recall_non_increasing(spark, toy):
    pred = toy.withColumn("proba", F.col("x1"))
    rec = [r["recall"] for r in V.threshold_sweep(pred).orderBy("threshold").collect()]
    assert all(a >= b for a, b in zip(rec, rec[1:]))


def test_disaggregation_preserves_month_totals(spark):
    monthly = spark.createDataFrame([("network", dt.date(2021, m, 1), 100.0 * m) for m in (1, 2)],
                                    "series string, month date, pred double")
    clim = spark.createDataFrame([("network", s, m, c) for s, c in (("a", 1.0), ("b", 3.0)) for m in (1, 2)],
                                 "series string, station string, cal_month int, clim double")
    daily = FC.disaggregate(monthly, clim, mode="share")
    tot = {r["m"]: r["t"] for r in daily.groupBy(F.month("obs_date").alias("m")).agg(F.sum("rain_mm").alias("t"))
           .collect()}
    assert tot[1] == pytest.approx(100.0) and tot[2] == pytest.approx(200.0)


def test_seasonal_ar_repeats_pure_season(spark):
    pattern = [10, 20, 35, 50, 80, 60, 30, 20, 15, 40, 90, 70]
    rows = [("s", dt.date(2000 + i // 12, i % 12 + 1, 1), float(pattern[i % 12])) for i in range(60)]
    monthly = spark.createDataFrame(rows, "series string, month date, total double")
    fc = seasonal_ar_forecast(monthly, "2005-01-01", 12).orderBy("month").toPandas()
    assert np.allclose(fc["pred"].to_numpy(), pattern, atol=1e-6)


def test_seasonal_ar_coefficients_are_least_squares(spark):
    """The folded elimination against numpy on a design with an explained column and on a well-posed one."""
    from stormlens.operators.seasonal_ar import _sums, solved
    rng = np.random.default_rng(4)
    X = rng.normal(0, [1, 50, 0.01], (60, 3))
    y = X @ [2.0, -0.3, 40] + rng.normal(0, 0.1, 60)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(X, y)], "a double, b double, c double, y double")
    x = [F.col("a"), F.col("b"), F.col("c")]
    got = df.agg(_sums(x, F.col("y")).alias("s")).select(solved(F.col("s"), 3)).first()[0]
    assert np.allclose(got, np.linalg.lstsq(X, y, rcond=None)[0], rtol=1e-9)
    twice = [F.col("a"), F.col("a") * 2, F.lit(0.0)]
    got = df.agg(_sums(twice, F.col("y")).alias("s")).select(solved(F.col("s"), 3)).first()[0]
    assert np.allclose(got, [X[:, 0] @ y / (X[:, 0] @ X[:, 0]), 0, 0])


def test_seasonal_ar_short_series(spark):
    rows = [("short", dt.date(2000, k + 1, 1), 1.0) for k in range(12)] + [("year", dt.date(2000 + k // 12, k % 12 + 1, 1), float(k % 12)) for k in range(16)]
    out = seasonal_ar_forecast(spark.createDataFrame(rows, "series string, month date, total double"), "2001-05-01", 3).orderBy("month").collect()
    assert [(r.series, str(r.month), r.pred) for r in out] == [("year", "2001-05-01", 4.0), ("year", "2001-06-01", 5.0), ("year", "2001-07-01", 6.0)]


def _newton_logistic(X, y, s, iters=50):
    """Independent solve of  ½‖w‖² + Σ s_i · logloss_i  (intercept not penalised)."""
    n, p = X.shape
    A = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(p + 1)
    reg = np.diag([1.0] * p + [0.0])
    for _ in range(iters):
        mu = 1.0 / (1.0 + np.exp(-(A @ beta)))
        grad = A.T @ (s * (mu - y)) + reg @ beta
        H = (A * (s * mu * (1 - mu))[:, None]).T @ A + reg
        beta -= np.linalg.solve(H, grad)
    return beta


def test_logistic_matches_the_c1_objective(spark, toy):
    feats = ["x1", "x2", "x3"]
    weighted = E.class_weights(toy, mode="balanced", out="weight")
    pdf = weighted.orderBy("rid").toPandas()
    exp = _newton_logistic(pdf[feats].to_numpy(), pdf["label"].to_numpy(float), pdf["weight"].to_numpy())
    m = M.fit_logistic(weighted, feats).stages[-1]
    got = np.append(m.coefficients.toArray(), m.intercept)
    assert np.allclose(got, exp, atol=1e-3)


def test_balanced_bags_and_their_vote(spark, toy):
    """Poisson draws by hash, class weights within each bag, and the mean of the trees' probabilities."""
    feats, key = ["x1", "x2", "x3"], F.col("rid").cast("string")
    draws = np.array([r[0] for r in toy.orderBy("rid").select(M.bag_draws(key, 6)).collect()])
    assert draws.shape == (toy.count(), 6) and abs(draws.mean() - 1) < 0.1 and abs(draws.var() - 1) < 0.2
    again = np.array([r[0] for r in toy.repartition(3).orderBy("rid").select(M.bag_draws(key, 6)).collect()])
    assert (draws == again).all()
    y = np.array([r[0] for r in toy.orderBy("rid").select("label").collect()])
    got = {(r.bag, r.label): (r.n_drawn, r.class_weight) for r in M.bag_class_weights(toy, key, 6).collect()}
    for b in range(6):
        for c in (0, 1):
            n = draws[y == c, b].sum()
            assert got[b, c] == (n, pytest.approx(draws[:, b].sum() / (2 * n)))
    models = M.fit_balanced_forest(toy, feats, key, num_trees=6, max_depth=3)
    voted = M.score_votes(models, toy, 0.5).orderBy("rid").toPandas()
    each = [M.score(m, toy).orderBy("rid").toPandas()["proba"].to_numpy() for m in models]
    assert np.allclose(voted["proba"], np.mean(each, axis=0)) and (voted["pred"] == (voted["proba"] >= 0.5)).all()
    assert set(voted.columns) == {*toy.columns, "proba", "pred"} and len({tuple(e) for e in each}) == 6


def test_boosted_trees_beat_the_prior(spark, toy):
    feats = ["x1", "x2", "x3"]
    weighted = E.class_weights(toy, mode="ratio", out="weight")
    scored = M.score(M.fit_gbt(weighted, feats, max_iter=30, max_depth=3, step=0.1), toy).toPandas()
    pos, neg = scored[scored.label == 1]["proba"], scored[scored.label == 0]["proba"]
    auc = (pos.to_numpy()[:, None] > neg.to_numpy()[None, :]).mean()
    assert auc > 0.8


def test_knn_clip_is_one_rule_without_and_with_gaps(spark):
    """Negative values are clipped in every path, also when nothing is missing."""
    import datetime as dt

    from stormlens.operators import impute as I
    from stormlens.operators.features import to_wide

    day = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(3)]
    for last in (2.0, None):
        rows = [(s, d, v) for s, vs in (("a", [-1.0, 3.0, last]), ("b", [-4.0, 5.0, 1.0])) for d, v in zip(day, vs)]
        df = spark.createDataFrame(rows, "station string, obs_date date, rain_mm double")
        wide = {r.obs_date: (r.a, r.b) for r in I.knn_impute_wide(to_wide(df, ["a", "b"]), ["a", "b"]).collect()}
        long = {(r.station, r.obs_date): r.rain_mm for r in I.knn_impute(df, ["a", "b"]).collect()}
        region = {(r.station, r.obs_date): r.rain_mm for r in I.knn_impute(df.selectExpr("*", "'x' as region"), region_col="region").collect()}
        assert long == region == {(s, d): wide[d][k] for d in day for k, s in enumerate(("a", "b"))}
        assert wide[day[0]] == (0.0, 0.0) and None not in long.values()


def test_densify_keeps_stations_without_a_reading_in_range(spark):
    import datetime as dt

    from stormlens.operators.calendar import densify

    d = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rows = [("in", d(3), 1.0), ("in", d(3), 3.0), ("in", d(5), 4.0), ("before", d(-9), 7.0), ("before", d(-2), 7.0), ("after", d(30), 7.0),
            ("both", d(-1), 7.0), ("both", d(4), 2.0), ("both", d(12), 7.0), ("undated", None, 7.0)]
    got = densify(spark.createDataFrame(rows, "station string, obs_date date, rain_mm double"), d(0), d(9)).collect()
    want = {(s, d(n)): None for s in ("in", "before", "after", "both", "undated") for n in range(10)}
    want |= {("in", d(3)): 2.0, ("in", d(5)): 4.0, ("both", d(4)): 2.0}
    assert len(got) == 50 and {(r.station, r.obs_date): r.rain_mm for r in got} == want


def test_folds_and_masks_take_any_integer_key(spark):
    from stormlens.operators import prep as E

    keys = [2 ** 62 + 3 * k for k in range(40)] + [10 ** 13 + k for k in range(40)] + list(range(20))
    df = spark.createDataFrame([(k, i % 3 // 2) for i, k in enumerate(keys)], "rid long, label int")
    folds = E.stratified_folds(df, "rid", "label", k=5, seed=3).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert E.hide_mask(df, "rid", ["label"], 0.1).selectExpr("sum(hide_label)").first()[0] == 10


def test_folds_do_not_depend_on_the_buckets(spark, monkeypatch):
    """With far more buckets than hash values, ranks are those of one bucket a hash range."""
    from stormlens.operators import prep as E

    df = spark.range(0, 60_000, 2).selectExpr("id * 7 - 90000 as rid", "cast(id % 5 = 0 as int) as label")
    few = E.stratified_folds(df, "rid", "label", k=5, seed=3), E.hide_mask(df, "rid", ["label"], 0.1)
    before = [sorted(map(tuple, x.collect())) for x in few]
    monkeypatch.setattr(E, "ROWS_PER_BUCKET", 1)  # three parts a hash value
    many = E.stratified_folds(df, "rid", "label", k=5, seed=3), E.hide_mask(df, "rid", ["label"], 0.1)
    assert [sorted(map(tuple, x.collect())) for x in many] == before


def test_smote_needs_enough_neighbours(spark):
    import pytest

    from stormlens.operators.resample import smote

    df = spark.createDataFrame([(k, float(k), int(k < 3)) for k in range(20)], "rid long, x double, label int")
    with pytest.raises(ValueError, match="6 minority rows"):
        smote(df, ["x"], "rid", k=5)


def test_map_names_by_dictionary_and_by_frame(spark):
    from stormlens.operators.clean import map_names

    df = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    names = {"a": "A"}
    frame = spark.createDataFrame(list(names.items()), "k string, v string")
    for given in (names, frame):
        assert {(r.name, r.s) for r in map_names(df, given, out="s").collect()} == {("a", "A"), ("b", None), (None, None)}
        assert {(r.name, r.s) for r in map_names(df, given, out="s", keep_unmatched=True).collect()} == {("a", "A"), ("b", "b"), (None, None)}


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_by_group_equal_numpy(spark, accuracy):
    """Groups of all sizes, one with most rows, an outlier of 1e300, ties, nulls and NaN; with a coarse sketch the
    brackets are narrower than the groups."""
    from stormlens.operators.quantiles import column_quantiles, quantiles_by
    rng = np.random.default_rng(9)
    groups = {"hot": np.append(rng.lognormal(0, 3, 20_000), [1e300, -1e300]), "ties": np.repeat([0.0, 0.1, 7.5], [4000, 1500, 900]),
              "few": np.array([3.0, -1.0]), "one": np.array([5.0]), None: rng.normal(size=333), "even": np.arange(4000.0)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("empty", None), ("few", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = (0.0, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r.g: (r.n, r.q) for r in quantiles_by(df, ["g"], F.col("v"), probs, F.count("*").alias("n"), accuracy=accuracy).collect()}
    assert got.keys() == {*groups, "empty"} and got["empty"] == (1, None) and got["few"][0] == 3
    for g, v in groups.items():
        assert np.allclose(got[g][1], np.quantile(v, probs), rtol=1e-12)
    whole = np.concatenate(list(groups.values()))
    assert np.allclose(quantiles_by(df, [], F.col("v"), probs, accuracy=accuracy).first().q, np.quantile(whole, probs), rtol=1e-12)
    both = column_quantiles(df.withColumn("w", F.col("v") * 0 + 2).withColumn("z", F.lit(None).cast("double")), ["v", "w", "z"], probs, accuracy)
    assert np.allclose(both["v"], np.quantile(whole, probs), rtol=1e-12) and both["w"] == [2.0] * 7 and both["z"] == [None] * 7


def test_exact_quantiles_equal_numpy(spark):
    import numpy as np

    from stormlens.operators import prep as E

    r = np.random.default_rng(0)
    columns = {"a": r.exponential(5, 997), "b": np.zeros(997), "c": r.integers(-3, 4, 997).astype(float), "d": np.full(997, np.nan),
               "e": np.r_[r.normal(size=996), 1e9]}
    rows = [tuple(None if np.isnan(x) else float(x) for x in t) for t in zip(*columns.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    for buckets in (1, 7, 4096):
        got = E.exact_quantiles(df, list(columns), (0.0, 0.25, 0.5, 0.95, 1.0), buckets)
        for c, v in columns.items():
            if c == "d":
                assert got[c] == [None] * 5
            else:
                assert np.allclose(got[c], np.quantile(v, [0.0, 0.25, 0.5, 0.95, 1.0]), rtol=1e-12)
    assert E.exact_quantiles(df.limit(0), ["a"], (0.5,)) == {"a": [None]}
