"""Seasonal ARMA forecast of monthly series (P2), all series in the same jobs.

Seasonal difference z_t = y_t - y_{t-12} (after ``d`` ordinary differences), then the two stages of
Hannan and Rissanen: a long autoregression gives residual estimates e_t, and z_t is regressed on the
subset of {z_{t-1}, z_{t-12}, e_{t-1}, e_{t-12}} that an order (p, q, P, Q) in {0,1}^4 names. AIC =
n ln(SSE / n) + 2k picks the order (the first in grid order on ties), and the horizon is rolled out with
future shocks 0. The band is +-1.96 sigma sqrt(sum psi^2), psi the impulse response of the fitted
recursion with its seasonal integration.

Lags are window columns; the normal equations of the long autoregression and of the 16 orders are grouped
sums of lag products, scaled to a unit diagonal and solved by an elimination that folds over
an array of rows; a column that the ones before it explain (pivot below ``PIVOT``) gets coefficient 0. The
forecast folds over the horizon with the last season of y, z and e as its state. A series is one row a
calendar month, which bounds its window; only sums leave it.

Defined results: months count by their order, not by their distance; a series too short for the long
autoregression has residuals 0; one without an order of more rows than coefficients + 1 gives no
row; a null total counts as a missing value of its lags.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRID = list(itertools.product((0, 1), repeat=4))  # (p, q, P, Q)
PIVOT = 1e-10


def solved(sums: Column, n: int) -> Column:
    """Coefficients of n normal equations, given as n rows of n + 1 sums (the last one the right side)."""
    scale = F.transform(sums, lambda row, i: F.when(F.get(row, i) > 0, F.sqrt(F.get(row, i))).otherwise(F.lit(float("inf"))))
    unit = F.transform(sums, lambda row, i: F.transform(row, lambda x, j: x / F.get(scale, i) / F.when(j < n, F.get(scale, j)).otherwise(1.0)))

    def eliminate(rows: Column, k: Column) -> Column:
        pivot = F.get(F.get(rows, k), k)
        return F.transform(rows, lambda row, i: F.when(i == k, F.transform(row, lambda x: F.when(pivot > PIVOT, x / pivot).otherwise(0.0)))
                           .otherwise(F.zip_with(row, F.get(rows, k), lambda x, y: F.when(pivot > PIVOT, x - F.get(row, k) / pivot * y).otherwise(x))))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), unit, eliminate)
    return F.transform(done, lambda row, i: F.get(row, F.lit(n)) / F.get(scale, i))


def _sums(x: list[Column], y: Column) -> Column:
    """The normal equations of y on x as rows of sums."""
    return F.array(*[F.array(*[F.sum(a * b) for b in [*x, y]]) for a in x])


def _fitted(x: list[Column], coef: Column) -> Column:
    out = F.lit(0.0)
    for k, a in enumerate(x):
        out = out + F.get(coef, F.lit(k)) * a
    return out


def differenced(monthly: DataFrame, season: int, d: int) -> DataFrame:
    """(series, month, y, z)."""
    order = W.partitionBy("series").orderBy("month")
    out = monthly.select("series", "month", F.col("total").cast("double").alias("y")).withColumn("z", F.col("y"))
    for lag in [1] * d + [season]:
        out = out.withColumn("z", F.col("z") - F.lag("z", lag).over(order))
    return out


def residuals(rows: DataFrame, long_ar: int) -> DataFrame:
    """``rows`` with e, what the long autoregression leaves of z; 0 where its lags are missing."""
    order = W.partitionBy("series").orderBy("month")
    names = [f"_z{k}" for k in range(1, long_ar + 1)]
    lagged = rows.withColumns({c: F.lag("z", k).over(order) for k, c in enumerate(names, 1)})
    x = [F.col(c) for c in names]
    whole = F.col("z").isNotNull()
    for c in x:
        whole = whole & c.isNotNull()
    model = lagged.filter(whole).groupBy(F.col("series").alias("_of")).agg(F.count("*").alias("_n"), _sums(x, F.col("z")).alias("_sums")) \
        .filter(F.col("_n") > long_ar + 2).select("_of", solved(F.col("_sums"), long_ar).alias("_coef"))
    joined = lagged.join(model, F.col("series") == F.col("_of"), "left")
    e = F.when(whole & F.col("_coef").isNotNull(), F.col("z") - _fitted(x, F.col("_coef"))).when(F.col("z").isNotNull(), 0.0)
    return joined.select("series", "month", "y", "z", e.alias("e"))


def order_fits(rows: DataFrame, season: int) -> DataFrame:
    """(series, idx, flags, coef, n, sse, aic): the fit of every order of the grid."""
    order = W.partitionBy("series").orderBy("month")
    lagged = rows.withColumns({"_ar": F.lag("z", 1).over(order), "_ma": F.lag("e", 1).over(order), "_sar": F.lag("z", season).over(order), "_sma": F.lag("e", season).over(order)})
    grid = F.array(*[F.struct(F.lit(k).alias("idx"), F.array(*map(F.lit, flags)).alias("flags")) for k, flags in enumerate(GRID)])
    each = lagged.filter("z is not null").select("series", "z", "_ar", "_ma", "_sar", "_sma", F.inline(grid))
    names = ["_ar", "_ma", "_sar", "_sma"]
    used = [F.get("flags", F.lit(k)) == 1 for k in range(4)]
    whole = F.lit(True)
    for use, c in zip(used, names):
        whole = whole & (~use | F.col(c).isNotNull())
    each = each.filter(whole).withColumns({c: F.when(use, F.col(c)).otherwise(0.0) for use, c in zip(used, names)})
    x = [F.col(c) for c in names]
    model = each.groupBy("series", "idx").agg(F.count("*").alias("n"), _sums(x, F.col("z")).alias("_sums"), F.first("flags").alias("flags")) \
        .withColumn("k", F.aggregate("flags", F.lit(0), lambda s, f: s + f)).filter(F.col("n") > F.col("k") + 1) \
        .select(F.col("series").alias("_of"), F.col("idx").alias("_idx"), "n", "k", solved(F.col("_sums"), 4).alias("coef"))
    left = F.col("z") - _fitted(x, F.col("coef"))
    out = each.join(model, (F.col("series") == F.col("_of")) & (F.col("idx") == F.col("_idx"))) \
        .groupBy("series", "idx", "flags", "coef", "n", "k").agg(F.sum(left * left).alias("sse"))
    return out.withColumn("aic", F.col("n") * F.log(F.greatest("sse", F.lit(1e-300)) / F.col("n")) + 2 * F.col("k"))


def _rolled(state: Column, coef: Column, steps: Column, season: int, d: int, shock: float) -> Column:
    """y of the next steps: ``state`` holds the last season + 1 values of y, z and e; ``shock`` is the first step's."""
    c = [F.get(coef, F.lit(k)) for k in range(4)]  # of z_{t-1}, e_{t-1}, z_{t-season}, e_{t-season}

    def step(s: Column, i: Column) -> Column:
        e = F.when(i == 1, F.lit(shock)).otherwise(0.0)
        z = c[0] * F.element_at(s["z"], -1) + c[1] * F.element_at(s["e"], -1) + c[2] * F.element_at(s["z"], -season) + c[3] * F.element_at(s["e"], -season) + e
        y = z + F.element_at(s["y"], -season)
        if d:  # one ordinary difference
            y = y + F.element_at(s["y"], -1) - F.element_at(s["y"], -1 - season)
        add = lambda name, v: F.concat(s[name], F.array(v)).alias(name)
        return F.struct(add("y", y), add("z", z), add("e", e))

    return F.slice(F.aggregate(F.sequence(F.lit(1), steps), state, step)["y"], season + 2, steps)


def seasonal_ar_forecast(monthly: DataFrame, start_month, horizon: int = 36, season: int = 12,
                         d: int = 0, long_ar: int = 13) -> DataFrame:
    """Seasonal ARMA forecast of each series for ``horizon`` months from ``start_month`` (from the
    month after its last one when that is later), with band, order and AIC. ``d`` is 0 or 1."""
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    rows = residuals(differenced(monthly, season, d), long_ar)
    fits = order_fits(rows, season)
    best = fits.groupBy(F.col("series").alias("_of")).agg(F.min_by(F.struct("flags", "coef", "n", "sse", "aic"), F.struct(F.round("aic", 9), "idx")).alias("m"))
    back = F.row_number().over(W.partitionBy("series").orderBy(F.desc("month")))
    tail = rows.withColumn("_back", back).filter(F.col("_back") <= season + 1).groupBy("series").agg(
        F.max("month").alias("last"), F.array_sort(F.collect_list(F.struct("month", "y", "z", "e"))).alias("t"))
    pad = lambda name: F.slice(F.concat(F.array_repeat(F.lit(0.0), season + 1), F.transform("t", lambda r: F.coalesce(r[name], F.lit(0.0)))), -season - 1, season + 1).alias(name)
    zeros = F.array_repeat(F.lit(0.0), season + 1)
    first = F.greatest(F.trunc(F.lit(start_month).cast("date"), "MM"), F.add_months(F.trunc("last", "MM"), 1))
    ahead = (F.round(F.months_between(first, F.trunc("last", "MM"))) - 1).cast("int")
    fitted = tail.join(best, F.col("series") == F.col("_of")).select(
        "series", F.trunc("last", "MM").alias("last"), ahead.alias("ahead"), (ahead + horizon).alias("steps"), "m.*", F.struct(*[pad(c) for c in "yze"]).alias("state"))
    rolled = fitted.withColumns({
        "pred": _rolled(F.col("state"), F.col("coef"), F.col("steps"), season, d, 0.0),
        "psi": _rolled(F.struct(zeros.alias("y"), zeros.alias("z"), zeros.alias("e")), F.col("coef"), F.col("steps"), season, d, 1.0)})
    spread = F.transform("psi", lambda p, i: 1.96 * F.sqrt(F.col("sse") / F.col("n") * F.aggregate(F.slice("psi", F.lit(1), i + 1), F.lit(0.0), lambda s, v: s + v * v)))
    f = lambda k: F.get("flags", F.lit(k)).cast("string")
    name = F.concat(F.lit("("), f(0), F.lit(f",{d},"), f(1), F.lit(")x("), f(2), F.lit(",1,"), f(3), F.lit(f",{season})"))
    out = rolled.select("series", "last", "ahead", name.alias("model_order"), "aic", F.posexplode(F.arrays_zip("pred", spread.alias("half"))).alias("k", "x"))
    return out.filter(F.col("k") >= F.col("ahead")).select(
        "series", F.add_months("last", F.col("k") + 1).alias("month"), F.col("x.pred").alias("pred"), (F.col("x.pred") - F.col("x.half")).alias("lower"),
        (F.col("x.pred") + F.col("x.half")).alias("upper"), "model_order", "aic")
