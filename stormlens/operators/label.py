"""Extreme-day labels (X8, X9) on top of per-station quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_extreme(panel: DataFrame, thresholds: DataFrame | None = None, q: float = 0.95,
                  value_col: str = "rain_mm", out: str = "label",
                  fit_until=None) -> DataFrame:
    """``label = value > threshold`` (strict) as 0/1; a missing value is 0.

    Thresholds default to the per-station P95 of the panel. ``fit_until`` fits the
    quantile on days before that date only (avoids the label leak of fitting on the
    test period, trap T3); None keeps the whole-period behaviour.

    By default the quantile is a window aggregate over ``partitionBy(station)``: it
    shares the Exchange + Sort of the per-station feature windows (one pass over
    the panel, no second derivation of it and no join back); on the dense calendar
    each partition is bounded by the number of days. An explicit ``thresholds``
    table (one row per station) is joined instead.
    """
    lab = F.coalesce((F.col(value_col) > F.col("threshold")), F.lit(False)).cast("int")
    if thresholds is None:
        v = F.col(value_col)
        if fit_until is not None:
            v = F.when(F.col("obs_date") < F.lit(fit_until).cast("date"), v)
        thr = F.percentile(v, q).over(Window.partitionBy("station"))
        return panel.withColumn("threshold", thr).withColumn(out, lab)
    return panel.join(thresholds.select("station", "threshold"), on="station", how="left") \
        .withColumn(out, lab)


def compare_thresholds(panel: DataFrame, q: float = 0.95, fixed=(150.0, 50.0),
                       value_col: str = "rain_mm") -> DataFrame:
    """Extreme-day counts and shares under the quantile rule and fixed mm rules.

    One aggregate pass per station computes the quantile; a second pass counts
    exceedances of every rule at once (rules are columns, then unpivoted)."""
    v = F.col(value_col)
    w = Window.partitionBy("station")  # one pass: quantiles as station windows
    joined = panel.withColumns({"thr_q": F.percentile(v, q).over(w),
                                "thr_q_wet": F.percentile(F.when(v > 0, v), q).over(w)})
    rules = {"p": F.col("thr_q")}
    for t in fixed:
        rules[f"mm{int(t)}"] = F.lit(float(t))
    aggs = [F.count(v).alias("n_valid"), F.first("thr_q").alias("thr_q"),
            F.first("thr_q_wet").alias("thr_q_wet")]
    aggs += [F.count_if(v > r).alias(f"n_{name}") for name, r in rules.items()]
    per = joined.groupBy("station").agg(*aggs)
    structs = [F.struct(F.lit(name).alias("rule"),
                        (F.col("thr_q") if name == "p" else F.lit(float(name[2:]))).alias("threshold"),
                        F.col(f"n_{name}").alias("n_extreme"),
                        (F.col(f"n_{name}") * 100.0 / F.col("n_valid")).alias("pct_extreme"))
               for name in rules]
    return per.select("station", "thr_q_wet", F.inline(F.array(*structs)))
