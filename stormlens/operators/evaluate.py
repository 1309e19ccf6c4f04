"""Evaluation of scored rows ``(label 0/1, proba)``.

Thresholds are handled as integer hundredths (T13): ``proba >= c / 100``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SWEEP = tuple(range(5, 100, 5))  # 0.05 … 0.95


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _metric_cols(tp: Column, fp: Column, fn: Column, tn: Column) -> dict:
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return {"accuracy": _safe_div(tp + tn, tp + fp + fn + tn), "precision": prec, "recall": rec,
            "f1": _safe_div(2 * prec * rec, prec + rec)}


def confusion(pred: DataFrame, t: float = 0.5, label: str = "label", proba: str = "proba",
              by=None) -> DataFrame:
    """V1: TP / FP / FN / TN at ``proba >= t`` in one aggregate pass."""
    y, p = F.col(label) == 1, F.col(proba) >= F.lit(t)
    g = pred.groupBy(*([] if by is None else [by] if isinstance(by, str) else by))
    return g.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def binary_metrics(pred: DataFrame, t: float = 0.5, by=None, **kw) -> DataFrame:
    """V2: accuracy, precision, recall, F1 (zero division → 0) plus the counts."""
    c = confusion(pred, t, by=by, **kw)
    return c.withColumns(_metric_cols(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def class_report(pred: DataFrame, t: float = 0.5, **kw) -> DataFrame:
    """V3: per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages - one row each, computed from a single confusion pass."""
    c = confusion(pred, t, **kw)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * p1 * r1, p1 + r1), _safe_div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _safe_div(tp + tn, n)
    null = F.lit(None).cast("double")
    rows = [("0", p0, r0, f1_0, s0), ("1", p1, r1, f1_1, s1), ("accuracy", null, null, acc, n),
            ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
            ("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
             _safe_div(f1_0 * s0 + f1_1 * s1, n), n)]
    structs = [F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return c.select(F.inline(F.array(*structs)))


def period_metrics(pred: DataFrame, start, end, t: float = 0.5, date_col: str = "obs_date") -> DataFrame:
    """V4: metrics over a date period plus the number of distinct days in it."""
    sub = pred.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    n_days = sub.agg(F.count_distinct(date_col)).scalar()
    return binary_metrics(sub, t).withColumn("n_days", n_days)


def threshold_sweep(pred: DataFrame, cents=DEFAULT_SWEEP, label: str = "label",
                    proba: str = "proba") -> DataFrame:
    """V5: confusion counts and metrics for every threshold ``c/100`` in one pass.

    Each row is bucketed by how many thresholds it clears (exact comparisons,
    code-generated); a (bucket, label) count table of at most len(cents)+1 × 2
    rows is the only thing shuffled; cumulative sums over it give TP/FP for every
    threshold. Cost is one scan regardless of the number of thresholds.
    """
    cents = sorted(cents)
    p = F.col(proba)
    bucket = reduce(lambda a, b: a + b, [(p >= F.lit(c / 100.0)).cast("int") for c in cents])
    counts = pred.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    spark = pred.sparkSession
    nb = len(cents)
    zeros = spark.createDataFrame([(b, 0, 0) for b in range(nb + 1)], "bucket int, pos long, neg long")
    full = counts.unionByName(zeros).groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # rows clearing threshold j are those with bucket >= j: cumulative sums from the
    # top bucket down, over a table of len(cents)+1 rows (a bounded single task).
    down = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    cum = full.select("bucket", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
                      F.sum("pos").over(every).alias("P"), F.sum("neg").over(every).alias("N"))
    thr = spark.createDataFrame([(i + 1, c) for i, c in enumerate(cents)], "bucket int, cents int")
    out = thr.join(cum, "bucket")
    out = out.withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    m = _metric_cols(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return out.select((F.col("cents") / 100.0).alias("threshold"), m["precision"].alias("precision"),
                      m["recall"].alias("recall"), m["f1"].alias("f1"),
                      F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                      F.col("fn").cast("long").alias("fn"), F.col("tn").cast("long").alias("tn"),
                      (F.col("tp") + F.col("fp")).cast("long").alias("total_alert"))


RULES = ("max_f1", "recall50_max_precision", "recall50_last", "recall70_min_fp", "default")


def pick_threshold(sweep: DataFrame, rule: str) -> DataFrame:
    """One sweep row chosen by a named rule, deterministic on ties.

    max_f1                  highest F1, lowest threshold on ties
    recall50_max_precision  among recall >= .5, highest precision, lowest threshold on ties
    recall50_last           the highest threshold with recall >= .5
    recall70_min_fp         among recall >= .7, fewest false positives, lowest threshold on ties
    default                 the row at 0.5
    """
    t = F.col("threshold")
    if rule == "default":
        return sweep.filter(F.round(t * 100) == 50)
    if rule == "max_f1":
        sub, key = sweep, F.struct(F.col("f1"), -t)
    elif rule == "recall50_max_precision":
        sub, key = sweep.filter(F.col("recall") >= 0.5), F.struct(F.col("precision"), -t)
    elif rule == "recall50_last":
        sub, key = sweep.filter(F.col("recall") >= 0.5), F.struct(t)
    elif rule == "recall70_min_fp":
        sub, key = sweep.filter(F.col("recall") >= 0.7), F.struct(-F.col("fp"), -t)
    else:
        raise ValueError(rule)
    best = sub.agg(F.max(key).alias("_best"))
    return sub.join(best, key == F.col("_best")).drop("_best")


def compare_models(metrics: DataFrame, baseline: str) -> DataFrame:
    """V7: metric rows of several models / feature sets with the F1 and recall
    change against a baseline model (its values as scalar subqueries)."""
    base = metrics.filter(F.col("model") == baseline)
    bf1, brec = base.agg(F.max("f1")).scalar(), base.agg(F.max("recall")).scalar()
    return metrics.select(*metrics.columns, (F.col("f1") - bf1).alias("delta_f1"),
                          (F.col("recall") - brec).alias("delta_recall"))


def best_model(metrics: DataFrame, metric: str = "f1") -> DataFrame:
    """The model with the highest metric (first by name on ties): a global
    min over (−metric, model) and a join back - no un-partitioned window."""
    best = metrics.agg(F.min(F.struct((-F.col(metric)).alias("m"), F.col("model"))).alias("_b"))
    return metrics.join(best, F.col("model") == F.col("_b.model")).drop("_b")


def rmse(df: DataFrame, truth: str, estimate: str, by=None) -> DataFrame:
    """V8."""
    g = df.groupBy(*([] if by is None else [by] if isinstance(by, str) else by))
    return g.agg(F.sqrt(F.avg(F.pow(F.col(estimate) - F.col(truth), 2))).alias("rmse"),
                 F.count(F.lit(1)).alias("n"))
