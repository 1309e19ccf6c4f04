"""Exact quantiles of raw values for any number of groups of any size (used by A1, A2, E1).

One aggregate brings, with whatever else is wanted, a mergeable quantile sketch a group
(``percentile_approx``: partial sketches in every task, rank error at most n / ``ACCURACY``). Read a
little below and above a wanted rank, it brackets the rank between two values; a group of up to
``ACCURACY`` values is bracketed by its least and greatest. A second pass counts what lies
below each bracket and, value by value, what lies inside - partial counts again, so equal values and all that
is below are one row a task - and running sums over the values inside settle the rank. No task holds a group's
values, only those of a bracket (some 8 n / ``ACCURACY``), however they are spread.

Quantiles interpolate linearly between the ranks around p (n - 1). Nulls and NaN are no values; a group
without values gets nulls. A rank outside its bracket, which the sketch's bound excludes, would raise an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlens.session import cut_lineage

ACCURACY = 10_000
FEW_GROUPS = 50_000


def _value(col: Column) -> Column:
    v = col.cast("double")
    return F.when(~F.isnan(v), v)


def sketch(col: Column, probs: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """An aggregate: struct (n, lo, hi), the number of values and a bracket of each wanted rank."""
    v, slack = _value(col), 4.0 / accuracy
    at = F.percentile_approx(v, [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs], accuracy)
    few = F.count(v) <= accuracy
    lo = [F.when(few | F.lit(p <= slack), F.min(v)).otherwise(F.get(at, F.lit(i))) for i, p in enumerate(probs)]
    hi = [F.when(few | F.lit(p >= 1 - slack), F.max(v)).otherwise(F.get(at, F.lit(len(probs) + i))) for i, p in enumerate(probs)]
    return F.struct(F.count(v).alias("n"), F.array(*lo).alias("lo"), F.array(*hi).alias("hi"))


def _places(v: Column, lo: Column, hi: Column, i: Column) -> Column:
    """Where a value stands for wanted rank i: (i, its value) inside the bracket, (i, null) below, null above."""
    return F.when(v < F.get(lo, i), F.struct(i.alias("i"), F.lit(None).cast("double").alias("x"))) \
        .when(v <= F.get(hi, i), F.struct(i.alias("i"), v.alias("x")))


def settled(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, i, q) from counted places (keys, n, i, x, c)."""
    p = F.get(F.array(*map(F.lit, map(float, probs))), F.col("i"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "i").orderBy(F.col("x").asc_nulls_first()))
    at = p * (F.col("n") - 1)
    k = F.floor(at)
    found = counts.withColumn("_upto", upto).withColumn("_at", at).withColumn("_k", k).withColumn("_next", F.least(k + 1, F.col("n") - 1))
    q = found.groupBy(*keys, "i").agg(
        F.min(F.when(F.col("_upto") > F.col("_k"), F.col("x"))).alias("_a"), F.min(F.when(F.col("_upto") > F.col("_next"), F.col("x"))).alias("_b"),
        F.max(F.when(F.col("x").isNull(), F.col("_upto"))).alias("_below"), F.first("_k").alias("_k"), F.first(F.col("_at") - F.col("_k")).alias("_part"))
    outside = (F.coalesce("_below", F.lit(0)) > F.col("_k")) | F.col("_b").isNull()
    value = F.when(outside, F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part"))
    return q.select(*keys, "i", value.alias("q"))


def quantiles_by(df: DataFrame, by: Sequence[str], col: Column, probs: Sequence[float], *extra: Column, accuracy: int = ACCURACY) -> DataFrame:
    """(by, extra aggregates, q): one row a group, ``q`` the array of its exact quantiles. The first pass is written
    to the checkpoint folder; its rows are broadcast to the second only if they are few."""
    keys = [f"_by{j}" for j in range(len(by))]
    rows = df.withColumns({k: F.col(b) for k, b in zip(keys, by)} | {"_v": _value(col)})
    groups = cut_lineage(rows.groupBy(*keys).agg(*extra, sketch(F.col("_v"), probs, accuracy).alias("_s")))
    bracket = groups.select(*[F.col(k).alias(f"{k}_") for k in keys], "_s")
    if groups.count() <= FEW_GROUPS:
        bracket = F.broadcast(bracket)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    values = rows.filter("_v is not null").select(*keys, "_v")
    joined = values.join(bracket, same) if keys else values.join(bracket)
    places = F.array_compact(F.array(*[_places(F.col("_v"), F.col("_s.lo"), F.col("_s.hi"), F.lit(i)) for i in range(len(probs))]))
    counts = joined.select(*keys, F.col("_s.n").alias("n"), F.inline(places)).groupBy(*keys, "n", "i", "x").agg(F.count("*").alias("c"))
    q = settled(counts, keys, probs).groupBy(*[F.col(k).alias(f"{k}_") for k in keys]) \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda s: s["q"]).alias("q"))
    names = [c for c in groups.columns if c not in (*keys, "_s")]
    out = groups.join(q, same, "left") if keys else groups.join(q, F.lit(True), "left")
    return out.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], *names, "q")


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> dict:
    """{column: [exact quantiles]} of whole columns; None for a column without values. One row of sketches and
    at most a value a rank come to the driver."""
    cols, probs = list(cols), list(probs)
    if not cols:
        return {}
    row = df.agg(*[sketch(F.col(c), probs, accuracy).alias(f"_s{j}") for j, c in enumerate(cols)]).first()
    known = [(j, c, row[j]) for j, c in enumerate(cols) if row[j]["n"]]
    out = {c: [None] * len(probs) for c in cols}
    if known:
        places = [F.struct(F.lit(j).alias("j"), F.lit(s["n"]).cast("long").alias("n"), place["i"].alias("i"), place["x"].alias("x"), place.isNotNull().alias("there"))
                  for j, c, s in known for i in range(len(probs))
                  for place in [_places(_value(F.col(c)), F.array(*map(F.lit, s["lo"])), F.array(*map(F.lit, s["hi"])), F.lit(i))]]
        counts = df.select(F.inline(F.filter(F.array(*places), lambda x: x["there"]))).groupBy("j", "n", "i", "x").agg(F.count("*").alias("c"))
        for r in settled(counts, ["j"], probs).collect():
            out[cols[r["j"]]][r["i"]] = r["q"]
    return out
