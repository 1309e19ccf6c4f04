"""Model preparation: exact scalers, one-hot, time-ordered splits and folds,
class weights (E1-E9, E11).

Scalers follow the fit/transform pattern: ``fit_*`` runs ONE aggregate job and
returns a handful of numbers per column (like an MLlib estimator's summary);
``apply_*`` is then a pure column expression, code-generated, no join.

Orderings that must be global use per-bucket counts instead of one sort: the
k-th distinct date comes from one aggregate by year (``distinct_dates``), exact quantiles
from sketches and counts (``quantiles``); row ranks for stratified folds and the hide
mask use ``bucketed_rank`` (buckets monotone in the order key, per-bucket counts
give each bucket's offset, rows ranked inside their bucket) - no step sorts
everything in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlens.operators.quantiles import ACCURACY, column_quantiles

# --- exact scalers ------------------------------------------------------------------

def exact_quantiles(df: DataFrame, cols, probs, accuracy: int = ACCURACY) -> dict:
    """{column: [exact linear quantiles]}, None for a column without values (``quantiles.column_quantiles``)."""
    return column_quantiles(df, cols, probs, accuracy)


def fit_robust(fit_df: DataFrame, cols) -> dict:
    """E1 fit: exact median and IQR (linear quantiles) per column."""
    out = {}
    for c, q in exact_quantiles(fit_df, cols, (0.25, 0.5, 0.75)).items():
        iqr = None if q[0] is None else q[2] - q[0]
        out[c] = (q[1], iqr if iqr else 1.0)  # zero spread → scale 1
    return out


def fit_minmax(fit_df: DataFrame, cols) -> dict:
    row = fit_df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols],
                     *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        lo, hi = row[f"mn_{c}"], row[f"mx_{c}"]
        out[c] = (lo, (hi - lo) if (lo is not None and hi != lo) else 1.0)
    return out


def fit_standard(fit_df: DataFrame, cols) -> dict:
    """E3 fit: mean and POPULATION standard deviation."""
    row = fit_df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}


def apply_scaler(df: DataFrame, params: dict, suffix: str = "") -> DataFrame:
    """(x − centre) / scale for every fitted column."""
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(centre)) / F.lit(scale)
                           for c, (centre, scale) in params.items()})


def robust_scale(fit_df: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """Fit on ``fit_df`` (e.g. the training period) and apply to ``df``."""
    return apply_scaler(df, fit_robust(fit_df, cols), suffix)


def minmax_scale(fit_df: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x − min) / (max − min); a constant column maps to 0."""
    return apply_scaler(df, fit_minmax(fit_df, cols), suffix)


def standard_scale(fit_df: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x − mean) / population std."""
    return apply_scaler(df, fit_standard(fit_df, cols), suffix)


def scaler_sensitivity(df: DataFrame, cols) -> DataFrame:
    """Maximum scaled value per column under each scaler (outlier sensitivity)."""
    scaled = [("robust", robust_scale(df, df, cols)), ("minmax", minmax_scale(df, df, cols)),
              ("standard", standard_scale(df, df, cols))]
    out = None
    for name, s in scaled:
        row = s.agg(*[F.max(c).alias(c) for c in cols]).withColumn("method", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


# --- encoding -------------------------------------------------------------------------

def one_hot(df: DataFrame, cols, levels: dict | None = None, prefix: dict | None = None) -> DataFrame:
    """E5: one 0/1 column per level (no level dropped), named ``<prefix>_<level>``
    in sorted level order. ``levels`` may be given; otherwise the distinct values
    are read with one small aggregate (category sets are tiny)."""
    levels = dict(levels or {})
    prefix = prefix or {}
    for c in cols:
        if c not in levels:
            levels[c] = sorted(r[0] for r in df.select(c).distinct().collect() if r[0] is not None)
    new = {}
    for c in cols:
        p = prefix.get(c, c)
        for lv in sorted(levels[c]):
            new[f"{p}_{lv}"] = (F.col(c) == F.lit(lv)).cast("int")
    return df.withColumns(new)


# --- global ranks without a global sort -----------------------------------------------

def bucketed_rank(df: DataFrame, order_col, bucket: Column, partition_cols=()) -> DataFrame:
    """Adds ``_rank`` (1-based, ties broken by the order column or columns only, so pass a
    unique order key) = rows before the row's bucket + row number inside it.

    ``bucket`` must be non-decreasing in ``order_col``."""
    parts = list(partition_cols)
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*parts, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(wo), F.lit(0))).drop("_cnt")
    rn = F.row_number().over(Window.partitionBy(*parts, "_bucket").orderBy(*([order_col] if isinstance(order_col, str) else order_col)))
    return b.withColumn("_rn", rn).join(offsets, [*parts, "_bucket"]) \
        .withColumn("_rank", F.col("_off") + F.col("_rn")).drop("_off", "_rn", "_bucket")


def ranked_dates(df: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """Distinct dates with their 1-based rank, bucketed by year."""
    d = df.select(date_col).distinct()
    return bucketed_rank(d, date_col, F.year(date_col))


def distinct_dates(df: DataFrame, date_col: str = "obs_date") -> list:
    """The distinct dates in order: one aggregate, one row a calendar year (366 dates at most)."""
    rows = df.groupBy(F.year(date_col)).agg(F.collect_set(date_col).alias("d")).collect()
    return sorted(d for r in rows for d in r["d"])


def split_date(df: DataFrame, frac: float = 0.8, date_col: str = "obs_date"):
    """The cut date = the (int(n·frac)+1)-th smallest distinct date (one value)."""
    dates = distinct_dates(df, date_col)
    k = int(len(dates) * frac)
    return dates[k] if k < len(dates) else None


def date_split(df: DataFrame, frac: float = 0.8, date_col: str = "obs_date") -> DataFrame:
    """``split`` = train (date < cut) / test (date >= cut); all stations of a
    date stay on the same side. The cut date is fitted once (one aggregate job, one
    value) and applied as a literal, so later date filters prune and push down."""
    cut = split_date(df, frac, date_col)
    c = F.lit(cut) if cut is not None else F.lit(None).cast("date")
    return df.withColumns({"cut_date": c,
                           "split": F.when(F.col(date_col) < c, "train").otherwise("test")})


def class_weights(df: DataFrame, label: str = "label", mode: str = "balanced",
                  out: str = "weight") -> DataFrame:
    """``balanced`` → n / (2·n_class) per row; ``ratio`` → positives get neg/pos
    (scale_pos_weight), negatives 1. Class counts are a 2-row aggregate, broadcast."""
    # fit: the class counts (one small aggregate, one row per class)
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    n = sum(counts.values())
    pos = counts.get(1, 0)
    neg = n - pos
    y = F.col(label)
    if mode == "balanced":
        expr = None
        for cls, nc in counts.items():
            expr = (F.when(y == F.lit(cls), F.lit(n / (2.0 * nc))) if expr is None
                    else expr.when(y == F.lit(cls), F.lit(n / (2.0 * nc))))
        w = expr if expr is not None else F.lit(None).cast("double")
    else:
        w = F.when(y == 1, F.lit(neg / pos if pos else None)).otherwise(F.lit(1.0))
    return df.withColumn(out, w)


def time_folds(df: DataFrame, n_splits: int = 5, date_col: str = "obs_date") -> DataFrame:
    """Expanding-window folds over DISTINCT dates (T5): test blocks of
    ``n_dates // (n_splits+1)`` dates at the end; fold i trains on every earlier
    date. Adds ``fold`` (0..n_splits-1 for test blocks, -1 for train-only dates)."""
    # fit: the first date of every test block (n_splits values), then a literal CASE
    dates = distinct_dates(df, date_col)
    ts = len(dates) // (n_splits + 1)
    start = len(dates) - ts * n_splits
    bounds = [dates[start + i * ts] if start + i * ts < len(dates) else None for i in range(n_splits)]
    d = F.col(date_col)
    fold = F.lit(-1)
    for i, b in enumerate(bounds):
        fold = F.when(d >= F.lit(b), F.lit(i)).otherwise(fold)
    return df.withColumn("fold", fold.cast("int"))


def fold_train_test(folded: DataFrame, i: int):
    """(train, test) of fold i: test = fold i; train = every date before it."""
    test = folded.filter(F.col("fold") == i)
    train = folded.filter(F.col("obs_date") < test.agg(F.min("obs_date")).scalar())
    return train, test


def portable_hash(key: Column, seed=0) -> Column:
    """Deterministic 0..10006 hash from an integer key, identical in SQL engines."""
    s = seed if isinstance(seed, Column) else F.lit(seed)
    return F.pmod(F.pmod(key, F.lit(10007)) * F.lit(7919) + s, F.lit(10007))


ROWS_PER_BUCKET = 50_000


def _hash_places(df: DataFrame, key: str, h: Column) -> Column:
    """A bucket number that rises with (hash, key) and holds about ``ROWS_PER_BUCKET`` rows: ranges of hashes, and where
    one hash value has more rows than that, ranges of the key within it, so buckets don't grow with the rows."""
    n, lo, hi = df.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    wanted = max(16, -(-n // ROWS_PER_BUCKET))
    if wanted <= 10007:
        return F.floor(h * wanted / 10007)
    parts = -(-wanted // 10007)
    place = F.floor((F.col(key).cast("double") - float(lo)) / (float(hi) - float(lo) + 1) * parts)
    return h * parts + F.least(F.greatest(place, F.lit(0)), F.lit(parts - 1))


def stratified_folds(df: DataFrame, key: str, label: str = "label", k: int = 5, seed: int = 0) -> DataFrame:
    """Stratified shuffled k folds. Within each class, rows are ordered by a
    portable hash (then the key) and dealt round-robin into k folds, so every fold
    gets floor/ceil(n_class / k) rows of each class. The rank is bucketed by hash and key
    ranges whose number follows the row count, so the hot majority class is ranked
    by many tasks. Any key of an integer type will do."""
    h = portable_hash(F.col(key), seed)
    r = bucketed_rank(df.withColumn("_h", h), ["_h", key], _hash_places(df, key, F.col("_h")), [label])
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")


def hide_mask(df: DataFrame, key: str, cols, frac: float = 0.1, seed: int = 0) -> DataFrame:
    """Per column, hide exactly floor(frac·n) values (chosen by a portable hash
    order, without replacement). Adds ``hide_<col>`` 0/1 flags.

    All columns are ranked in ONE pass: the keys are repeated once per column
    (long form), ranked with ``bucketed_rank`` partitioned by column, and the
    flags pivoted back with an explicit column list."""
    cols = list(cols)
    keys = df.select(key).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))))
    h = portable_hash(F.col(key), F.lit(seed) + F.lit(101) * (F.col("_c") + 1))
    r = bucketed_rank(keys.withColumn("_h", h), ["_h", key], _hash_places(df, key, F.col("_h")), ["_c"])
    n = df.agg(F.count(F.lit(1))).scalar()
    flags = r.withColumn("_hide", (F.col("_rank") <= F.floor(n * frac)).cast("int")) \
        .groupBy(key).pivot("_c", list(range(len(cols)))).agg(F.first("_hide"))
    flags = flags.select(key, *[F.col(f"`{i}`").alias(f"hide_{c}") for i, c in enumerate(cols)])
    return df.join(flags, key, "left")
