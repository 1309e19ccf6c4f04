"""Leak-free time-series features on the long (station, obs_date) panel (W1-W11,
J5, J6, U3-U5).

All per-station features share ONE window spec, so Catalyst plans a single
Exchange(station) + Sort(station, obs_date) for the whole feature block. On the
dense grid every station has exactly one row per calendar day, so a window
partition is bounded by the calendar length, not by the raw volume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormlens.functions.calendar import add_calendar


def station_window(station_col: str = "station", date_col: str = "obs_date"):
    return Window.partitionBy(station_col).orderBy(date_col)


def add_lags(panel: DataFrame, lags=(1, 2, 3), value_col: str = "rain_mm",
             prefix: str = "lag") -> DataFrame:
    """Value k rows (= days on the dense grid) earlier."""
    w = station_window()
    return panel.withColumns({f"{prefix}{k}": F.lag(value_col, k).over(w) for k in lags})


_ROLL_FN = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


LINEAR_FROM = 64


def add_rolling(panel: DataFrame, windows=(7, 30, 365), fn: str = "mean",
                value_col: str = "rain_mm", prefix: str | None = None, linear_from: int = LINEAR_FROM) -> DataFrame:
    """Aggregate of the PREVIOUS n days (today excluded), NULLs skipped,
    NULL only when all n are missing (``min_periods=1``).

    A sliding frame is evaluated anew for every row, n values each time. Windows of ``linear_from`` days and
    more take a constant number of steps a row instead: sums and means are differences of running sums (kept as
    decimals of ten digits, so nothing is lost by the difference), maxima and minima join the running
    extreme from the end of one block of n rows with that from the beginning of the next."""
    w = station_window()
    agg = _ROLL_FN[fn]
    prefix = prefix or {"mean": "roll", "max": "max", "min": "min", "sum": "sum"}[fn]
    short = [n for n in windows if n < linear_from]
    out = panel.withColumns({f"{prefix}{n}": agg(value_col).over(w.rowsBetween(-n, -1)) for n in short})
    for n in (n for n in windows if n >= linear_from):
        if fn in ("mean", "sum"):
            out = _rolled_sum(out, n, fn, value_col, f"{prefix}{n}")
        else:
            out = _rolled_extreme(out, n, agg, F.greatest if fn == "max" else F.least, value_col, f"{prefix}{n}")
    return out.select(*panel.columns, *[f"{prefix}{n}" for n in windows])


def _rolled_sum(panel: DataFrame, n: int, fn: str, value_col: str, out: str) -> DataFrame:
    w = station_window()
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = panel.withColumns({"_s": F.sum(F.col(value_col).cast("decimal(28,10)")).over(upto), "_c": F.count(value_col).over(upto)})
    within = lambda c: F.coalesce(F.lag(c, 1).over(w), F.lit(0)) - F.coalesce(F.lag(c, n + 1).over(w), F.lit(0))
    run = run.withColumns({"_s": within("_s"), "_c": within("_c")})
    total = F.col("_s").cast("double")
    return run.withColumn(out, F.when(F.col("_c") > 0, total / F.col("_c") if fn == "mean" else total)).drop("_s", "_c")


def _rolled_extreme(panel: DataFrame, n: int, agg, join, value_col: str, out: str) -> DataFrame:
    w = station_window()
    blocks = panel.withColumn("_pos", F.row_number().over(w)).withColumn("_block", F.floor((F.col("_pos") - 1) / n))
    inside = Window.partitionBy("station", "_block")  # clustered by station already: no further exchange
    upto = lambda order: inside.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = blocks.withColumn("_from", agg(value_col).over(upto(F.desc("_pos")))).withColumn("_to", agg(value_col).over(upto(F.asc("_pos"))))
    return run.withColumn(out, join(F.lag("_from", n).over(w), F.lag("_to", 1).over(w))).drop("_pos", "_block", "_from", "_to")


def add_trend(panel: DataFrame, a: str = "lag1", b: str = "lag2", out: str = "trend") -> DataFrame:
    """W4."""
    return panel.withColumn(out, F.col(a) - F.col(b))


def _run_before(flag_break: Column, first_null: bool) -> Column:
    """Length of the run of consecutive rows strictly before the current one in
    which ``flag_break`` is false. Computed as (rows before) − (position of the last
    breaking row before), a running max - no per-row loop and no island ids."""
    w = station_window()
    pos = F.row_number().over(w)
    last_break = F.max(F.when(flag_break, pos)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = (pos - F.lit(1) - F.coalesce(last_break, F.lit(0))).cast("int")
    return F.when(pos > 1, run) if first_null else run


def add_wet_run(panel: DataFrame, gt: float = 0.0, value_col: str = "rain_mm",
                out: str = "consec_rain") -> DataFrame:
    """Consecutive wet days (value > gt) before today; missing counts as dry;
    first row 0."""
    wet = F.coalesce(F.col(value_col) > F.lit(gt), F.lit(False))
    return panel.withColumn(out, _run_before(~wet, first_null=False))


def add_dry_run(panel: DataFrame, wet_above: float = 0.1, value_col: str = "rain_mm",
                out: str = "dry_days") -> DataFrame:
    """Consecutive dry days (value <= 0.1 or missing) up to yesterday; first
    row NULL."""
    wet = F.coalesce(F.col(value_col) > F.lit(wet_above), F.lit(False))
    return panel.withColumn(out, _run_before(wet, first_null=True))


def run_before_chunked(panel: DataFrame, flag_break: Column, out: str, first_null: bool,
                       chunk_days: int = 3650, date_col: str = "obs_date") -> DataFrame:
    """W5/W6 on (station, time chunk) window partitions with a two-pass carry.

    Pass 1 (inside each chunk): the last breaking day strictly before the row.
    Pass 2 (a stations × chunks summary table): the last breaking day of all
    earlier chunks and the station's first day, joined back by (station, chunk).
    The run is then (day − 1 − last break) in calendar days - equal to the row
    count on the dense calendar, so exact, with no window spanning a whole
    station history."""
    day = F.datediff(F.col(date_col), F.lit("1970-01-01"))
    p = panel.withColumns({"_day": day, "_chunk": F.floor(day / chunk_days), "_brk": flag_break})
    w = Window.partitionBy("station", "_chunk").orderBy(date_col)
    p = p.withColumn("_lb", F.max(F.when(F.col("_brk"), F.col("_day"))).over(
        w.rowsBetween(Window.unboundedPreceding, -1)))
    summ = p.groupBy("station", "_chunk").agg(F.max(F.when(F.col("_brk"), F.col("_day"))).alias("_cb"),
                                              F.min("_day").alias("_c0"))
    ws = Window.partitionBy("station").orderBy("_chunk")
    summ = summ.select("station", "_chunk",
                       F.max("_cb").over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
                       F.min("_c0").over(Window.partitionBy("station")).alias("_first"))
    j = p.join(summ, ["station", "_chunk"], "left")
    last = F.coalesce(F.col("_lb"), F.col("_carry"), F.col("_first") - 1)
    run = (F.col("_day") - F.lit(1) - last).cast("int")
    if first_null:
        run = F.when(F.col("_day") > F.col("_first"), run)
    return j.withColumn(out, run).drop("_day", "_chunk", "_brk", "_lb", "_carry", "_first")


def add_interaction(panel: DataFrame, a: str = "nbr_lag1_avg", b: str = "roll7",
                    out: str = "spatial_x_roll7") -> DataFrame:
    """W7."""
    return panel.withColumn(out, F.col(a) * F.col(b))


def chunked(panel: DataFrame, fn, halo: int, chunk_days: int = 3650, date_col: str = "obs_date") -> DataFrame:
    """Run a bounded-lookback feature block ``fn`` on (station, time chunk) partitions.

    Every row is assigned to its chunk of ``chunk_days`` calendar days; the last
    ``halo`` days of each chunk are also copied into the next chunk as look-back
    context. ``fn`` runs unchanged with the station key replaced by
    ``station#chunk`` (so its window partitions are chunk-sized and spread over
    more tasks), then the context copies are dropped. Exact for every feature whose
    look-back is at most ``halo`` rows on the dense calendar (lags, rolling means /
    maxima up to ``halo`` days); not for unbounded run lengths."""
    day = F.datediff(F.col(date_col), F.lit("1970-01-01"))
    chunk = F.floor(day / chunk_days)
    in_halo = (day - chunk * chunk_days) >= (chunk_days - halo)
    homes = F.when(in_halo, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    ex = panel.withColumns({"_home": chunk, "_station": F.col("station")}) \
        .withColumn("_chunk", F.explode(homes)) \
        .withColumn("station", F.concat_ws("#", F.col("_station"), F.col("_chunk").cast("string")))
    out = fn(ex)
    return out.filter(F.col("_chunk") == F.col("_home")) \
        .withColumn("station", F.col("_station")).drop("_home", "_chunk", "_station")


# --- neighbours -------------------------------------------------------------

def neighbour_mean(panel: DataFrame, cols, members=None, targets=None,
                   suffix: str = "_avg", prefix: str = "nbr_") -> DataFrame:
    """Mean over the OTHER member stations of the same day, NULLs skipped.

    ``members`` is the neighbour set (None = every station). The three neighbour
    definitions in use are all "members except myself": (a) the other targets, (b)
    every non-target station, (c) every other station. Instead of expanding
    (station, neighbour) pairs, the members' sum and count per day are window
    aggregates over ``partitionBy(obs_date)`` and each row removes its own
    contribution: ``(Σ − own) / (n − own_present)``. One exchange on the date; on
    the dense calendar every date partition holds exactly one row per station, so
    no date can be hot. ``targets`` restricts the output rows (None = all).
    """
    is_member = F.lit(True) if members is None else F.col("station").isin(list(members))
    w = Window.partitionBy("obs_date")
    new = {}
    for c in cols:
        own = F.when(is_member & F.col(c).isNotNull(), F.col(c))
        n = F.count(F.when(is_member, F.col(c))).over(w) - F.when(own.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        s_ = F.sum(F.when(is_member, F.col(c))).over(w) - F.coalesce(own, F.lit(0.0))
        new[f"{prefix}{c}{suffix}"] = F.when(n > 0, s_ / n)
    out = panel.withColumns(new)
    return out if targets is None else out.filter(F.col("station").isin(list(targets)))


def neighbour_mean_edges(panel: DataFrame, edges: DataFrame, cols,
                         prefix: str = "nbr_", suffix: str = "_avg") -> DataFrame:
    """W8 with an explicit neighbour map ``edges(station, neighbour)``.

    The edge table is given data (e.g. a JSON map exploded to rows); the join emits
    one row per (edge, day) - proportional to the map the user supplied, never all
    pairs of stations."""
    nb = panel.select(F.col("station").alias("neighbour"), "obs_date",
                      *[F.col(c).alias(f"_nb_{c}") for c in cols])
    means = (edges.select("station", "neighbour").join(nb, on="neighbour")
             .groupBy("station", "obs_date")
             .agg(*[F.avg(f"_nb_{c}").alias(f"{prefix}{c}{suffix}") for c in cols]))
    return panel.join(means, on=["station", "obs_date"], how="left")


def edges_from_map(spark, neighbour_map: dict) -> DataFrame:
    """``{station: [neighbours]}`` → edge rows (station, neighbour)."""
    rows = [(s, n) for s, ns in neighbour_map.items() for n in ns]
    return spark.createDataFrame(rows, "station string, neighbour string")


# --- standard feature block ---------------------------------------------------

def build_features(panel: DataFrame, targets=None, members=None, value_col: str = "rain_mm",
                   lags=(1, 2, 3), rolls=(7, 30), extra: bool = False) -> DataFrame:
    """Calendar + lags + rolling means (+ trend, wet run, max3 when ``extra``), then
    neighbour means of lag1 and roll7 (and max3)."""
    p = add_calendar(panel)
    p = add_lags(p, lags, value_col)
    p = add_rolling(p, rolls, "mean", value_col)
    nbr_cols = ["lag1", "roll7"]
    if extra:
        p = add_rolling(p, (3,), "max", value_col)
        p = add_trend(p)
        p = add_wet_run(p, value_col=value_col)
        nbr_cols.append("max3")
    return neighbour_mean(p, nbr_cols, members=members, targets=targets)


def features_with_seed(history: DataFrame, future: DataFrame, seed_days: int = 30,
                       value_col: str = "rain_mm", **kw) -> DataFrame:
    """Recompute features for future days from the last ``seed_days`` of history.

    The seed is the last ``seed_days`` calendar days before the first future day
    (per station); features are computed over seed ∪ future and seed rows dropped."""
    # one row per station: joined without a hint - AQE broadcasts it only when the
    # measured size is small and keeps a sort-merge join otherwise
    first_future = future.groupBy("station").agg(F.min("obs_date").alias("_f0"))
    seed = (history.join(first_future, on="station")
            .filter((F.col("obs_date") < F.col("_f0"))
                    & (F.col("obs_date") >= F.date_sub(F.col("_f0"), seed_days)))
            .drop("_f0").withColumn("_seed", F.lit(True)))
    fut = future.withColumn("_seed", F.lit(False))
    both = seed.select("station", "obs_date", value_col, "_seed") \
        .unionByName(fut.select("station", "obs_date", value_col, "_seed"))
    return build_features(both, value_col=value_col, **kw).filter(~F.col("_seed")).drop("_seed")


# --- day over day ---------------------------------------------------------------

def day_over_day(panel: DataFrame, date, value_col: str = "rain_mm") -> DataFrame:
    """Per station, yesterday's and today's value and the change (missing → 0),
    plus the change class of the mean change (>5 rising, <−5 falling, else stable)."""
    d = F.lit(date).cast("date")
    two = panel.filter(F.col("obs_date").between(F.date_sub(d, 1), d))
    per = two.groupBy("station").agg(
        F.coalesce(F.max(F.when(F.col("obs_date") == d, F.col(value_col))), F.lit(0.0)).alias("today"),
        F.coalesce(F.max(F.when(F.col("obs_date") == F.date_sub(d, 1), F.col(value_col))),
                   F.lit(0.0)).alias("yesterday"))
    per = per.withColumn("change", F.col("today") - F.col("yesterday"))
    # The labels of the change classes (rising, falling, stable).
    # Network mean change as a scalar subquery (computed once, inlined).
    m = per.agg(F.avg("change")).scalar()
    return per.withColumn("mean_change", m).withColumn(
        "trend_class", F.when(F.col("mean_change") > 5, "naik")
        .when(F.col("mean_change") < -5, "turun").otherwise("stabil"))


# --- reshape --------------------------------------------------------------------

def to_wide(panel: DataFrame, stations, value_col: str = "rain_mm", agg: str = "avg",
            key: str = "obs_date") -> DataFrame:
    """Long → wide with an EXPLICIT station list (no extra distinct job)."""
    fn = {"avg": F.avg, "first": F.first, "sum": F.sum}[agg]
    return panel.groupBy(key).pivot("station", list(stations)).agg(fn(value_col))


def to_long(wide: DataFrame, stations, key: str = "obs_date", value_col: str = "rain_mm") -> DataFrame:
    """U4: wide → long, one row per (key, station)."""
    return wide.unpivot([key], list(stations), "station", value_col)


def unpivot_forecast(wide: DataFrame, stations, key: str = "obs_date",
                     value_col: str = "rain_mm") -> DataFrame:
    """U5 + I9: uploaded wide forecast → long; an absent station column or an
    empty cell counts as 0 mm."""
    filled = wide.withColumns({s: (F.coalesce(F.col(f"`{s}`").cast("double"), F.lit(0.0))
                                   if s in wide.columns else F.lit(0.0)) for s in stations})
    return filled.unpivot([key], list(stations), "station", value_col)


def any_of(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)
