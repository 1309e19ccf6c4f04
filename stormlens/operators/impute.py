"""Gap filling (I4 KNN imputation, I6 linear interpolation, I7 back-test).

KNN imputation (I4) - semantics
-------------------------------
Rows are day-vectors over the stations. For a receiver day missing station c, the
donors are the days on which c is present; the distance is the NaN-aware Euclidean
``sqrt(p / m · Σ (r_j − d_j)²)`` over the m stations present on both days (p =
number of stations; undefined when m = 0). The k nearest donors (ties by date)
are averaged with weights 1/d; if any chosen donor is at distance 0 only the
zero-distance donors count. With no donor at a defined distance the column mean
is used. Imputed values are clipped at 0.

KNN imputation - execution plan
-------------------------------
* identical day-vectors are reduced to at most k representatives (earliest dates)
  by ``row_number <= k`` per vector, planned as a partial WindowGroupLimit before
  the shuffle - the all-dry vector that covers a large share of days never lands
  whole in one task;
* donors, and receivers (distinct vectors with a gap), are packed into blocks of
  ``block`` rows of one region, equal patterns of present stations and neighbours
  on a space-filling curve together; a block is one record with the least and greatest
  value and the number of values of each station (its box);
* the gaps between two boxes, at the stations that all their rows have, bound the
  distance of all their rows from below. First every receiver block meets
  only its nearest donor blocks, as many as hold k donors of each missing station;
  the k-th distance found there, per receiver block and station, bounds what a
  further donor must beat, and only the donor blocks whose box is that near are
  searched next (equal bounds too, as ties go by date). Blocks that can't hold a
  neighbour are never read with a receiver: no donor is skipped by a cap;
* a task searches one receiver block and the donor blocks it is paired with (packed
  records, no pair rows) in numpy and emits k candidates per (receiver, station); a
  ``row_number <= k`` over (distance, date) merges both passes, then a weighted mean
  and a join back.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlens.operators.features import to_long, to_wide
from stormlens.operators.prep import hide_mask
from stormlens.session import cut_lineage


def _vec_key(cols):
    return F.to_json(F.array(*[F.col(f"`{c}`") for c in cols]))


def _topk(R: np.ndarray, D: np.ndarray, rkeys: np.ndarray, dates: np.ndarray, k: int) -> pd.DataFrame:
    """Exact top-k donors per (receiver, missing column) for one tile.

    ``D`` rows must be sorted by ``dates`` (stable argsort then breaks distance ties
    by date). Distances are accumulated column by column, left to right - the same
    summation order as the SQL oracle."""
    p = R.shape[1]
    pr, pd_ = ~np.isnan(R), ~np.isnan(D)
    sq = np.zeros((R.shape[0], D.shape[0]))
    m = np.zeros((R.shape[0], D.shape[0]), dtype=np.int32)
    for j in range(p):
        both = pr[:, j][:, None] & pd_[:, j][None, :]
        diff = np.where(both, R[:, j][:, None] - D[:, j][None, :], 0.0)
        sq = sq + np.where(both, diff * diff, 0.0)
        m = m + both
    with np.errstate(divide="ignore", invalid="ignore"):
        dist = np.where(m > 0, np.sqrt((p / np.maximum(m, 1)) * sq), np.inf)
    out = []
    for c in range(p):
        ri = np.flatnonzero(~pr[:, c])
        di = np.flatnonzero(pd_[:, c])
        if ri.size == 0 or di.size == 0:
            continue
        sub = dist[np.ix_(ri, di)]
        kk = min(k, di.size)
        order = np.argsort(sub, axis=1, kind="stable")[:, :kk]
        dsel = np.take_along_axis(sub, order, axis=1)
        rows, ranks = np.nonzero(np.isfinite(dsel))
        didx = di[order[rows, ranks]]
        out.append(pd.DataFrame({"rkey": rkeys[ri[rows]], "col": np.int32(c),
                                 "dist": dsel[rows, ranks], "ddate": dates[didx].astype("int32"),
                                 "val": D[didx, c]}))
    return pd.concat(out, ignore_index=True) if out else None


CAND_SCHEMA = "region string, rkey string, col int, dist double, ddate int, val double"
BLOCK_SCHEMA = "region string, side string, block long, n int, names array<string>, dates array<int>, vals array<double>, " \
    "lo array<double>, hi array<double>, have array<int>"
BLOCK = 64
SLACK = 1e-9  # bounds and distances round differently
CUTS = [i / 16 for i in range(1, 16)]


def _packed(vectors: DataFrame, block: int) -> DataFrame:
    """One record per block of (region, side, name, ddate, vec) rows: ``block`` vectors of one region and
    side in the order of their patterns of present stations, then of a curve that interleaves
    the bits of the values' sixteenths at their station (where a block is cut changes how much is
    pruned, not the result). A region has at most one vector per calendar day, which bounds the window."""
    places = vectors.filter("side = 'd'").select("region", F.posexplode("vec").alias("j", "v")).groupBy("region", "j") \
        .agg(F.percentile_approx("v", CUTS, 1000).alias("cuts")).groupBy(F.col("region").alias("_region")) \
        .agg(F.array_sort(F.collect_list(F.struct("j", "cuts"))).alias("_cuts"))
    level = F.zip_with("vec", "_cuts", lambda v, c: F.size(F.filter(c["cuts"], lambda x: x < v)))
    pattern = F.array_join(F.transform("vec", lambda v: v.isNotNull().cast("int").cast("string")), "")
    curve = F.concat(*[F.array_join(F.transform("_level", lambda x: F.shiftright(x, bit).bitwiseAND(F.lit(1)).cast("string")), "") for bit in (3, 2, 1, 0)])
    place = F.row_number().over(Window.partitionBy("region", "side").orderBy("_pattern", "_curve", "ddate", "name"))
    rows = vectors.join(places, F.col("region") == F.col("_region")).withColumn("_pattern", pattern).withColumn("_level", level).withColumn("_curve", curve) \
        .withColumn("block", F.floor((place - 1) / block)).select("region", "side", "block", "name", "ddate", "vec")

    def pack(key, rows):
        rows = rows.sort_values(["ddate", "name"], kind="stable")
        V = np.array([np.asarray(v, dtype="float64") for v in rows["vec"]], dtype="float64")
        seen = [c[~np.isnan(c)] for c in V.T]
        return pd.DataFrame({"region": [key[0]], "side": [key[1]], "block": [key[2]], "n": [len(rows)], "names": [rows["name"].tolist()],
                             "dates": [rows["ddate"].tolist()], "vals": [V.ravel()], "lo": [[c.min() if c.size else None for c in seen]],
                             "hi": [[c.max() if c.size else None for c in seen]], "have": [[c.size for c in seen]]})

    blocks = rows.groupBy("region", "side", "block").applyInPandas(pack, BLOCK_SCHEMA)
    return blocks.withColumn("box", F.arrays_zip("lo", "hi", "have")).drop("lo", "hi", "have")


def _box_bound(a, an, b, bn):
    """Lower bound of the distance of any row of one box to any row of the other: the gaps at stations
    that all rows of both have, over as many stations as any two rows can share; NULL where they share none."""
    gap = F.aggregate(F.zip_with(a, b, lambda x, y: F.when((x["have"] == an) & (y["have"] == bn), F.greatest(F.lit(0.0), y["lo"] - x["hi"], x["lo"] - y["hi"])).otherwise(0.0)),
                      F.lit(0.0), lambda s, g: s + g * g)
    share = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x["have"] > 0) & (y["have"] > 0)), lambda both: both))
    return F.when(share > 0, F.sqrt(F.size(a) / share * gap) * (1 - SLACK))


def _block_pairs(receivers: DataFrame, donors: DataFrame) -> DataFrame:
    """(region, rblock, dblock, nr, nd, bound, cols) for the pairs of blocks of a region whose rows can share a
    station; ``cols`` are the stations (col, miss, have) that ``miss`` receivers lack and ``have`` donors have."""
    r = receivers.select("region", F.col("block").alias("rblock"), F.col("n").alias("nr"), F.col("box").alias("rbox"))
    d = donors.select("region", F.col("block").alias("dblock"), F.col("n").alias("nd"), F.col("box").alias("dbox"))
    cols = F.filter(F.zip_with("rbox", F.transform("dbox", lambda y, j: F.struct(j.alias("col"), y["have"].alias("have"))), lambda x, y: F.struct(
        y["col"].alias("col"), (F.col("nr") - x["have"]).alias("miss"), y["have"].alias("have"))), lambda c: (c["miss"] > 0) & (c["have"] > 0))
    return r.join(d, "region").withColumn("bound", _box_bound(F.col("rbox"), F.col("nr"), F.col("dbox"), F.col("nd"))).withColumn("cols", cols) \
        .filter(F.col("bound").isNotNull() & (F.size("cols") > 0)).drop("rbox", "dbox")


PAIR = ["region", "rblock", "dblock"]


def _nearest_blocks(pairs: DataFrame, k: int) -> DataFrame:
    """For every receiver block and missing station, the donor blocks of least bound that hold k donors."""
    each = pairs.select(*PAIR, "nr", "nd", "bound", F.inline("cols"))
    before = Window.partitionBy("region", "rblock", "col").orderBy("bound", "dblock").rowsBetween(Window.unboundedPreceding, -1)
    near = each.withColumn("_before", F.coalesce(F.sum("have").over(before), F.lit(0))).filter(F.col("_before") < k)
    return near.select(*PAIR, "nr", "nd").distinct()


def _further_blocks(pairs: DataFrame, near: DataFrame, found: DataFrame, receivers: DataFrame, k: int) -> DataFrame:
    """The pairs that may still hold one of the k nearest: their bound is not above the k-th distance
    found so far for some receiver of the block and station (no limit where fewer than k were found)."""
    rank = F.row_number().over(Window.partitionBy("region", "rkey", "col").orderBy("dist", "ddate"))
    kth = found.withColumn("_r", rank).filter(F.col("_r") == k).select("region", "rkey", "col", "dist")
    members = receivers.select("region", F.col("block").alias("rblock"), F.explode("names").alias("rkey"))
    limit = members.join(kth, ["region", "rkey"]).groupBy("region", "rblock", "col").agg(F.count("*").alias("_full"), F.max("dist").alias("_limit"))
    open_ = pairs.join(near.select(*PAIR), PAIR, "left_anti").select(*PAIR, "nr", "nd", "bound", F.inline("cols")) \
        .join(limit, ["region", "rblock", "col"], "left") \
        .filter(F.col("_limit").isNull() | (F.col("_full") < F.col("miss")) | (F.col("bound") <= F.col("_limit")))
    return open_.select(*PAIR, "nr", "nd").distinct()


def _searched(pairs: DataFrame, receivers: DataFrame, donors: DataFrame, k: int) -> DataFrame:
    """The k nearest donors of every receiver and missing station, among the donor blocks that its block is paired
    with. A task holds one receiver block and at most its region's donors."""
    r = receivers.select("region", F.col("block").alias("rblock"), F.col("names").alias("rnames"), F.col("vals").alias("rvals"))
    d = donors.select(F.col("region").alias("_region"), F.col("block").alias("_block"), F.col("dates").alias("ddates"), F.col("vals").alias("dvals"))
    asked = pairs.join(d, (F.col("region") == F.col("_region")) & (F.col("dblock") == F.col("_block"))) \
        .select(F.col("region").alias("_region"), F.col("rblock").alias("_rblock"), "ddates", "dvals")

    def search(key, rec, don):
        out = None
        if len(rec) and len(don):
            names = np.array(rec["rnames"][0], dtype=object)
            R = np.array(rec["rvals"][0], dtype="float64").reshape(len(names), -1)
            dates = np.concatenate(don["ddates"].tolist())
            D = np.concatenate(don["dvals"].tolist()).astype("float64").reshape(len(dates), -1)
            order = np.argsort(dates, kind="stable")
            out = _topk(R, D[order], names, dates[order], k)
        if out is None:
            out = pd.DataFrame({"rkey": np.array([], object), "col": np.array([], "int32"), "dist": np.array([], float), "ddate": np.array([], "int32"), "val": np.array([], float)})
        out.insert(0, "region", np.array([key[0]] * len(out), dtype=object))
        return out.astype({"region": object, "rkey": object})

    return r.groupBy("region", "rblock").cogroup(asked.groupBy("_region", "_rblock")).applyInPandas(search, CAND_SCHEMA)


def _candidates(receivers: DataFrame, donors: DataFrame, k: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(candidates, searched pairs of blocks): the k nearest donors of every (receiver, missing station) are
    among the candidates. ``receivers``: (region, name, ddate, vec), distinct vectors; ``donors`` likewise."""
    both = receivers.withColumn("side", F.lit("r")).unionByName(donors.withColumn("side", F.lit("d")))
    packed = cut_lineage(_packed(both, block))
    receivers, donors = packed.filter("side = 'r'"), packed.filter("side = 'd'")
    pairs = cut_lineage(_block_pairs(receivers, donors))
    near = _nearest_blocks(pairs, k)
    first = cut_lineage(_searched(near, receivers, donors, k))
    more = _further_blocks(pairs, near, first, receivers, k)
    return first.unionByName(_searched(more, receivers, donors, k)), near.unionByName(more)


def knn_impute_wide(wide: DataFrame, cols, k: int = 5, block: int = BLOCK,
                    key: str = "obs_date", clip_min: float | None = 0.0) -> DataFrame:
    """I4 on a wide frame ``(key, c1..cp)``: returns the same frame with gaps filled."""
    cols = list(cols)
    p = len(cols)
    v = {c: f"v{j}" for j, c in enumerate(cols)}
    base = wide.select(F.col(key).alias("_key"), *[F.col(f"`{c}`").cast("double").alias(v[c]) for c in cols])
    vnames = [v[c] for c in cols]
    # The wide frame (one row per calendar day) is read by four consumers:
    # materialise it once in the shared checkpoint folder.
    base = cut_lineage(base.withColumn("rkey", _vec_key(vnames)))
    any_gap = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in vnames])
    # one job: column means over the whole frame (fallback when no donor has a
    # defined distance) and whether there is a gap
    stats = base.agg(*[F.avg(n).alias(n) for n in vnames], F.count_if(any_gap).alias("_gaps")).first()
    means = stats

    if stats["_gaps"] == 0:  # nothing to fill; the frame is clipped all the same
        return base.select(F.col("_key").alias(key), *[_clipped(F.col(v[c]), clip_min).alias(c) for c in cols])
    vec = base.select(F.lit("").alias("region"), F.col("_key").alias("obs_date"), F.array(*vnames).alias("vec"), "rkey", any_gap.alias("_gap"))
    cands, _ = _candidates(*_sides(vec, k), k, block)

    est = _weighted_estimates(cands, ["rkey"], k)
    est_wide = est.groupBy("rkey").pivot("col", list(range(p))).agg(F.first("est"))
    est_wide = est_wide.select("rkey", *[F.col(f"`{j}`").alias(f"e{j}") for j in range(p)])

    filled = base.join(est_wide, "rkey", "left")
    outs = []
    for j, c in enumerate(cols):
        mean = means[vnames[j]]
        fill = F.coalesce(F.col(f"e{j}"), F.lit(mean).cast("double"))
        val = F.when(F.col(vnames[j]).isNull(), fill).otherwise(F.col(vnames[j]))
        outs.append(_clipped(val, clip_min).alias(c))
    return filled.select(F.col("_key").alias(key), *outs)


def _clipped(value, clip_min: float | None):
    """I5, the one rule of every path: observed and filled values alike are at least ``clip_min``."""
    return value if clip_min is None else F.when(value.isNotNull(), F.greatest(value, F.lit(clip_min)))


def _weighted_estimates(cands: DataFrame, keys, k: int) -> DataFrame:
    """Merge tile candidates: top-k by (distance, date) per cell, 1/d weights (only
    zero-distance donors when any is at distance 0), weighted mean."""
    cell = [*keys, "col"]
    best = cands.withColumn("_r", F.row_number().over(Window.partitionBy(*cell).orderBy("dist", "ddate"))) \
        .filter(F.col("_r") <= k)
    has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy(*cell))
    w = F.when(has_zero == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    return best.withColumn("_w", w).groupBy(*cell).agg(
        (F.sum(F.col("_w") * F.col("val")) / F.sum("_w")).alias("est"))


def _sides(vec: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(receivers, donors) of the day-vectors (region, obs_date, vec, rkey, _gap): distinct vectors with a gap,
    and at most k representatives (earliest dates) of each vector."""
    day = F.datediff("obs_date", F.lit("1970-01-01"))
    rank = F.row_number().over(Window.partitionBy("region", "rkey").orderBy("obs_date"))
    donors = vec.withColumn("_r", rank).filter(F.col("_r") <= k).select("region", F.lit("").alias("name"), day.alias("ddate"), "vec")
    receivers = vec.filter("_gap").select("region", F.col("rkey").alias("name"), F.lit(0).alias("ddate"), "vec").distinct()
    return receivers, donors


def knn_search_report(panel: DataFrame, k: int = 5, block: int = BLOCK, value_col: str = "rain_mm") -> DataFrame:
    """How much of I4's search a panel (station, obs_date, value) needs: receivers x donors, and the pairs of rows
    whose distance is evaluated, with the packed rows that are sent for it."""
    cells = panel.select("station", "obs_date", F.col(value_col).cast("double").alias("_v"))
    vec = cells.groupBy("obs_date").agg(F.array_sort(F.collect_list(F.struct("station", "_v"))).alias("_s")) \
        .select(F.lit("").alias("region"), "obs_date", F.transform("_s", lambda x: x["_v"]).alias("vec"))
    vec = cut_lineage(vec.withColumn("rkey", F.to_json("vec")).withColumn("_gap", F.exists("vec", lambda x: x.isNull())))
    receivers, donors = _sides(vec, k)
    _, pairs = _candidates(receivers, donors, k, block)
    searched = pairs.agg(F.sum(F.col("nr").cast("long") * F.col("nd")).alias("evaluated_pairs"), F.sum(F.col("nr") + F.col("nd")).alias("packed_rows"), F.count("*").alias("block_pairs"))
    return receivers.agg(F.count("*").alias("receivers")).join(donors.agg(F.count("*").alias("donors"))).join(searched) \
        .withColumn("all_pairs", F.col("receivers") * F.col("donors"))


def knn_impute_regions(panel: DataFrame, region_col: str = "region", k: int = 5, block: int = BLOCK,
                       value_col: str = "rain_mm", clip_min: float | None = 0.0) -> DataFrame:
    """I4 for many regions at once, each imputed from its own stations only.

    A region's day-vector is an array over its stations (ordered by station id),
    built by one (region, day) aggregate - no wide pivot, so the number of regions
    and stations is unbounded; a vector holds one region's stations (and a region at
    most one vector per calendar day).
    Returns the panel with ``value_col`` filled and ``imputed`` flags.
    """
    base = panel.select(F.col(region_col).cast("string").alias("region"), "station", "obs_date",
                        F.col(value_col).cast("double").alias("_v"))
    by_region = Window.partitionBy("region")
    st = base.select("region", "station").distinct().withColumns({
        "_idx": (F.row_number().over(by_region.orderBy("station")) - 1).cast("int"),
        "_p": F.count(F.lit(1)).over(by_region).cast("int")})
    cells = cut_lineage(base.join(st, ["region", "station"]))
    vec = cells.groupBy("region", "obs_date").agg(
        F.collect_list(F.struct("_idx", "_v")).alias("_s"), F.max("_p").alias("_p"))
    # every place once: sorted pairs with an empty one for each place before its value; the last
    # pair of a place counts
    empty = F.transform(F.sequence(F.lit(0), F.col("_p") - 1), lambda i: F.struct(
        i.alias("_idx"), F.lit(None).cast("double").alias("_v")))
    vec = vec.withColumn("_s", F.array_sort(F.concat("_s", empty), lambda a, b: F.when(a["_idx"] != b["_idx"], a["_idx"] - b["_idx"])
                                            .otherwise(a["_v"].isNotNull().cast("int") - b["_v"].isNotNull().cast("int"))))
    last = F.filter("_s", lambda x, i: (i == F.size("_s") - 1) | (F.get("_s", i + 1)["_idx"] != x["_idx"]))
    vec = vec.select("region", "obs_date", F.transform(last, lambda x: x["_v"]).alias("vec"))
    vec = cut_lineage(vec.withColumn("rkey", F.to_json("vec")))

    gap = F.exists("vec", lambda x: x.isNull())
    cands, _ = _candidates(*_sides(vec.withColumn("_gap", gap), k), k, block)
    est = _weighted_estimates(cands, ["region", "rkey"], k)

    # back to (station, day): receiver days × their estimated columns
    filled = vec.filter(gap).select("region", "obs_date", "rkey").join(est, ["region", "rkey"]) \
        .join(st.select("region", F.col("_idx").alias("col"), "station"), ["region", "col"]) \
        .select("station", "obs_date", "est")
    means = cells.groupBy("station").agg(F.avg("_v").alias("_mean"))
    out = cells.join(filled, ["station", "obs_date"], "left").join(means, "station", "left")
    val = _clipped(F.coalesce(F.col("_v"), F.col("est"), F.col("_mean")), clip_min)
    return out.select(F.col("region").alias(region_col), "station", "obs_date", val.alias(value_col),
                      (F.col("_v").isNull() & val.isNotNull()).cast("int").alias("imputed"))


def knn_impute(panel: DataFrame, stations=None, k: int = 5, block: int = BLOCK,
               value_col: str = "rain_mm", clip_min: float | None = 0.0,
               region_col: str | None = None) -> DataFrame:
    """I4 on the long panel. With ``region_col`` every region is imputed from its
    own stations (``knn_impute_regions``); otherwise the explicit station list is
    pivoted, imputed and unpivoted. Adds ``imputed`` (1 where the value was filled)."""
    if region_col is not None:
        return knn_impute_regions(panel, region_col, k, block, value_col, clip_min)
    if stations is None:  # the whole panel is one region
        one = knn_impute_regions(panel.withColumn("_region", F.lit("all")), "_region", k, block,
                                 value_col, clip_min)
        return one.drop("_region")
    wide = to_wide(panel, stations, value_col)
    filled = knn_impute_wide(wide, stations, k, block, clip_min=clip_min)
    long = filled.unpivot(["obs_date"], list(stations), "station", "_v")
    return panel.join(long, ["station", "obs_date"], "left").select(
        "station", "obs_date", _clipped(F.coalesce(F.col(value_col).cast("double"), F.col("_v")), clip_min).alias(value_col),
        (F.col(value_col).isNull() & F.col("_v").isNotNull()).cast("int").alias("imputed"))


def interpolate_linear(panel: DataFrame, value_col: str = "rain_mm", by: str = "position",
                       out: str | None = None, part: str = "station", order: str = "obs_date") -> DataFrame:
    """Linear interpolation in both directions (edges take the nearest value).

    ``by='position'`` interpolates on row positions (as the original does on a
    row-compressed frame, T15); ``by='date'`` on calendar days. Uses the last /
    next non-null value and its position over two running frames per station."""
    w = Window.partitionBy(part).orderBy(order)
    pos = F.row_number().over(w) if by == "position" else F.datediff(F.col(order), F.lit("1970-01-01"))
    d = panel.withColumn("_pos", pos)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    # the next value seen from the other end: a growing frame, where a frame that reaches to
    # the end would be evaluated anew for every row
    fwd = Window.partitionBy(part).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(value_col)
    d = d.withColumns({
        "_pv": F.last(v, ignorenulls=True).over(back),
        "_pp": F.last(F.when(v.isNotNull(), F.col("_pos")), ignorenulls=True).over(back),
        "_nv": F.last(v, ignorenulls=True).over(fwd),
        "_np": F.last(F.when(v.isNotNull(), F.col("_pos")), ignorenulls=True).over(fwd)})
    interp = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (F.col("_pos") - F.col("_pp")) \
        / (F.col("_np") - F.col("_pp"))
    est = (F.when(v.isNotNull(), v).when(F.col("_pv").isNull(), F.col("_nv"))
           .when(F.col("_nv").isNull(), F.col("_pv")).otherwise(interp))
    return d.withColumn(out or value_col, est).drop("_pos", "_pv", "_pp", "_nv", "_np")


def imputation_backtest(wide: DataFrame, stations, frac: float = 0.1, k: int = 5, date_col: str = "obs_date") -> DataFrame:
    """On the days complete at every station, hide ``frac`` of each station's values, fill
    them by linear interpolation (row positions) and by KNN, and compare: RMSE of both per
    station, the better one, and a row ``mean`` over the stations."""
    st = list(stations)
    comp = wide.dropna(subset=st).withColumn("_day", F.datediff(date_col, F.lit("1970-01-01")))
    hidden = hide_mask(comp, "_day", st, frac)
    test = hidden.select(date_col, *[F.when(F.col(f"hide_{s}") == 1, None).otherwise(F.col(s)).alias(s) for s in st])
    truth = hidden.unpivot([date_col], st, "station", "v").join(
        hidden.select(date_col, *[F.col(f"hide_{s}").alias(s) for s in st])
        .unpivot([date_col], st, "station", "h"), [date_col, "station"]).filter("h = 1")
    lin = interpolate_linear(to_long(test, st, value_col="v"), "v", by="position", out="lin", order=date_col)
    knn = to_long(knn_impute_wide(test, st, k=k, key=date_col), st, value_col="knn")
    both = truth.join(lin.select("station", date_col, "lin"), [date_col, "station"]).join(knn, [date_col, "station"])
    per = both.groupBy("station").agg(
        F.sqrt(F.avg(F.pow(F.col("lin") - F.col("v"), 2))).alias("rmse_linear"),
        F.sqrt(F.avg(F.pow(F.col("knn") - F.col("v"), 2))).alias("rmse_knn"),
        F.count(F.lit(1)).alias("n_hidden"))
    best = F.when(F.col("rmse_knn") < F.col("rmse_linear"), "knn").otherwise("linear")
    mean = per.agg(F.lit("mean").alias("station"), F.avg("rmse_linear").alias("rmse_linear"),
                   F.avg("rmse_knn").alias("rmse_knn"), F.sum("n_hidden").alias("n_hidden"))
    return per.withColumn("best", best).unionByName(mean.withColumn("best", best))
