"""Exact k-nearest-neighbour join on dense feature vectors by pivots.

Both sides are dealt into the cells of the pivot nearest to each row (at most ``PIVOTS`` right rows, one
for each ``block`` of them, by hash). Of a cell the driver learns only its number of rows, its radius
and the distances of its k nearest rows to the pivot. With the distances of the pivots these bound, for each left
cell, how far its rows' k nearest right rows can be (triangle inequality); a right row is
sent to the left cells that it can be that near to, and to no other. So work and shuffle follow the
number of copies (``replicated``), not |L|·|R|, where the rows cluster, and no neighbour is lost.

A cell of any size - one pivot may be nearest to a third of all rows - is cut into tiles of at most about
``block`` left and right rows, each one cogroup task that computes Euclidean distances with numpy
and emits its local top-k per left row; a ``row_number <= k`` over (distance, right id) merges
them (no pair rows).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlens.session import cut_lineage

NB_SCHEMA = "lid long, rid long, dist double"
PIVOTS = 256
SLACK = 1e-9  # distances and bounds round differently


def _kernel(features, k: int, exclude_self: bool):
    fl = [f"l_{c}" for c in features]
    fr = [f"r_{c}" for c in features]

    def run(_key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"lid": pd.Series(dtype="int64"), "rid": pd.Series(dtype="int64"),
                                 "dist": pd.Series(dtype="float64")})
        right = right.sort_values("rid", kind="stable")
        L = left[fl].to_numpy(dtype="float64")
        R = right[fr].to_numpy(dtype="float64")
        sq = np.zeros((L.shape[0], R.shape[0]))
        for j in range(L.shape[1]):
            d = L[:, j][:, None] - R[:, j][None, :]
            sq = sq + d * d
        dist = np.sqrt(sq)
        lid = left["lid"].to_numpy()
        rid = right["rid"].to_numpy()
        if exclude_self:
            dist = np.where(lid[:, None] == rid[None, :], np.inf, dist)
        kk = min(k, R.shape[0])
        order = np.argsort(dist, axis=1, kind="stable")[:, :kk]
        dsel = np.take_along_axis(dist, order, axis=1)
        rows, ranks = np.nonzero(np.isfinite(dsel))
        return pd.DataFrame({"lid": lid[rows], "rid": rid[order[rows, ranks]], "dist": dsel[rows, ranks]})
    return run


def _to_pivots(X: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((X[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))


def _in_cells(df: DataFrame, id_col: str, features: list[str], pivots: np.ndarray) -> DataFrame:
    """(id, features, cell, away): the nearest pivot of every row and its distance."""
    def run(batches):
        for pdf in batches:
            d = _to_pivots(pdf[features].to_numpy(dtype="float64"), pivots)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell.astype("int32"), away=d[np.arange(len(d)), cell])

    rows = df.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in features])
    schema = "id long, " + ", ".join(f"`{c}` double" for c in features) + ", cell int, away double"
    return cut_lineage(rows.mapInPandas(run, schema))


def _windows(left: DataFrame, right: DataFrame, pivots: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) distance to its pivot at which a row of right cell j can be among the k nearest of a row of left cell
    i. A few numbers a cell come to the driver."""
    known = F.col("away").isNotNull() & ~F.isnan("away")
    left, right = left.filter(known), right.filter(known)  # a row without some feature has no neighbours
    radius = np.full(len(pivots), -np.inf)
    for r in left.groupBy("cell").agg(F.max("away").alias("radius")).collect():
        radius[r["cell"]] = r["radius"]
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("away"))
    inner = right.select("cell", "away").withColumn("rank", rank).filter(F.col("rank") <= k).collect()
    between = _to_pivots(pivots, pivots)
    reach = np.full(len(pivots), np.inf)
    if len(inner) >= k:
        j, away = np.array([r["cell"] for r in inner]), np.array([r["away"] for r in inner])
        reach = np.sort(radius[:, None] + between[:, j] + away[None, :], axis=1)[:, k - 1]
    slack = SLACK * (1 + between + np.maximum(radius, 0)[:, None] * 2)
    out = (radius + reach)[:, None]
    return np.where(np.isneginf(radius)[:, None], np.inf, between - out - slack), between + out + slack


def _sent(right: DataFrame, least: np.ndarray, most: np.ndarray, features: list[str]) -> DataFrame:
    """The right rows, once for each left cell (``cell``) that they are sent to."""
    def run(batches):
        for pdf in batches:
            away, own = pdf["away"].to_numpy(), pdf["cell"].to_numpy()
            to, row = np.nonzero((away >= least[:, own]) & (away <= most[:, own]))
            yield pdf.iloc[row].assign(cell=to.astype("int32"))

    return right.mapInPandas(run, right.schema)


def _cells(left: DataFrame, right: DataFrame, left_id: str, right_id: str, features: list[str], k: int, block: int):
    """(left rows with their cell, copies of right rows with the cell they are sent to)."""
    n = right.count()
    some = right.select(*[F.col(c).cast("double").alias(c) for c in features]).dropna() \
        .orderBy(F.xxhash64(*[F.col(c).cast("double") for c in features])).limit(max(1, min(PIVOTS, n // block)))
    pivots = np.unique(np.array([list(r) for r in some.collect()], dtype="float64").reshape(-1, len(features)), axis=0)  # at most PIVOTS rows
    if not len(pivots):
        pivots = np.zeros((1, len(features)))
    left, right = _in_cells(left, left_id, features, pivots), _in_cells(right, right_id, features, pivots)
    return left, cut_lineage(_sent(right, *_windows(left, right, pivots, k), features))


def replicated(left: DataFrame, right: DataFrame, left_id: str, right_id: str, features, k: int = 5, exclude_self: bool = False, block: int = 2048) -> float:
    """Copies sent per right row."""
    return _cells(left, right, left_id, right_id, list(features), k + exclude_self, block)[1].count() / max(1, right.count())


def knn_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, features, k: int = 5,
             exclude_self: bool = False, block: int = 2048) -> DataFrame:
    """Rows (lid, rid, dist, rank) - the k nearest right rows of every left row
    (ties by right id). Ids must be integral."""
    features = list(features)
    left, right = _cells(left, right, left_id, right_id, features, k + exclude_self, block)
    tiles = {}  # a row a cell: into how many blocks each side is cut
    for side, df in (("l", left), ("r", right)):
        for r in df.groupBy("cell").count().collect():
            tiles.setdefault(r["cell"], {})[side] = max(1, math.ceil(r["count"] / block))
    table = F.create_map(*[F.lit(x) for cell, t in tiles.items() for x in (cell, t.get("l", 1) * 1_000_000 + t.get("r", 1))] or [F.lit(0), F.lit(1_000_001)])
    size = F.element_at(table, F.col("cell"))
    nl, nr = F.floor(size / 1_000_000), size % 1_000_000
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    lx = left.select(F.col("id").alias("lid"), *[F.col(c).alias(f"l_{c}") for c in features], "cell", F.pmod(F.xxhash64("id"), nl.cast("long")).alias("lb"), every(nr).alias("rb"))
    rx = right.select(F.col("id").alias("rid"), *[F.col(c).alias(f"r_{c}") for c in features], F.col("cell").alias("rcell"),
                      F.pmod(F.xxhash64("id"), nr.cast("long")).alias("rrb"), every(nl).alias("rlb"))
    cands = lx.groupBy("cell", "lb", "rb").cogroup(rx.groupBy("rcell", "rlb", "rrb")) \
        .applyInPandas(_kernel(features, k, exclude_self), NB_SCHEMA)
    w = Window.partitionBy("lid").orderBy("dist", "rid")
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
