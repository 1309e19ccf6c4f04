"""Additive per-row attribution for boosted-tree models.

M8 computes exact Shapley values of the model margin with the path-dependent
conditional expectation (a split on a feature outside the coalition averages its
children by training cover). A tree is the sum of its leaves, and a leaf's game knows only
the m features on its path: feature j lets through z_j (its share of training cover along
the path) outside the coalition and o_j (1 where the row takes all its turns, else 0) inside. The
coefficients of prod_j (z_j + o_j t) count coalitions by size; they are extended feature by feature,
and one feature is unwound at a time to weigh the coalitions without it. That is
leaves x depth^2 operations, each for a whole Arrow batch of rows at once with numpy. The node table of
the fitted model (trees × nodes, a few KB) is read from its saved Parquet data and
shipped to the tasks; rows are processed by ``mapInPandas`` where they live.
Σ φ + base = margin holds exactly (up to float rounding).
"""

from __future__ import annotations

import math
import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.session import ensure_checkpoint_dir


def tree_tables(gbt_model) -> tuple[list[dict], list[float]]:
    """Node tables of a fitted GBT model (saved to the shared checkpoint folder and
    read back as a DataFrame - the public, documented persistence format)."""
    est = gbt_model.stages[-1] if hasattr(gbt_model, "stages") else gbt_model
    ss = SparkSession.getActiveSession()
    path = os.path.join(ensure_checkpoint_dir(ss), f"tree-model-{uuid.uuid4().hex}")
    est.write().overwrite().save(path)
    rows = ss.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.get(F.col("nodeData.impurityStats"), 0).alias("cover"),
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold")).collect()
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r.treeID, {})[r.id] = (r.prediction, r.cover, r.leftChild, r.rightChild,
                                                r.featureIndex, r.threshold)
    order = sorted(trees)
    return [trees[t] for t in order], list(est.treeWeights)


def leaf_paths(nodes: dict):
    """(value, {feature: (z, turns)}) of every leaf of a tree; turns are (threshold, whether to its left)."""
    def walk(nid, path):
        value, cover, left, right, feat, thr = nodes[nid]
        if left < 0:
            yield value, path
            return
        both = nodes[left][1] + nodes[right][1]
        for child, is_left in ((left, True), (right, False)):
            z, turns = path.get(feat, (1.0, ()))
            yield from walk(child, path | {feat: (z * nodes[child][1] / both, (*turns, (thr, is_left)))})

    yield from walk(0, {})


def extended(z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Coefficients of prod_j (z_j + o_j t), lowest first; z: m numbers, o: m x rows."""
    poly = np.zeros((len(z) + 1, o.shape[1]))
    poly[0] = 1.0
    for j in range(len(z)):
        poly[1:j + 2] = z[j] * poly[1:j + 2] + o[j] * poly[:j + 1]
        poly[0] *= z[j]
    return poly


def unwound(poly: np.ndarray, z: float, o: np.ndarray) -> np.ndarray:
    """``poly`` without one factor z + o t: from the highest power where o is 1, divided by z where it is 0."""
    out = np.empty((poly.shape[0] - 1, poly.shape[1]))
    rest = poly[-1]
    for k in range(out.shape[0] - 1, -1, -1):
        out[k] = np.where(o > 0, rest, poly[k] / z)
        rest = poly[k] - z * rest
    return out


def shapley_batch(trees, weights, X: np.ndarray, n_features: int):
    """(phi[n, p], base, margin[n]) for a batch of rows."""
    phi, base, margin = np.zeros((X.shape[0], n_features)), 0.0, np.zeros(X.shape[0])
    for nodes, w in zip(trees, weights):
        for value, path in leaf_paths(nodes):
            feats, m = list(path), len(path)
            z = np.array([path[f][0] for f in feats])
            o = np.array([np.logical_and.reduce([(X[:, f] <= thr) == is_left for thr, is_left in path[f][1]]) for f in feats], dtype=float).reshape(m, X.shape[0])
            base += w * value * z.prod()
            margin += w * value * o.prod(axis=0)
            share = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
            poly = extended(z, o)
            for j, f in enumerate(feats):
                without = unwound(poly, z[j], o[j]) if z[j] > 0 else extended(np.delete(z, j), np.delete(o, j, axis=0))
                phi[:, f] += w * value * (o[j] - z[j]) * (share @ without)
    return phi, base, margin


def tree_attribution(model, df: DataFrame, features, keep=("obs_date", "station")) -> DataFrame:
    """M8: per-row attribution ``phi_<feature>`` plus ``base`` and ``margin``."""
    return attribute(*tree_tables(model), df, features, keep)


def attribute(trees, weights, df: DataFrame, features, keep=("obs_date", "station")) -> DataFrame:
    """M8 for node tables: a tree is {id: (value, cover, left, right, feature, threshold)} with root 0 and
    left -1 at a leaf; rows go left up to the threshold."""
    features = list(features)
    keep = [c for c in keep if c in df.columns]
    p = len(features)

    def run(batches):
        for pdf in batches:
            X = pdf[features].to_numpy(dtype="float64")
            phi, base, margin = shapley_batch(trees, weights, X, p)
            out = pdf[keep + features].copy()
            for j, c in enumerate(features):
                out[f"phi_{c}"] = phi[:, j]
            out["base"] = base
            out["margin"] = margin
            yield out

    fields = [df.schema[c].simpleString() for c in keep + features]
    schema = ", ".join(fields + [f"phi_{c} double" for c in features] + ["base double", "margin double"])
    return df.select(*keep, *features).mapInPandas(run, schema)


def attribution_summary(attr: DataFrame, features) -> DataFrame:
    """M9: mean |phi| per feature and its share (%) of the total, largest first."""
    long = attr.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"phi_{c}").alias("phi"))
                                          for c in features])))
    per = long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    tot = per.agg(F.sum("mean_abs")).scalar()
    return per.select("feature", "mean_abs", (F.col("mean_abs") * 100.0 / tot).alias("share_pct"))


def attribution_direction(attr: DataFrame, features) -> DataFrame:
    """Correlation of each feature's value with its attribution; positive →
    high values push towards an extreme day. NULL (undefined) for a constant."""
    long = attr.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"),
                                                   F.col(f"phi_{c}").alias("phi")) for c in features])))
    per = long.groupBy("feature").agg(F.corr("x", "phi").alias("corr"))
    c = F.col("corr")
    return per.withColumn("direction", F.when(c > 0, "up=extreme").when(c < 0, "up=normal"))


def compare_attribution(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per earlier-claimed feature: old share, new share (text "N/A" when the
    feature is no longer in the model)."""
    j = old.select("feature", F.col("share_pct").alias("old_share")).join(
        new.select("feature", F.col("share_pct").alias("new_share")), "feature", "left")
    return j.withColumn("new_share_text", F.coalesce(F.format_number("new_share", 2), F.lit("N/A")))
