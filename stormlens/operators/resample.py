"""SMOTE over-sampling of the minority class (E10), deterministic.

For synthetic row i (0 ≤ i < n_majority − n_minority):
  base      = minority row number (i mod n_min) in id order,
  neighbour = its ((i div n_min) mod k + 1)-th nearest minority row (ties by id),
  λ         = ((i · 7919) mod 1000) / 1000,
  x_new     = x_base + λ · (x_neighbour − x_base).
The neighbour lists come from the tiled exact KNN join; synthetic indices are a
distributed ``range``; everything else is equi-joins. Training rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlens.operators.neighbours import knn_join
from stormlens.operators.prep import bucketed_rank
from stormlens.session import cut_lineage


def smote(train: DataFrame, features, id_col: str, label: str = "label", k: int = 5,
          block: int = 2048) -> DataFrame:
    """Returns ``train`` ∪ synthetic minority rows (``synthetic`` = 1 on new rows)."""
    features = list(features)
    spark = train.sparkSession
    # the training rows are read by the class counts, the neighbour search and the
    # final union: materialise them once in the shared checkpoint folder.
    train = cut_lineage(train)
    minority = train.filter(F.col(label) == 1).select(F.col(id_col).cast("long").alias("_id"), *features)
    counts = train.groupBy(label).count().collect()
    n = {r[0]: r[1] for r in counts}
    n_min, n_maj = n.get(1, 0), sum(v for c, v in n.items() if c != 1)
    base_rows = train.withColumn("synthetic", F.lit(0))
    n_new = n_maj - n_min
    if n_new <= 0:
        return base_rows.withColumn("_syn_index", F.lit(None).cast("long"))
    if n_min <= k:
        raise ValueError(f"{k} neighbours need at least {k + 1} minority rows, there are {n_min}")
    kk = k
    lo, hi = minority.agg(F.min("_id"), F.max("_id")).first()
    width = max(1, (hi - lo + 1) // max(16, -(-n_min // 50_000)) + 1)
    idx = bucketed_rank(minority, "_id", F.floor((F.col("_id") - F.lit(lo)) / F.lit(width))) \
        .withColumn("_idx", F.col("_rank") - 1).drop("_rank")
    nbrs = knn_join(minority, minority, "_id", "_id", features, k=kk, exclude_self=True, block=block)

    i = F.col("id")
    syn = spark.range(n_new).select(
        i.alias("_i"), (i % n_min).alias("_idx"), ((F.floor(i / n_min) % kk) + 1).cast("int").alias("rank"),
        ((i * 7919) % 1000 / 1000.0).alias("_lam"))
    base = idx.select("_idx", F.col("_id").alias("lid"), *[F.col(c).alias(f"_b_{c}") for c in features])
    nb = nbrs.select("lid", "rank", "rid")
    other = minority.select(F.col("_id").alias("rid"), *[F.col(c).alias(f"_n_{c}") for c in features])
    j = syn.join(base, "_idx").join(nb, ["lid", "rank"]).join(other, "rid")
    new = j.select(*[(F.col(f"_b_{c}") + F.col("_lam") * (F.col(f"_n_{c}") - F.col(f"_b_{c}"))).alias(c)
                     for c in features], F.lit(1).cast(train.schema[label].dataType).alias(label),
                   F.lit(1).alias("synthetic"), F.col("_i").alias("_syn_index"))
    return base_rows.unionByName(new, allowMissingColumns=True)
