"""Class-weighted classifiers on Spark ML.

Every fit is a distributed Spark ML job (tree statistics / gradients are
aggregated across partitions); only the fitted model - a few KB - lives on the
driver. Feature vectors are assembled with ``VectorAssembler``.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormlens.session import cut_lineage


def _pipeline(features, estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features",
                                            handleInvalid="error"), estimator])


def fit_logistic(train: DataFrame, features, label: str = "label", weight: str = "weight",
                 max_iter: int = 1000) -> PipelineModel:
    """M1: L2 logistic regression with the objective of ``C=1`` and balanced weights.

    Spark minimises (1/Σs)·Σ s·loss + λ/2‖w‖²; the C=1 objective ½‖w‖² + Σ s·loss
    is the same up to the factor 1/Σs, hence λ = 1/Σs (standardisation off: the
    features are already robust-scaled)."""
    total_w = train.agg(F.sum(weight)).first()[0]
    lr = LogisticRegression(labelCol=label, weightCol=weight, regParam=1.0 / total_w, elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=1e-8)
    return _pipeline(features, lr).fit(train)


def fit_forest(train: DataFrame, features, label: str = "label", weight: str = "weight",
               num_trees: int = 100, max_depth: int = 5, min_instances: int = 10,
               seed: int = 42) -> PipelineModel:
    """M2: random forest with (balanced) instance weights."""
    rf = RandomForestClassifier(labelCol=label, weightCol=weight, numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_instances, seed=seed)
    return _pipeline(features, rf).fit(train)


#: P(X <= k) of a Poisson variable of mean 1, k = 0 to 9.
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
           0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.999998874797402, 0.9999998885745217)


def bag_draws(key, bags: int) -> Column:
    """How often a row is in each of ``bags`` bootstrap samples: Poisson numbers by a hash of its key and the bag, so a
    sample is the same however the rows lie, and no row moves for it."""
    def draws(b):
        u = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), b.cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
        return F.size(F.filter(F.array(*map(F.lit, POISSON)), lambda c: c <= u))

    return F.transform(F.sequence(F.lit(0), F.lit(bags - 1)), draws)


def bag_class_weights(train: DataFrame, key, bags: int, label: str = "label") -> DataFrame:
    """(bag, label, n_drawn, class_weight): ``balanced_subsample`` - n / (2 n_class) within each bag. One aggregate of
    ``bags`` partial sums a class."""
    return _class_weights(train, label, bag_draws(key, bags), bags)


def _class_weights(train: DataFrame, label: str, draws: Column, bags: int) -> DataFrame:
    drawn = train.select(F.col(label).alias("label"), draws.alias("d"))
    sums = drawn.groupBy("label").agg(*[F.sum(F.get("d", F.lit(b))).alias(f"b{b}") for b in range(bags)]) \
        .select("label", F.posexplode(F.array(*[F.col(f"b{b}") for b in range(bags)])).alias("bag", "n_drawn"))
    total = F.sum("n_drawn").over(Window.partitionBy("bag"))
    return sums.withColumn("class_weight", total / (2.0 * F.col("n_drawn"))).select("bag", "label", "n_drawn", "class_weight")


def fit_balanced_forest(train: DataFrame, features, key, label: str = "label", num_trees: int = 20, max_depth: int = 5,
                        min_instances: int = 10, seed: int = 42, parallel: int = 4) -> list[PipelineModel]:
    """M2 with ``balanced_subsample``: one tree a bag of Poisson draws, each row weighted by its draws and the class
    weight within the bag, sqrt(features) tried at each split. A model a tree; ``score_votes`` averages them."""
    train = cut_lineage(train.select(*features, label, bag_draws(key, num_trees).alias("_draws")))
    own = {(r["bag"], r["label"]): r["class_weight"] for r in _class_weights(train, label, F.col("_draws"), num_trees).collect()}  # a row a bag and class

    def fit(b: int) -> PipelineModel:
        weight = F.lit(0.0)
        for (bag, cls), w in own.items():
            if bag == b:
                weight = F.when(F.col(label) == F.lit(cls), F.lit(w)).otherwise(weight)
        n = F.get("_draws", F.lit(b))
        rows = train.filter(n > 0).withColumn("_weight", n * weight)
        tree = RandomForestClassifier(labelCol=label, weightCol="_weight", numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="sqrt",
                                      maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed + b)
        return _pipeline(features, tree).fit(rows)

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(fit, range(num_trees)))


def score_votes(models: list[PipelineModel], df: DataFrame, t: float = 0.5) -> DataFrame:
    """M5 for a list of models: the mean of their probabilities, and the class at threshold ``t``."""
    out = df.withColumn("_votes", F.lit(0.0))
    for model in models:
        out = model.transform(out).withColumn("_votes", F.col("_votes") + vector_to_array(F.col("probability"))[1]) \
            .drop("features", "rawPrediction", "probability", "prediction")
    return out.withColumn("proba", F.col("_votes") / len(models)).withColumn("pred", (F.col("proba") >= t).cast("int")).drop("_votes")


def logistic_gradient(model: PipelineModel, train: DataFrame, features, label: str = "label", weight: str = "weight") -> DataFrame:
    """(feature, gradient): the gradient of M1's objective at a fitted model, 0 at its optimum; written out from the
    objective, without the fitting library."""
    lr = model.stages[-1]
    coef = {**dict(zip(features, map(float, lr.coefficients))), "(intercept)": float(lr.intercept)}
    margin = F.lit(coef["(intercept)"])
    for c in features:
        margin = margin + F.lit(coef[c]) * F.col(c)
    off = F.col(weight) * (1 / (1 + F.exp(-margin)) - F.col(label))
    total = F.sum(weight)
    sums = train.agg(*[((F.sum(off * F.col(c)) + F.lit(coef[c])) / total).alias(c) for c in features], (F.sum(off) / total).alias("(intercept)"))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("gradient")) for c in coef])))


def fit_gbt(train: DataFrame, features, label: str = "label", weight: str = "weight",
            max_iter: int = 100, max_depth: int = 3, step: float = 0.01, min_instances: int = 5,
            seed: int = 42) -> PipelineModel:
    """M3: gradient-boosted trees; the positive-class weight (neg/pos) plays the role
    of ``scale_pos_weight`` and ``minInstancesPerNode`` that of ``min_child_weight``."""
    gbt = GBTClassifier(labelCol=label, weightCol=weight, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, minInstancesPerNode=min_instances, seed=seed)
    return _pipeline(features, gbt).fit(train)


def score(model: PipelineModel, df: DataFrame, t: float = 0.5) -> DataFrame:
    """M5: positive-class probability and the class at threshold ``t``."""
    out = model.transform(df)
    proba = vector_to_array(F.col("probability"))[1]
    return out.withColumn("proba", proba).withColumn("pred", (F.col("proba") >= t).cast("int")) \
        .drop("features", "rawPrediction", "probability", "prediction")


def predictions_table(scored: DataFrame, label: str = "label") -> DataFrame:
    """(obs_date, station, y_true, y_pred, y_pred_proba) export."""
    return scored.select("obs_date", "station", F.col(label).alias("y_true"),
                         F.col("pred").alias("y_pred"), F.col("proba").alias("y_pred_proba"))


def importance_table(model: PipelineModel, features) -> DataFrame:
    """M7: feature importances sorted (or |coefficients| for a linear model)."""
    est = model.stages[-1]
    spark = SparkSession.getActiveSession()
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in est.coefficients.toArray().tolist()]
    rows = sorted(zip(features, vals), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def coefficient_table(model: PipelineModel, features) -> DataFrame:
    """M1: coefficients with the intercept."""
    est = model.stages[-1]
    spark = SparkSession.getActiveSession()
    rows = list(zip(features, est.coefficients.toArray().tolist())) + [("(intercept)", float(est.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def grid_search(folds, fit_fn, grid: dict, metric: str = "recall", t: float = 0.5,
                label: str = "label", parallelism: int = 4):
    """M4: exhaustive grid × time folds; the mean fold metric decides (first grid
    point wins ties). ``folds`` is a list of (train, test) DataFrames (cache them);
    fits of different grid points run as concurrent Spark jobs from a thread pool.
    Returns ([(params, mean_metric)], best_params)."""
    from stormlens.operators.evaluate import binary_metrics

    keys = sorted(grid)
    points = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]

    def evaluate(params):
        vals = []
        for train, test in folds:
            m = fit_fn(train, **params)
            row = binary_metrics(score(m, test, t), t, label=label).first()
            vals.append(row[metric])
        return sum(vals) / len(vals)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scores = list(pool.map(evaluate, points))
    best = max(range(len(points)), key=lambda i: (scores[i], -i))
    return list(zip(points, scores)), points[best]


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib persistence (metadata JSON + Parquet node / coefficient data)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
