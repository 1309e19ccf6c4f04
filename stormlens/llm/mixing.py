"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source's target is a share of the budget by its weight, at most ``max_epochs`` times
its own size; what a full source can't take is shared anew by weight among the others. A
source takes whole epochs first; the rest of its target is taken from its documents in the
order of an exponential key -ln(u) / w, where u is a fixed hash of the document and the
seed, and w its quality weight: as long as a document's middle lies within the rest, it is taken.

Prefix sums are split: keys are cut into ranges of about ``ROWS`` documents of all sources by the
value of exp(-key / mean key), which is about even; ranges are added up first, documents only within their range, so a source that
holds a third of all rows is many groups.

Defined results: a null text has size 0; a null source is a source of its own, the last; a
source of size 0 has target 0 and takes nothing; a null id is told apart by its text; rows that are equal in id and text share a
key and are told apart by order alone; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
ROWS = 5_000
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """A weight of 1, 2 or 4 by plain signs of prose: few marks and no shouting."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    marks = F.length(F.translate(t, "#*$%&|<>!", "")) < n * 0.98
    capitals = F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")) < n * 0.8
    return F.lit(4.0) / F.when(marks, 2.0).otherwise(1.0) / F.when(capitals, 2.0).otherwise(1.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source. Sources fill
    up in the order of capacity / weight, so one pass in that order tells which are full."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("w", F.element_at(table, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))) \
        .withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    everything = W.partitionBy()
    fill = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("budget", share * F.sum("source_size").over(everything).cast("double")) \
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))) \
        .withColumn("level", F.col("left") / F.col("open"))
    level = F.min(F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct(F.col("cap") / F.col("w"), F.col("level"))))
    s = s.withColumn("final", level.over(everything)["level"])
    return s.select("source", "source_size", F.when(F.col("final").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("final") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, share: float = 1.0, seed: str = SEED, weight: Column | None = None) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row of ``docs``."""
    name = F.coalesce(F.col(id).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(":" + seed))), 1, 12), 16, 10)
    u = (bits.cast("double") + 0.5) / float(1 << 48)
    rows = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), text_size(text).alias("size"),
                       (-F.log(u) / (quality_weight(text) if weight is None else weight)).alias("key"),
                       F.md5(F.coalesce(F.col(text), F.lit(""))).alias("tie"))
    rows = materialise(rows, "mix-rows")
    n, mean = rows.agg(F.count("*"), F.avg("key")).first()
    ranges = max(1, -(-n // ROWS))  # where ranges are cut doesn't show in the result
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("key") / (mean or 1.0))) * ranges))
    blocks = rows.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    sizes = blocks.groupBy("source").agg(F.sum("sum").alias("source_size"))
    goal = targets(sizes, weights, max_epochs, share)
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    blocks = blocks.join(goal, same(blocks, goal)).select(blocks["source"], "range", "start", "source_size", "target") \
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    inside = W.partitionBy("source", "range").orderBy("key", "id", "tie").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    taken = rows.join(blocks, same(rows, blocks) & (rows["range"] == blocks["range"])).select(
        F.col("id").alias(id), rows["source"], "tie", "size", "source_size", "target",
        (F.col("epochs") + ((F.col("size") > 0) & (F.col("start") + F.col("inside") + F.col("size") / 2 <= F.col("rest"))).cast("long")).cast("long").alias("copies"))
    return taken.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mix takes it. Of rows that are
    equal in id, source and text, one stands for all and is repeated for their sum."""
    taken = mix(docs, id, text, source, **how).groupBy(F.col(id).alias("__id"), F.col("source").alias("__source"), F.col("tie").alias("__tie")) \
        .agg(F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0")
    marked = docs.withColumn("__text", F.md5(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(id).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")) & (F.col("__text") == F.col("__tie"))
    rows = marked.join(taken, same).dropDuplicates([id, source, "__text"])
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
