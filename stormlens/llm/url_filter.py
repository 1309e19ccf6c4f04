"""URL filter: rules first, then the ratio of two character language models.

URLs that an allow rule decides are the accepted sample, those that a block rule decides the
rejected one. For each sample a variable-order Markov model over the characters of host and
path (digits made one symbol) is counted: for every run of up to ``ORDER`` + 1 characters
P(last | before) mixes the counts of that context with the next shorter one by the number of
distinct continuations (Witten-Bell). A URL's score adds up log P_accepted - log P_rejected of the
longest run known at each character, divided by their number. The verdict compares it with
the point between both samples' mean scores, weighted by their spreads.

DataFrame operations only. The models keep every run; the ratio is looked up once for each distinct
run by joins without a hint, so nothing is cut to fit a broadcast. Scores are sums of whole
millionths.

Defined results: a null url or one without ``://`` has an empty host and path and no rule, and is scored on
the mark that ends every URL alone; with no accepted or no rejected URL every URL without a rule
is allowed; repeated rows are judged alike; a score on the threshold is allowed.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
ORDER = 4
SYMBOLS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + F.lit(1)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(the longest rule that fits as text, its verdict), null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _runs(rows: DataFrame, order: int) -> DataFrame:
    """One row for each character of ``__line``, with the run of order + 1 characters that ends there."""
    padded = F.concat(F.lit("^" * order), F.col("__line"))
    return rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("__line")))) \
        .withColumn("run", F.substring(padded, F.col("at"), F.lit(order + 1)))


def train(samples: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """By length from 1 on: (run, ratio), ratio in millionths. ``samples``: __line, accepted."""
    own = [F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r")]
    longest = materialise(_runs(samples, order).groupBy("run").agg(*own), "url-runs")
    tables, shorter = [], None
    for n in range(1, order + 2):
        runs = longest.groupBy(F.substring("run", order + 2 - n, n).alias("run")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = runs.groupBy(F.substring("run", 1, n - 1).alias("context")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"),
            F.count(F.when(F.col("a") > 0, 1)).alias("ta"), F.count(F.when(F.col("r") > 0, 1)).alias("tr"))
        found = runs.withColumn("context", F.substring("run", 1, n - 1)).join(context, "context")
        if shorter is None:
            found = found.withColumn("pa0", F.lit(1 / SYMBOLS)).withColumn("pr0", F.lit(1 / SYMBOLS))
        else:
            less = shorter.select(F.col("run").alias("tail"), F.col("pa").alias("pa0"), F.col("pr").alias("pr0"))
            found = found.withColumn("tail", F.substring("run", 2, n - 1)).join(less, "tail")
        for k in "ar":
            found = found.withColumn(f"p{k}", F.when(F.col(f"n{k}") > 0, (F.col(k) + F.col(f"t{k}") * F.col(f"p{k}0")) / (F.col(f"n{k}") + F.col(f"t{k}")))
                                     .otherwise(F.col(f"p{k}0")))
        shorter = materialise(found.select("run", "pa", "pr"), "url-model")
        tables.append(shorter.select("run", F.round(F.log(F.col("pa") / F.col("pr")) * 1e6).cast("long").alias("ratio")))
    return tables


def score(rows: DataFrame, tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """``keys`` and the score of each row by its ``__line``: the distinct runs get their ratios, then
    each character that of its run."""
    order = len(tables) - 1
    rows = materialise(rows.withColumn("__row", F.monotonically_increasing_id()), "url-rows")
    each = _runs(rows.select("__row", "__line"), order).select("__row", "run")
    found = each.select("run").distinct()
    for n, table in enumerate(tables, 1):
        table = table.select(F.col("run").alias(f"run{n}"), F.col("ratio").alias(f"ratio{n}"))
        found = found.withColumn(f"run{n}", F.substring("run", order + 2 - n, n)).join(table, f"run{n}", "left")
    best = F.coalesce(*[F.col(f"ratio{n}") for n in range(len(tables), 0, -1)], F.lit(0))
    ratios = materialise(found.select("run", best.alias("ratio")), "url-ratios")
    scores = each.join(ratios, "run").groupBy("__row").agg((F.sum("ratio") / F.count("*") / 1e6).alias("score"))
    return rows.join(scores, "__row").select(*keys, "score")


def url_filter(pages: DataFrame, id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
               order: int = ORDER) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row of ``pages``."""
    urls = pages.select(F.col(id).alias("page"), F.coalesce(F.col(url), F.lit("")).alias("__url"))
    host, path = parts(F.col("__url"))
    urls = urls.select("page", host.alias("host"), path.alias("path"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": name, "by_rule": verdict}) \
        .withColumn("__line", F.regexp_replace(F.concat("host", "path", F.lit("$")), r"\p{Nd}", "0"))
    samples = urls.filter("by_rule is not null").select("__line", (F.col("by_rule") == "allow").alias("accepted"))
    keys = ["page", "host", "path", "rule", "by_rule"]
    scored = materialise(score(urls, train(samples, order), keys), "url-scores")
    found = {r.by_rule: r for r in scored.filter("by_rule is not null").groupBy("by_rule")
             .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).collect()}
    threshold = F.lit(float("-inf"))
    if len(found) == 2:
        a, r = found["allow"], found["block"]
        spread = a.spread + r.spread
        threshold = F.lit((a.mean * r.spread + r.mean * a.spread) / spread if spread else (a.mean + r.mean) / 2)
    return scored.select(F.col("page").alias(id), "host", "path", "rule", F.coalesce(
        "by_rule", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score")
