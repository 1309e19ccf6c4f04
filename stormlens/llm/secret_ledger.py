"""Secret scans with an incremental ledger of blobs.

A text is a blob, addressed by its SHA-256. The ledger is a Parquet folder with one row for each
scan of a blob: the rules (with version) that were tried, and the spans that they found. A scan
of any number of versions of any number of paths reads their addresses, looks up which (blob,
rule version) pairs the ledger lacks, tries those rules on one copy of each such blob, appends what
it found, and joins the ledger's spans to all paths that hold the blob. So a second scan reads no
text again but to address it, and a new version of one rule is tried on all blobs without
repeating the others.

Copies are cut by a partial aggregate on the address before any text is shuffled. Paths of a blob
are spread over ``PATHS`` rows a key before findings are joined to them, so a blob that a third of
all paths hold is many keys.

A rule's matches are leftmost and do not overlap; a match below the least length is dropped after
it was matched. Spans are code points of the whole match, end exclusive.

Defined results: a null text is an empty one; an empty text is a blob without spans; rows that are
equal in id and text give equal rows; a null id is kept; an empty table gives an empty result and
leaves the ledger as it was. The ledger of an interrupted scan holds whole rows only: pairs that
it lacks are tried by the next scan, and spans that are there twice count once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1
    any_case: bool = False


#: Fixed patterns, lengths and order.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
#: Forms of well-known credentials beside the base ones.
MORE = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("userinfo", 1, r"://[A-Za-z0-9._~-]+:[^\s/:@]+@", 0, 12),
)
RULES = BASE + MORE
PATHS = 100_000
FEW = 100_000
SPANS = "array<struct<kind:string,version:int,start:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, found {SPANS}"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def tag(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


class Matcher:
    """A rule as a function from a text to its spans. A one-class rule with a least length is
    matched from that length on, which finds the same maximal runs sooner."""

    def __init__(self, rule: Rule):
        pattern = rule.pattern
        if re.fullmatch(r"\[[^\]]*\]\+", pattern) and rule.group == 0:
            pattern = f"{pattern[:-1]}{{{rule.least},}}"
        self.rule, self.find = rule, re.compile(pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0)).finditer

    def spans(self, text: str) -> list[tuple]:
        kind, version, _, group, least, _ = self.rule
        return [(kind, version, *m.span()) for m in self.find(text) if m.end(group) - m.start(group) >= least]


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The rows of a ledger; none if there is no such folder yet."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, todo): the rules (as kind@version) that were not tried on the blob yet."""
    tried = ledger.groupBy(F.col("blob").alias("__blob")).agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("tried"))
    todo = F.array_except(F.array(*[F.lit(tag(r)) for r in rules]), F.coalesce("tried", F.array().cast("array<string>")))
    return blobs.join(tried, F.col("blob") == F.col("__blob"), "left").select("blob", todo.alias("todo")).filter(F.size("todo") > 0)


def _scan(rules: Sequence[Rule]):
    def run(batches):
        matchers = [(tag(r), Matcher(r)) for r in rules]
        for batch in batches:
            todo, found = batch.column("todo").to_pylist(), []
            for text, names in zip(batch.column("text"), todo):
                text = text.as_py()
                found.append([dict(zip(("kind", "version", "start", "end"), s)) for name, m in matchers if name in names for s in m.spans(text)])
            yield pa.RecordBatch.from_arrays([batch.column("blob").cast(pa.binary()), batch.column("todo").cast(pa.list_(pa.string())), pa.array(found, _FOUND)], names=["blob", "rules", "found"])

    return run


def scan_unseen(versions: DataFrame, paths: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Try the missing rules on one copy of each blob of ``versions`` and append the result to the
    ledger. ``paths`` holds the blobs' addresses."""
    spark = versions.sparkSession
    todo = materialise(unseen(paths.select("blob").distinct(), read_ledger(spark, ledger), rules), "todo")
    n = todo.count()
    if not n:
        return
    texts = versions.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if n <= FEW and n * 100 <= paths.count():  # few new blobs: only their texts go on, the others end where they are read
        work = texts.join(F.broadcast(todo), "blob").dropDuplicates(["blob"])
    else:
        work = texts.dropDuplicates(["blob"]).join(todo, "blob")
    work.select("blob", "todo", "text").mapInArrow(_scan(rules), LEDGER).write.mode("append").parquet(ledger)


def findings(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, found): the spans of the given rule versions, by start, then in the order of the rules,
    for every blob with a span."""
    order = F.array(*[F.lit(tag(r)) for r in rules])
    now = ledger.select("blob", F.explode("found").alias("x")).select("blob", "x.*") \
        .withColumn("rank", F.array_position(order, F.concat("kind", F.lit("@"), F.col("version").cast("string")))).filter("rank > 0")
    spans = F.array_sort(F.collect_set(F.struct("start", "rank", "end", "kind")))
    return now.groupBy("blob").agg(spans.alias("x")) \
        .select("blob", F.transform("x", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found"))


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, blob, found) for every row of ``versions``, from a ledger that is brought up to date."""
    spark = versions.sparkSession
    paths = materialise(versions.select(F.col(id).alias("id"), address(F.col(text)).alias("blob"), F.monotonically_increasing_id().alias("turn")), "paths")
    scan_unseen(versions, paths, ledger, rules, text)
    spread = max(1, -(-paths.count() // PATHS))
    paths = paths.withColumn("salt", F.pmod("turn", F.lit(spread)))
    hit = findings(read_ledger(spark, ledger), rules)
    spans = paths.select("blob", "salt").distinct().join(hit, "blob")
    return paths.join(spans, ["blob", "salt"], "left").select(
        F.col("id").alias(id), "blob", F.coalesce("found", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("found"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of each row of ``scan``."""
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in BASE]))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return scanned.select(id, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
