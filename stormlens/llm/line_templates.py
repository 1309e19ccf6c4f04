"""Line dedup with a log-template tree of fixed depth.

Lines are parsed like log messages. The tree's first level is the number of tokens, the next
``LEAD`` levels are the leading tokens (a token with a digit is a variable field, ``<*>``); a leaf
holds the lines that agree so far. In a leaf, a token that stands at its place in lines of fewer than
``min_docs`` texts is a field too: counts are absolute, so the size of a leaf does not matter. That gives a
line's template. One more level makes it coarser: a place where more than ``FAN`` tokens are frequent is a
field as a whole, so that a field with few, frequent values does not part a template. Either template must keep at
least ``similarity`` of the line's tokens; a line below that is its own template as it stands, so that
'Page 3' goes where it recurs and 'Page 4' does not go with it. A template that recurs in at least ``min_docs`` different
document texts (copies of a whole text count once) is dropped from every document; one of more than
``LONG`` tokens from ``LONG_DOCS`` texts on, as no such line recurs by chance.

DataFrame operations only. Texts are read once for their lines, which travel as hashes, and once for the
result. The tree works on distinct lines with their number of texts; (line, text) pairs are made
distinct before they are counted, so a line that a third of all documents hold is many small
counts; the leading tokens, which a whole leaf shares, are not counted at all. The verdict
is a set of lines, joined to their places once.

Defined results: a null text gives null and no lines; an empty text stays; blank lines are
never dropped; rows equal in id and text are treated alike; text borders are \\n; an empty
table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise

LEAD = 3
MIN_DOCS = 10
LONG = 50
LONG_DOCS = 2
SIMILARITY = 0.6
FAN = 3
FIELD = "<*>"


def tidy(line: Column) -> Column:
    """The line's tokens between single spaces, those with a digit as ``<*>``."""
    uneven = line.startswith(" ") | line.endswith(" ")
    for blank in ("  ", "\t", "\r", "\x0b", "\f"):
        uneven = uneven | line.contains(blank)
    line = F.when(uneven, F.trim(F.regexp_replace(line, r"[ \t\x0B\f\r]+", " "))).otherwise(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def lines(docs: DataFrame, id: str, text: str, similarity: float) -> DataFrame:
    """(id, text_hash, pos, size, leaf, line, plain, tail): one row a line that isn't blank. ``line`` is the hash
    of the tidied line if enough of its tokens are no fields, else that of the untouched line; ``plain`` counts the
    leading tokens that are no fields, ``tail`` holds hashes of the others (0 for a field)."""
    exploded = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "raw")) \
        .withColumn("tidy", tidy(F.col("raw"))).filter("tidy <> ''").withColumn("tokens", F.split("tidy", " ", -1))
    size = F.size("tokens")
    count = lambda x: (F.length(x) - F.length(F.replace(x, F.lit(FIELD), F.lit("")))) / len(FIELD)
    lead = F.substring_index("tidy", " ", LEAD)
    fields = F.when(F.col("tidy").contains(FIELD), count(F.col("tidy"))).otherwise(0)
    own = F.when(size - fields >= similarity * size, F.xxhash64("tidy", F.lit(0))).otherwise(F.xxhash64("raw", F.lit(1)))
    plain = F.least(size, F.lit(LEAD)) - F.when(lead.contains(FIELD), count(lead)).otherwise(0).cast("int")
    tail = F.transform(F.slice("tokens", F.lit(LEAD + 1), F.greatest(size - LEAD, F.lit(0))), lambda t: F.when(t == FIELD, 0).otherwise(F.hash(t)))
    return exploded.select("id", "text_hash", "pos", size.alias("size"), F.xxhash64(size, lead).alias("leaf"), own.alias("line"), plain.alias("plain"), tail.alias("tail"))


def needed(min_docs: int) -> Column:
    """In how many texts a line of ``size`` tokens must recur."""
    return F.when(F.col("size") > LONG, min(LONG_DOCS, min_docs)).otherwise(min_docs)


def in_texts(rows: DataFrame, *key: str) -> DataFrame:
    """(key, texts): in how many different texts each key occurs."""
    return rows.select(*key, "text_hash").distinct().groupBy(*key).agg(F.count("*").alias("texts"))


def templates(distinct: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """(line, size, template): the finer and the coarser template of each distinct line (line, size, leaf, plain, tail, texts), where
    they keep enough of its tokens."""
    each = distinct.select("line", "leaf", "size", "texts", F.posexplode("tail").alias("at", "token")).filter("token <> 0")
    often = each.groupBy("leaf", "at", "token").agg(F.sum("texts").alias("texts"), F.first("size").alias("size")) \
        .filter(F.col("texts") >= needed(min_docs)).select("leaf", "at", "token")
    often = materialise(often, "often")
    wide = often.groupBy("leaf", "at").agg((F.count("*") <= FAN).alias("narrow"))
    known = often.join(wide, ["leaf", "at"])
    kept = each.select("line", "leaf", "at", "token").join(known, ["leaf", "at", "token"])
    own, narrow = F.xxhash64("at", "token") % (1 << 40), F.col("narrow")
    shape = kept.groupBy("line").agg(F.count("*").alias("n0"), F.sum(own).alias("s0"), F.count_if(narrow).alias("n1"), F.coalesce(F.sum(F.when(narrow, own)), F.lit(0)).alias("s1"))
    both = distinct.select("line", "leaf", "size", "plain").join(shape, "line", "left").na.fill(0, ["n0", "s0", "n1", "s1"]) \
        .select("line", "size", "leaf", F.inline(F.array(*[F.struct((F.col("plain") + F.col(f"n{k}")).alias("kept"), F.col(f"s{k}").alias("shape")) for k in (0, 1)])))
    return both.filter(F.col("kept") >= similarity * F.col("size")).select("line", "size", F.xxhash64("leaf", "kept", "shape").alias("template")).distinct()


def recurring(docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """(id, text_hash, pos): the lines whose template recurs."""
    found = materialise(lines(docs, id, text, similarity), "lines")
    pairs = found.select("line", "size", "leaf", "text_hash").distinct()
    counted = materialise(pairs.groupBy("line", "size", "leaf").agg(F.count("*").alias("texts")), "counted")
    literal = counted.filter(F.col("texts") >= needed(min_docs)).select("line")
    rest = counted.filter(F.col("texts") < needed(min_docs))
    leaves = rest.groupBy("leaf", "size").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= needed(min_docs)).select("leaf")
    open_ = rest.join(leaves, "leaf").select("line", "texts")
    tails = found.filter(F.size("tail") > 0).select("line", "text_hash", "size", "leaf", "plain", "tail").join(open_, "line")
    tails = materialise(tails.dropDuplicates(["line", "text_hash"]), "tails")
    distinct = tails.drop("text_hash").dropDuplicates(["line"])
    named = materialise(templates(distinct, min_docs, similarity), "templates")
    often = in_texts(tails.select("line", "text_hash").join(named, "line"), "template", "size").filter(F.col("texts") >= needed(min_docs)).select("template")
    verdict = literal.union(named.join(often, "template").select("line")).distinct()
    return found.select("id", "text_hash", "pos", "line").join(verdict, "line").select("id", "text_hash", "pos")


def drop_recurring_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                         similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (all columns) with the recurring lines gone from the text, n_lines and n_dropped."""
    gone = recurring(docs, id, text, min_docs, similarity) \
        .groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.collect_set("pos").alias("__gone"))
    marked = docs.drop("n_lines", "n_dropped").withColumn("__text", F.xxhash64(text))
    joined = marked.join(gone, F.col(id).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left")
    split = F.split(F.col(text), "\n", -1)
    left = F.array_join(F.filter(split, lambda line, at: ~F.array_contains("__gone", at)), "\n")
    out = {text: F.when(F.col("__gone").isNull(), F.col(text)).otherwise(left),
           "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long"),
           "n_dropped": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")}
    columns = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return joined.select(*[F.col(f"`{c}`") for c in columns], *[e.alias(n) for n, e in out.items()])
