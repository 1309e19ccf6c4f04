"""The registered queries of the pipeline operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.llm import decontaminate, hard_negatives, line_templates, merkle, mixing, page_text, quality_classifier, secret_ledger, token_store, url_filter
from stormlens.llm import language_id as lid
from stormlens.llm import ngram_join as join
from stormlens.llm import quality_rules as rules
from stormlens.llm.storage import prepare, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


#: The same sampling as one sort of each source; sources fill up in the order of capacity / weight.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, greatest(length(coalesce(text, '')), 1) AS n,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) || ':mix-1'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
k AS (
  SELECT *, -ln(u) / (4.0::DOUBLE
      / CASE WHEN length(translate(t, '#*$%&|<>!', '')) < n * 0.98::DOUBLE THEN 2 ELSE 1 END
      / CASE WHEN length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) < n * 0.8::DOUBLE THEN 2 ELSE 1 END) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM k GROUP BY source),
f AS (
  SELECT *, 3 * source_size::DOUBLE AS cap,
    sum(source_size) OVER ()::DOUBLE - coalesce(sum(3 * source_size::DOUBLE) OVER o, 0) AS left_over,
    sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS open
  FROM s WINDOW o AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (
  SELECT *, first_value(CASE WHEN cap / w > left_over / open THEN left_over / open END IGNORE NULLS) OVER (
    ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM g),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, md5(t)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k)
SELECT doc_id, size, source_size, target, CAST(size * (e + CASE WHEN size > 0 AND start + size / 2.0::DOUBLE <= target - e * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (SELECT doc_id, size, source_size, target, p.start, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS e
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source) AS q
"""


def merkle_sql(source_levels: int = 15, top_levels: int = 8) -> str:
    """The same tree level by level; trees of up to 3 ** levels nodes. A tree of one node stays as it is. SQL has no
    crc32, so its register is folded over the digits of the id; the crc is even if the register's last bit is set."""
    part = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    head = " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    register = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1))))"""
    steps = [f"""d AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({head} || {part.format('text')}) AS leaf,
    CASE WHEN ({register}) & 1 = 1 THEN sha256({head} || {part.format("replace(text, chr(10), '')")}) END AS tampered
  FROM documents),
n0 AS MATERIALIZED (
  SELECT *, leaf AS node, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
f0 AS MATERIALIZED (SELECT doc_id, tree, leaf, coalesce(tampered, leaf) AS fold, '' AS proof, pos AS slot FROM n0)"""]

    def level(i: int) -> None:
        steps.append(f"""r{i} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, any_value(n) AS n, list(node ORDER BY pos) AS kids FROM n{i} GROUP BY tree, pos // 3),
n{i + 1} AS MATERIALIZED (SELECT tree, pos, (n + 2) // 3 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS node FROM r{i}),
s{i} AS (SELECT f.*, n, array_to_string(kids[1:slot % 3], '') AS l, array_to_string(kids[slot % 3 + 2:], '') AS r FROM f{i} AS f JOIN r{i} AS k ON f.tree = k.tree AND slot // 3 = pos),
f{i + 1} AS MATERIALIZED (
  SELECT * EXCLUDE (fold, proof, slot, n, l, r), CASE WHEN n > 1 THEN sha256(l || fold || r) ELSE fold END AS fold, proof || l || r AS proof, slot // 3 AS slot FROM s{i})""")

    for i in range(source_levels):
        level(i)
    top = source_levels + 1
    steps.append(f"""subroots AS MATERIALIZED (SELECT tree AS of, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM n{source_levels}),
n{top} AS MATERIALIZED (SELECT '' AS tree, pos, n, node FROM subroots),
f{top} AS MATERIALIZED (SELECT f.* EXCLUDE (tree, slot), '' AS tree, node AS subroot, pos AS slot FROM f{source_levels} AS f JOIN subroots ON tree = of)""")
    for i in range(top, top + top_levels):
        level(i)
    last = top + top_levels
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified
FROM f{last} AS f JOIN n{last} AS n ON f.tree = n.tree"""


#: All anchors against all rows.
NEGATIVES_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.quality_rules(docs, table(spark, sf_dir, "labels"))


@query("op2_token_orc")
def op2(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.digest(spark, path)


@query("op3_decontaminate")
def op3(spark, sf_dir):
    """Every (document, test item) that leaks; documents without a row are clean."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_quality_classifier")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.quality_classifier(docs, table(spark, sf_dir, "labels"))


@query("op5_mixing", MIXING_SQL)
def op5(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_page_text")
def op6(spark, sf_dir):
    return page_text.extract(table(spark, sf_dir, "pages"))


@query("op7_ngram_jaccard")
def op7(spark, sf_dir):
    return join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op8_line_templates")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query("op9_language_id")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lid.language_id(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op10_url_filter")
def op10(spark, sf_dir):
    return url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))


@query("op11_merkle_manifest", merkle_sql())
def op11(spark, sf_dir):
    """Documents whose id has an even crc32 lost the line ends of their text since the manifest was made."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(merkle.build(docs, now={"text": now}))


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, label=label, anchors=F.col("id") % 50 == 0)


@query("op13_secret_ledger")
def op13(spark, sf_dir):
    """A first scan: the ledger is a new folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_ledger.digest(secret_ledger.scan(docs, scratch_path(spark, "ledger")))
