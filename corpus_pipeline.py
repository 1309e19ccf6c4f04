"""The corpus pipeline: five stages over ``documents``, each one operator of ``stormlens.llm``.

A stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns the
columns of documents (the last one: the token table). The caller writes each stage's rows as
Parquet and reads them again; ``run`` does that in the shared folder.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlens.llm import decontaminate, language_id, mixing, ngram_join, token_store
from stormlens.llm.storage import materialise, prepare, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_CONFIDENCE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on, with the predicted language; those without
    a letter and those below the least confidence go."""
    prepare(spark)
    found = language_id.language_id(docs.select(*COLUMNS))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_CONFIDENCE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id. Rows that are
    equal in id and text are one document, rows of one id with other texts are others; documents without
    words have no copies and stay."""
    prepare(spark)
    docs = docs.select(*COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text"))
    groups = ngram_join.jaccard_components(docs.select("row_key", "text"), id="row_key").select("row_key", "component_id").distinct()
    ids = docs.select("doc_id", "row_key").distinct().join(groups, "row_key")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first"))
    rows = docs.join(first.select(F.col("first.row_key").alias("row_key")), "row_key", "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item within its error budget go."""
    prepare(spark)
    return decontaminate.drop_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or once to three times."""
    prepare(spark)
    return mixing.mixed_rows(docs.select(*COLUMNS))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as ORC in the shared folder, and one row for each document from those files."""
    import public_tokenizers

    prepare(spark)
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.digest(spark, path)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", join_near_duplicates),
    ("decontamination", remove_test_items),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL cannot fit the language model, decide edit distances or run the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
