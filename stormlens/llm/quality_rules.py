"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over ``2**bits`` hash buckets of word unigrams and bigrams are counted over
all documents (raw) and over all documents marked as trusted (target). A document's score is
the sum of log p_target / p_raw of its n-grams divided by their number; it is kept when the
score is at least ``threshold``. Log ratios are whole millionths, so a score doesn't depend
on the order of additions. Heuristic base rules come before the ratio.

Defined results: a null or empty text has no words, score 0 and fails the base rules; a
document without a label is raw only; repeated rows are scored alike; repeated labels of one
id count once, the largest mark; without any trusted row every ratio is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlens.llm.arrays import WHITE, hash_spans, line_spans, mix, ngram_hashes, slices, with_columns, word_spans

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
BITS = 16
SMOOTHING = 1.0
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def _buckets(words: np.ndarray, first: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of all unigrams and bigrams within each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = ngram_hashes(words, 2)
    same = text[1:] == text[:-1]
    h = np.concatenate([words, pairs[same]])
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([text, text[:-1][same]])


def text_counts(data: np.ndarray, offsets: np.ndarray, starts, ends, first, words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(offsets) - 1
    rows = list(zip(offsets[:-1], offsets[1:]))
    head = ~WHITE[data] & ((data & 0xC0) != 0x80)  # one byte of each code point inside words
    symbol = SYMBOLS[data]
    count = lambda mask: np.array([np.count_nonzero(mask[a:b]) for a, b in rows], np.int64)

    ls, le, text = line_spans(data, offsets)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, text = ls[has_word], le[has_word], text[has_word]
    key = mix(hash_spans(data, ls, le) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]

    owner = np.repeat(np.arange(n), np.diff(first))
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        inside = np.flatnonzero(owner[2:] == owner[:-2])
        key = mix(ngram_hashes(words, 3)[inside] + owner[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key, kind="stable")
        equal = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:]] |= equal
        twice[order[:-1]] |= equal
        for j in range(3):
            covered[inside[twice] + j] = True
    return {
        "n_words": np.diff(first).astype(np.int64), "word_chars": count(head), "n_symbols": count(symbol),
        "n_dup_lines": np.bincount(text[again], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(owner[covered], minlength=n).astype(np.int64),
    }


def ngram_counts(docs: DataFrame, text: str, target: str, bits: int = BITS) -> DataFrame:
    """(bucket, raw, target): occurrences in all texts and in those where ``target`` is true.
    Every task adds up its own counts first, so that at most one row for each bucket and
    task is shuffled."""
    def count(batches):
        both = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            mark = np.array(batch.column(1).fill_null(False))
            for row, data, offsets in slices(batch.column(0)):
                starts, ends, first = word_spans(data, offsets)
                bucket, owner = _buckets(hash_spans(data, starts, ends), first, bits)
                both[0] += np.bincount(bucket, minlength=1 << bits)
                both[1] += np.bincount(bucket[mark[row + owner]], minlength=1 << bits)
        seen = np.flatnonzero(both[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(both[0][seen]), pa.array(both[1][seen])],
                                         names=["bucket", "raw", "target"])

    parts = docs.select(F.col(text).alias("text"), F.col(target).alias("target")) \
        .mapInArrow(count, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log p_target / p_raw of every bucket in millionths; an array of fixed length."""
    table = np.zeros((2, 1 << bits), np.float64)
    found = counts.toArrow()  # at most 2**bits rows
    for k, name in enumerate(("raw", "target")):
        table[k, found.column("bucket").to_numpy()] = found.column(name).to_numpy()
    if not table[1].any():
        return np.zeros(1 << bits, np.int64)
    raw, target = (np.log((t + smoothing) / (t.sum() + smoothing * len(t))) for t in table)
    return np.rint((target - raw) * 1e6).astype(np.int64)


def score(docs: DataFrame, ratios: np.ndarray, text: str = "text", bits: int = BITS, threshold: float = THRESHOLD,
          min_words: int = MIN_WORDS, max_repeated_percent: int = MAX_REPEATED_PERCENT) -> DataFrame:
    """``docs`` with the counts, base_failed, llr (length-normalised) and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    new = "".join(f", {n} long" for n in names) + ", base_failed boolean, llr double, kept boolean"
    others = [c for c in docs.columns if c != text and c not in {*names, "base_failed", "llr", "kept"}]
    table = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        ratio = table.value
        for batch in batches:
            parts: dict[str, list] = {n: [] for n in [*names, "base_failed", "llr", "kept"]}
            for _, data, offsets in slices(batch.column("__text")):
                starts, ends, first = word_spans(data, offsets)
                words = hash_spans(data, starts, ends)
                found = text_counts(data, offsets, starts, ends, first, words)
                bucket, owner = _buckets(words, first, bits)
                n = len(offsets) - 1
                grams = np.bincount(owner, minlength=n)
                total = np.zeros(n, np.int64)
                np.add.at(total, owner, ratio[bucket])
                found["base_failed"] = (found["n_words"] < min_words) | (
                    100 * found["n_repeat_words"] > max_repeated_percent * found["n_words"])
                found["llr"] = total / np.maximum(grams, 1) / 1e6
                found["kept"] = ~found["base_failed"] & (found["llr"] >= threshold)
                for k, v in found.items():
                    parts[k].append(v)
            if batch.num_rows:
                yield with_columns(batch, ("__text",), **{k: pa.array(np.concatenate(v)) for k, v in parts.items()})

    kept = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + new if schema else new[2:])


def trusted_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, target): every document once, marked when its label has quality 1."""
    good = labels.groupBy(F.col(id).alias("__id")).agg((F.max("quality") == 1).alias("target")).filter("target") \
        .hint("merge")  # labels grow with the documents: never broadcast, the same join at every size
    return docs.select(F.col(id).alias("__id"), F.col(text).alias("text")).join(good, "__id", "left") \
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))


def quality_rules(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                  bits: int = BITS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD) -> DataFrame:
    """Count both multinomials over all documents, then score every document."""
    counts = ngram_counts(trusted_documents(docs, labels, id, text), "text", "target", bits)
    return score(docs, log_ratios(counts, bits, smoothing), text, bits, threshold)
