import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from stormlens.llm import queries
from stormlens.llm import quality_rules as rules
from stormlens.llm.arrays import hash_spans, word_spans, utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts, read off the definitions."""
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def bucket(word_or_pair, bits=rules.BITS):
    data, offsets = utf8(pa.array([" ".join(word_or_pair)]))
    s, e, f = word_spans(data, offsets)
    return rules._buckets(hash_spans(data, s, e), f, bits)[0][-1]


TEXTS = ["", None, " \t\n", "one", "a b\na b\na b\n a b", "x " * 5000, "é ü# % y\x0bz|w", "\n\n", "the end\n\nthe end",
         "\x1f odd\x85 white space", "a" * 200_000, ("lorem ipsum " * 30 + "\n") * 3]


def test_counts_follow_the_definitions(spark, documents):
    out = rules.quality_rules(documents(list(enumerate(TEXTS))), spark.createDataFrame([], "doc_id long, quality int"))
    for r in out.collect():
        want = counts(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.llr == 0 and r.kept == (not r.base_failed)
    assert out.columns[:8] == ["doc_id", "lang", "source", "n_chars", "id", "rank", "key", "n_words"]


def test_score_is_the_mean_log_ratio_of_smoothed_multinomials(spark, documents, prose):
    texts = [prose(k, 80) for k in range(12)] + [prose(k, 80).replace(" ", "### ") for k in range(12, 20)]
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame([(k, 1) for k in range(10)] + [(3, 0), (99, 1), (15, None)], "doc_id long, quality int")
    grams = [[bucket([w]) for w in t.split()] + [bucket(p) for p in zip(t.split(), t.split()[1:])] for t in texts]
    raw, good = Counter(b for g in grams for b in g), Counter(b for g in grams[:10] for b in g)
    size = 1 << rules.BITS
    ratio = lambda b: round((math.log((good[b] + 1) / (sum(good.values()) + size)) - math.log((raw[b] + 1) / (sum(raw.values()) + size))) * 1e6)
    for r in rules.quality_rules(docs, labels).collect():
        want = sum(map(ratio, grams[r.doc_id])) / len(grams[r.doc_id]) / 1e6
        assert abs(r.llr - want) < 1e-5 and r.kept == (not r.base_failed and r.llr >= rules.THRESHOLD)


def test_no_documents(spark, documents):
    assert rules.quality_rules(documents([]), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_query_keeps_clean_documents_and_drops_marked_ones(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op1_quality_rules"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen = out.join(labels, "doc_id", "left").collect()
    assert len({r.doc_id for r in seen}) == len(docs)
    for r in seen:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(docs[r.doc_id])
    clean = [r.kept for r in seen if r.quality == 1 and not r.base_failed]
    assert np.mean(clean) > 0.99 and not any(r.kept for r in seen if r.quality == 0)
