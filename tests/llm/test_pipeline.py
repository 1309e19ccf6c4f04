import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as cp
from stormlens.llm import decontaminate as dec
from stormlens.llm import mixing, token_store
from stormlens.llm.storage import materialise

from .brute import brute


def test_stages_by_brute_force(spark):
    """Every stage on what its predecessor kept, against plain Python on the same rows."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    assert len(cp.STAGES) == 5

    docs = materialise(cp.STAGES[0][1](spark, docs, sf), "t")
    assert docs.columns == cp.COLUMNS
    told = {r.doc_id: r for r in docs.collect()}
    assert len(told) > 0.97 * len(before)
    assert all(re.search(r"[^\W\d_]", r.text) for r in told.values())
    assert np.mean([r.lang == before[i].lang for i, r in told.items()]) > 0.9

    docs = materialise(cp.STAGES[1][1](spark, docs, sf), "t")
    assert docs.columns == cp.COLUMNS
    single = {r.doc_id for r in docs.collect()}
    assert single == {d for d, _, c in brute([(i, r.text) for i, r in told.items()]) if c in (d, None)}
    assert docs.count() == len(single)

    docs = materialise(cp.STAGES[2][1](spark, docs, sf), "t")
    items = [dec.trimmed(r.text).tobytes() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    norm = lambda t: dec.normalise(t).tobytes()
    clean = {r.doc_id for r in docs.collect()}
    leaked = {i for i in single if any(p in norm(told[i].text) for p in items)}
    assert docs.columns == cp.COLUMNS and clean <= single - leaked
    for i in single - leaked - clean:
        assert any(dec.myers(p, norm(told[i].text))[0] <= dec.RATE * len(p) for p in items)

    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    docs = materialise(cp.STAGES[3][1](spark, docs, sf), "t")
    assert docs.columns == cp.COLUMNS
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, n in taken.items() for _ in range(n))

    out = cp.STAGES[4][1](spark, docs, sf).collect()
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == sorted(r.doc_id for r in docs.collect())
    for r in sorted(out, key=lambda r: r.start):
        ids = tokenizer.encode(before[r.doc_id].text, add_special_tokens=False).ids + [token_store.END]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_gives_the_last_stage(spark):
    assert __spark_entry__.queries()["pipeline"] is cp.run and "pipeline" not in __spark_entry__.oracle_sql()
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 100


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (2, "", None, None), (3, "12 34", None, "s")], [(1, "words of one text", "en", None)] * 3])
def test_small_and_odd_tables(spark, documents, rows):
    docs = documents(rows)
    for _, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, "/root/testdata/sf0.001"), "t")
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert docs.count() == (1 if rows and rows[0][1] else 0)  # one document, one source: taken once
