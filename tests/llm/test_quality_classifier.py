import zlib

import numpy as np
import pyarrow as pa
import pytest

from stormlens.llm import quality_classifier as qc
from stormlens.llm import queries

LABELS = "doc_id long, quality int, toxic int"


def test_margin_equals_the_sum_over_pairs():
    r = np.random.default_rng(1)
    m = qc.Machine(0.3, r.normal(size=20), r.normal(size=(20, 4)), 4)
    i, x = np.array([1, 4, 9, 17]), r.normal(size=4)
    pairs = sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a in range(4) for b in range(a + 1, 4))
    assert m.margin(i, x) == pytest.approx(0.3 + m.w[i] @ x + pairs)


def test_features_of_odd_texts():
    texts = ["", None, " \n ", "a", "A" * 50_000, "é" * 10, "x y\n" * 4000]
    found = list(qc.features(pa.array(texts), 10))
    assert len(found) == len(texts)
    for i, x in found:
        assert len(i) == len(x) and i.max() < qc.size(10) and len(set(i.tolist())) == len(i)
    assert found[0][0].tolist() == found[1][0].tolist()


def test_learns_an_interaction_that_no_linear_model_can(prose):
    r = np.random.default_rng(2)
    rows, marks = [], []
    for _ in range(600):
        a, b = r.integers(0, 2, 2)
        rows.append((np.array([a, 2 + b]), np.ones(2)))
        marks.append(float(a == b))
    m = qc.fit(rows, np.array(marks), 4, epochs=20)
    assert np.mean([(m.margin(*x) > 0) == y for x, y in zip(rows, marks)]) == 1


def test_one_mark_or_none(spark, documents, prose):
    docs = documents([(k, prose(k)) for k in range(6)] + [(7, None), (7, ""), (None, "x")])
    none = qc.quality_classifier(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == 9 and {r.score for r in none} == {0.5} and all(r.predicted == 1 for r in none)
    ones = qc.quality_classifier(docs, spark.createDataFrame([(k, 1, None) for k in range(6)] + [(1, None, 0)], LABELS)).collect()
    assert len({r.score for r in ones}) == 1 and ones[0].score > 0.5
    assert qc.quality_classifier(documents([]), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op4_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_a_labelled_id_with_many_rows_is_one_row_of_the_sample(spark, documents, prose, monkeypatch):
    seen = []
    monkeypatch.setattr(qc, "fit", lambda rows, marks, bits: seen.append((len(rows), list(marks))))
    rows = [(k, prose(k, 30)) for k in range(20)] + [(3, prose(1000 + k, 30)) for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    qc.train(documents(rows), labels, sample_rows=100)
    qc.train(documents(rows[::-1]).repartition(3), labels, sample_rows=100)
    assert seen[0] == seen[1] and seen[0][0] == 20
