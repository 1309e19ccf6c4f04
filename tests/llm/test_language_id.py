import zlib

import numpy as np
import pytest

from stormlens.llm import language_id as lid
from stormlens.llm import queries


def test_vector_counts_character_runs():
    i, x = lid.vector("abab", 16)
    grams = ["a", "b", "ab", "ba", "aba", "bab"]
    assert len(i) == len(grams) and x.sum() == pytest.approx(1)
    assert sorted(x * 9) == pytest.approx(sorted([2, 2, 2, 1, 1, 1]))
    assert lid.vector("ABAB", 16)[0].tolist() == i.tolist()


def test_pieces_change_nothing(monkeypatch):
    text = "ünïcode and plain text " * 40
    whole = lid.vector(text, 12)
    monkeypatch.setattr(lid, "_PIECE", 64)
    cut = lid.vector(text, 12)
    assert whole[0].tolist() == cut[0].tolist() and whole[1] == pytest.approx(cut[1])


def test_penalty_makes_weights_zero_and_temperature_lowers_loss():
    r = np.random.default_rng(0)
    rows, marks = [], r.integers(0, 3, 300)
    for y in marks:
        rows.append((np.array([y, 3 + r.integers(0, 50)]), np.array([1.0, 0.3])))
    weak, strong = lid.fit_ftrl(rows, marks, 3, 60, 3, l1=1e-4), lid.fit_ftrl(rows, marks, 3, 60, 3, l1=5.0)
    assert np.mean([(x @ weak[i]).argmax() == y for (i, x), y in zip(rows, marks)]) > 0.99
    assert (strong == 0).mean() > (weak == 0).mean() and (strong[3:] == 0).all()
    scores = np.array([x @ weak[i] for i, x in rows]) + r.normal(0, 2, (300, 3))
    loss = lambda t: np.mean(np.log(np.exp(scores / t).sum(1)) - (scores / t)[np.arange(300), marks])
    best = lid.temperature(scores, marks)
    assert loss(best) <= min(loss(best * 1.1), loss(best / 1.1)) + 1e-9


def test_defined_results(spark, documents):
    rows = [(k, "das ist ein Satz und noch einer " * (1 + k % 4) if k % 2 else "this is one sentence and another " * (1 + k % 3), "de" if k % 2 else "en") for k in range(80)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34 !?", "en"), (103, "é", None), (104, "x" * 100_000, "en"), (None, "ein Satz", "de"), (1, rows[1][1], "de")]
    docs = documents(rows)
    out = lid.language_id(docs)
    assert set(out.columns) == set(docs.columns) | {"held_out", "lang_pred", "score"}
    for r in out.collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 100:
            assert r.lang_pred == ("de" if r.doc_id % 2 else "en")
    assert lid.language_id(documents([])).count() == 0
    assert {r.lang_pred for r in lid.language_id(documents([(1, "text"), (2, None)])).collect()} == {"und"}


def test_copies_count_once_in_the_sample(spark, documents, prose, monkeypatch):
    """Four rows repeated 500 times beside 300 distinct ones of their language: the sample holds the language's bound of distinct rows."""
    seen = {}
    monkeypatch.setattr(lid, "fit_ftrl", lambda rows, marks, *a, **k: seen.update(rows=len(rows), marks=list(marks)) or np.zeros((a[1], a[0])))
    rows = [(k % 4, f"copy {k % 4} of a text", "aa") for k in range(2000)] + [(10 + k, prose(k, 12), "aa") for k in range(300)] + [(900 + k, prose(k, 12), "bb") for k in range(300)]
    for docs in (documents(rows), documents(rows[::-1]).repartition(5)):
        lid.train(docs, sample_rows=100)
        assert seen["rows"] == 80 and 25 <= seen["marks"].count(0) <= 55
        first = seen.setdefault("first", seen["marks"])
        assert seen["marks"] == first


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_language_id"](spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(lang)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert len(held) > 150 and np.mean(held) > 0.97
