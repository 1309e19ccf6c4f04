import numpy as np
import pytest

from stormlens.llm import ngram_join as nj
from stormlens.llm import queries
from stormlens.llm.components import connected_components

from .brute import brute


def changed(text, places):
    w = text.split()
    for p in places:
        w[p % len(w)] = f"changed{p}"
    return " ".join(w)


@pytest.fixture
def near_copies(prose):
    rows, base = [], prose(1, 300)
    rows += [(k, changed(base, range(k % 17))) for k in range(60)]  # a chain of near copies with exact ones among them
    rows += [(100 + k, changed(base, range(k, k + 11))) for k in range(0, 250, 9)]  # all near the base, not near each other
    rows += [(200 + k, prose(5, 60) + " " + prose(900 + k, 15 + k)) for k in range(20)]  # a long shared passage
    rows += [(300 + k, prose(2, k)) for k in range(12)] + [(400 + k, prose(2, k).upper()) for k in range(12)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, None), (504, "one"), (505, "One"), (506, "a b c d"), (507, "a b c d\n"), (508, "a b c d e")]
    rows += [(600, prose(7, 30_000)), (601, changed(prose(7, 30_000), range(0, 30_000, 60))), (602, "x " * 500), (603, "x " * 5)]
    rows += [(3, rows[3][1]), (700, "unrelated words here and there"), (800, base)]
    return rows


@pytest.mark.parametrize("block, heavy", [(512, 64), (8, 64), (512, 4)])
def test_components_equal_all_pairs(spark, documents, near_copies, block, heavy, monkeypatch):
    monkeypatch.setattr(nj, "MIN_HEAVY", heavy)
    if heavy == 4:
        monkeypatch.setattr(nj, "HEAVY", 1e-4)
    out = nj.jaccard_components(documents(near_copies), block=block)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(near_copies)


def test_null_ids_and_empty_tables(spark, documents, prose):
    got = sorted(map(tuple, nj.jaccard_components(documents([(None, prose(1)), (4, prose(1)), (None, None), (None, prose(2))])).collect()), key=repr)
    assert got == sorted([(None, 116, 4), (4, 116, 4), (None, 0, None), (None, 116, None)], key=repr)
    assert nj.jaccard_components(documents([])).count() == 0


def test_product_in_narrow_column_steps():
    r = np.random.default_rng(4)
    base = np.sort(r.choice(10_000, 100, replace=False).astype(np.uint64))
    sets = [np.unique(np.r_[base[r.random(100) < 0.95], r.integers(0, 10_000, 3).astype(np.uint64)]) for _ in range(40)]
    sig, n = np.arange(40), np.array([len(s) for s in sets])
    links = {(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert links
    for wide in (7, 4096):
        at = list(range(40))
        for a, b in nj.overlap_edges(sig, n, sets, 80, wide):
            at[a] = b
        want = list(range(40))
        for _ in range(40):
            for i, j in links:
                want[i] = want[j] = min(want[i], want[j])
        assert at == want


@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 40)], [(k, k) for k in range(3)], [],
                                   [(k * 37 % 101, k * 53 % 101) for k in range(60)], [(-5, 3), (3, -5), (2, -9)]])
def test_connected_components(spark, edges):
    want = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = connected_components(spark.createDataFrame(edges, "x long, y long"))
    assert dict(map(tuple, got.collect())) == want and got.count() == len(want)


def test_query_equals_all_pairs(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op7_ngram_jaccard"](spark, sf)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute(docs)
