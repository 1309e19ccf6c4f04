import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest

from stormlens.llm import mixing, queries


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by handing the excess around until no source is above its most."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    full, left = {}, Fraction(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = Fraction(most * sizes[s])
            left -= full[s]


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 100, "c": 1000, None: 5}, {"a": 7}, {"a": 0, "b": 0}, {"a": 0, "b": 9}, {"s10": 4, "s2": 4, "é": 900, "Z": 1, None: 0}, {}])
def test_targets_fill_up(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = filled(sizes) if sizes else {}
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(float(want[s]))


def test_taken_is_epochs_and_a_sorted_prefix(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS", 7)
    rows = [(k, prose(k, 1 + k * 7 % 90), None, "hot" if k % 2 else f"s{k % 6}") for k in range(120)]
    rows += [(500, None, None, None), (501, "", None, "s0"), (502, "w " * 40, None, None), (3, rows[3][1], None, "hot"), (None, "a b c", None, "s2"), (None, "d e", None, "s2")]
    docs = documents(rows)
    out = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for i, t, _, s in rows:
        u = (int(hashlib.md5(f"{'null:' + hashlib.md5((t or '').encode()).hexdigest() if i is None else i}:{mixing.SEED}".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
        by[s].append((-math.log(u) / 4.0, i if i is not None else -1, size(t)))
    goal = filled({s: sum(x[2] for x in v) for s, v in by.items()})
    want = []
    for s, v in by.items():
        total = sum(x[2] for x in v)
        epochs = goal[s] // total if total else 0
        rest, before = goal[s] - epochs * total, 0
        for _, i, n in sorted(v):
            want.append((i, n, n * (epochs + (n > 0 and before + Fraction(n, 2) <= rest))))
            before += n
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.taken) for r in out) == sorted(want)
    for r in out:
        assert r.taken <= 3 * r.size
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    repeated = mixing.mixed_rows(docs)
    assert repeated.columns == docs.columns and repeated.count() == sum(r.copies for r in out)


def test_no_documents(spark, documents):
    assert mixing.mix(documents([])).count() == 0 and mixing.mixed_rows(documents([])).count() == 0


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op5_mixing"]).fetchall())
    got = queries.QUERIES["op5_mixing"](spark, sf).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, got.collect())) == want
