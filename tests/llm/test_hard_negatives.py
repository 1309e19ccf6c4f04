import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stormlens.llm import hard_negatives, queries
from stormlens.llm.hard_negatives import Lists, mine, search

SCHEMA = "vec_id long, embedding array<double>, label int, id long, key string, slab long, block string"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=5, positives=5, negatives=3, low=50, high=95):
    rows = {(i, tuple(v), label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    size = max([len(v) for _, v, _ in rows], default=0) or 1
    most = int((2 ** 55 / size) ** 0.5)
    rows = sorted({(i, tuple(max(-most, min(most, math.floor(256 * x))) for x in v) + (0,) * (size - len(v)), label) for i, v, label in rows})
    out = []
    for i, v, label in rows:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in rows if j != i)
        for p, j, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p][:negatives]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(hard)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "b") for r in rows], SCHEMA)


def run(df, **how):
    out = mine(df, anchors=F.col("id") % 5 == 0, **how)
    assert out.columns == list(COLUMNS)
    return sorted(map(tuple, out.collect()))


def around(r, centre, spread):
    return [x + r.gauss(0, spread) for x in centre]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(6)] for _ in range(4)]
    rows = [(k, around(r, centres[k % 4], 0.15), r.choice([0, 1, 1, 2])) for k in range(220)]
    rows += [(300 + k, rows[5][1], k % 2) for k in range(60)]  # one vector many times: ties
    rows += [(400 + k, [0.0] * 6, k % 3) for k in range(20)] + [(500 + k, [-x for x in rows[7][1]], 1) for k in range(10)]
    got = run(frame(spark, rows), block=40, slab=7)
    assert got == brute(rows) and len(got) > 100
    assert run(frame(spark, rows)) == got  # in one block


def test_odd_rows(spark):
    nan, inf, base = float("nan"), float("inf"), [0.5, -0.5, 0.25]
    rows = [(0, base, 1), (1, base, 1), (2, [0.4, -0.4, 0.2], 2), (3, [0.4, -0.4, 0.2], 2), (2, [0.4, -0.4, 0.2], 2), (4, [0.4, None, 0.2], 2), (6, [0.4, nan, 0.2], 2),
            (7, [inf, 0.0, 0.0], 2), (8, None, 2), (9, base, None), (None, base, 1), (11, [0.45, -0.45], 2), (12, [], 2), (5, base, 1), (5, [0.3, -0.5, 0.25], 1), (5, base, 2),
            (10, [1e300, 1.0, 1.0], 1), (13, [-1e300, 1.0, 1.0], 1), (14, [1e300, 1.0, 0.0], 2), (15, [0.0, 0.0, 0.0], 9), (20, base, 77)]
    got = run(frame(spark, rows), block=4, slab=2)
    assert got == brute(rows)
    assert {r[0] for r in got} >= {0, 5}
    assert run(frame(spark, [])) == [] and run(frame(spark, [(0, base, 1)])) == [] and run(frame(spark, [(8, None, 2)])) == []


def test_stops_before_the_lists_end():
    """One row stands out in every list: the rest is never scored."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-5, 6, (5000, 4))
    vectors[4321] = [900, -900, 900, 900]
    lists = Lists(np.arange(5000), np.zeros(5000, np.int64), vectors)
    scored = []
    real = lists.scores
    lists.scores = lambda rows, anchors: scored.append(len(rows)) or real(rows, anchors)
    best = search(lists, np.array([[3, -3, 3, 1]]), np.array([-1]), None, [[(-10 ** 9, 10 ** 9)]], 1)
    assert best[0][0].ids.tolist() == [4321] and sum(scored) < 500


def test_a_threshold_equal_to_the_kth_score_goes_on():
    vectors = np.array([[5]] * 100 + [[1]] * 100)
    lists = Lists(np.arange(200)[::-1].copy(), np.zeros(200, np.int64), vectors)
    best = search(lists, np.array([[2]]), np.array([-1]), None, [[(-100, 100)]], 3)
    assert best[0][0].ids.tolist() == [100, 101, 102] and best[0][0].scores.tolist() == [10, 10, 10]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.execute(f"select {', '.join(COLUMNS)} from ({queries.ORACLES['op12_hard_negatives']})").fetchall())
    got = sorted(map(tuple, queries.QUERIES["op12_hard_negatives"](spark, sf).select(*COLUMNS).collect()))
    assert got == want and len(want) > 50
    assert hard_negatives.POSITIVES == 5 and hard_negatives.NEGATIVES == 3
