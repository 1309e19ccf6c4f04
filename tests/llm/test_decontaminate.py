import pytest
import random

from stormlens.llm import decontaminate as dec
from stormlens.llm import queries

ITEMS = "item_id long, text string"


def distance(pattern, text):
    """Least edit distance of pattern to any substring of text, row by row."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_equals_the_matrix():
    r = random.Random(3)
    for _ in range(200):
        p = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 90)))
        t = bytes(r.choice(b"abc") for _ in range(r.randrange(0, 120)))
        assert dec.myers(p, t)[0] == distance(p, t)


def edited(text, n, r):
    b = list(text)
    for _ in range(n):
        k = r.randrange(len(b))
        b[k:k + 1] = r.choice([[], [r.choice("qz")], [b[k], r.choice("qz")]])
    return "".join(b)


def test_every_leak_within_the_budget_and_no_other(spark, documents, prose):
    r = random.Random(5)
    items = [(k, prose(1000 + k, 30)) for k in range(6)] + [(6, "too short"), (7, None), (8, ""), (0, prose(1000, 30))]
    rows = [(0, None), (1, ""), (2, prose(1)), (3, prose(2, 20000) + "!! " + items[2][1].upper().replace(" ", "\n\t") + prose(3, 9000))]
    for k in range(40):
        rows.append((10 + k, prose(50 + k, 40) + " " + edited(items[k % 6][1], k // 2, r) + " " + prose(90 + k, 40)))
    rows.append((10, rows[4][1]))
    got = sorted((x.doc_id, x.item_id, x.distance) for x in dec.find_leaks(documents(rows), spark.createDataFrame(items, ITEMS)).collect())
    expected = []
    for i, t in rows:
        for j, text in items[:6]:
            p = dec.trimmed(text).tobytes()
            d = distance(p, dec.normalise(t).tobytes()) if t and i != 3 else (0 if (i, j) == (3, 2) else 99)
            if d <= int(dec.RATE * len(p)):
                expected.append((i, j, d))
    assert got == sorted(expected) and len({d for *_, d in got}) > 3
    kept = dec.drop_leaks(documents(rows), spark.createDataFrame(items, ITEMS))
    assert kept.columns == documents([]).columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in rows if i not in {e[0] for e in expected})


def test_blocks_of_items_change_nothing(spark, documents, prose, monkeypatch):
    items = spark.createDataFrame([(k, prose(k, 30)) for k in range(5)], ITEMS)
    docs = documents([(k, prose(77) + " " + prose(k, 30)) for k in range(7)])
    one = sorted(map(tuple, dec.find_leaks(docs, items).collect()))
    monkeypatch.setattr(dec.item_blocks, "__defaults__", (300,))
    assert sorted(map(tuple, dec.find_leaks(docs, items).collect())) == one and len(one) == 5


def test_items_without_an_id_count(spark, documents, prose):
    items = spark.createDataFrame([(None, prose(1, 30)), (None, prose(2, 30)), (3, prose(3, 30))], ITEMS)
    docs = documents([(k, prose(50 + k, 40) + " " + prose(k, 30)) for k in range(1, 5)])
    got = sorted((r.doc_id, r.item_id) for r in dec.find_leaks(docs, items).collect())
    assert got == [(1, None), (2, None), (3, 3)]
    assert [r.doc_id for r in dec.drop_leaks(docs, items).collect()] == [4]


def test_short_items_match_exactly_as_words(spark, documents, prose):
    items = spark.createDataFrame([(1, "cat"), (2, "red house"), (3, "?!"), (4, "big red house"), (5, "a big red house here")], ITEMS)
    docs = documents([(1, "the cat sat"), (2, "concatenate"), (3, "A RED  house!"), (4, "tired houses red housing"), (5, "cat"), (6, "a bigred house"), (7, "one big red house"), (8, "a big rad house here")])
    got = sorted((r.doc_id, r.item_id, r.distance) for r in dec.find_leaks(docs, items).collect())
    assert got == [(1, 1, 0), (3, 2, 0), (5, 1, 0), (7, 2, 0), (7, 4, 0), (8, 5, 1)]
    assert [r.doc_id for r in dec.drop_leaks(docs, items).orderBy("doc_id").collect()] == [2, 4, 6]
    with pytest.raises(ValueError):
        dec.Pieces([(1, "some words of a test item")], 0.2)


def test_empty_tables(spark, documents, prose):
    none = spark.createDataFrame([], ITEMS)
    assert dec.find_leaks(documents([(1, prose(1))]), none).count() == 0
    assert dec.drop_leaks(documents([(1, prose(1))]), none).count() == 1
    assert dec.find_leaks(documents([]), spark.createDataFrame([(1, prose(1))], ITEMS)).count() == 0


def test_query_finds_every_exact_passage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    norm = lambda t: dec.trimmed(t).tobytes()
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if norm(i.text) in norm(d.text)}
    got = queries.QUERIES["op3_decontaminate"](spark, sf).collect()
    assert whole == {(r.doc_id, r.item_id) for r in got if r.distance == 0} and whole
