import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from stormlens.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(nodes):
    """(top, siblings of each leaf level by level, as (left, right))."""
    n, levels = len(nodes), []
    while len(nodes) > 1:
        levels.append(nodes)
        nodes = [h(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    paths = []
    for at in range(n):
        path = []
        for level in levels:
            first = at - at % 3
            path.append(("".join(level[first:at]), "".join(level[at + 1:first + 3])))
            at //= 3
        paths.append(path)
    return nodes[0], paths


def brute(rows, tampered):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0], leaf_of(*row), leaf_of(*row[:4], tampered(row[0], row[4]))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by[s]])
    root, tops = tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for (doc_id, leaf, now), path in zip(by[s], trees[s][1]):
            for left, right in path + top:
                now = h(left, now, right)
            out.append((doc_id, leaf, trees[s][0], root, h(*(a + b for a, b in path + top)), now, now == root))
    return sorted(out, key=repr)


def even(doc_id, text):
    return text.replace("\n", "") if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text


def run(docs, height=8):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(changed, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.verify(merkle.build(docs, now={"text": now}, height=height))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=repr)


def as_rows(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


@pytest.mark.parametrize("height", [1, 2, 8])
def test_every_row_equals_brute_force(spark, documents, height):
    sizes = {None: 4, "": 1, "Z": 2, "a": 3, "é": 9, "hot": 100, "s10": 10, "s2": 28, "👍": 1}
    rows = [(len(s or "") * 1000 + k, f"text {k}\nline\n{'é' * (k % 3)}", "en" if k % 2 else None, s) for s, n in sizes.items() for k in range(n)]
    rows += [(1, None, None, "a"), (2, "", "", "a"), (None, "no id\n", "en", "a"), (None, None, None, None), (7, "one\nid", "en", "hot"), (7, "another", "en", "hot"), (8, "x\n" * 100_000, "en", "hot")]
    rows += [(77, "repeated\nrow", "en", "s2")] * 12
    docs = documents(rows)
    got = run(docs.repartition(7), height)
    assert got == brute(as_rows(docs), even)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_one_source(spark, documents, n):
    docs = documents([(k, f"a\nb{k}", None, "s") for k in range(n)])
    assert run(docs, 2) == brute(as_rows(docs), even)


def test_a_fold_reads_nothing_to_its_left():
    nodes = [h(str(k)).encode() for k in range(26)]
    subtree, other = merkle.Subtree(nodes, 3), h("other").encode()
    for at in range(26):
        assert subtree.fold(at, nodes[at]) == subtree.nodes[-1][0]
        want = merkle.Subtree([*nodes[:at], other, *nodes[at + 1:]], 3).nodes[-1][0]
        assert subtree.fold(at, other) == want
        for level, place in zip(subtree.nodes, (at, at // 3, at // 9)):
            level[place - place % 3:place] = [b"?"] * (place % 3)  # a resumed state doesn't need them
        assert subtree.fold(at, other) == want
        subtree = merkle.Subtree(nodes, 3)


def test_no_documents(spark, documents):
    built = merkle.build(documents([]))
    assert built.root() is None and merkle.verify(built).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, scale):
    con, sf = duckdb.connect(), f"/root/testdata/{scale}"
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    columns = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    want = sorted(con.execute(f"select {columns} from ({queries.ORACLES['op11_merkle_manifest']})").fetchall())
    got = queries.QUERIES["op11_merkle_manifest"](spark, sf).select(*columns.split(", "))
    assert sorted(map(tuple, got.collect())) == want
    rows = con.execute("select doc_id, source, lang, n_chars, text from documents").fetchall()
    assert sorted(want, key=repr) == brute(rows, even)
