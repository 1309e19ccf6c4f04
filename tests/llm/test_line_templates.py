from collections import defaultdict

from stormlens.llm import line_templates as lt
from stormlens.llm import queries


def test_templates(spark, documents, prose):
    rows = []
    for k in range(40):
        lines = [prose(k, 30), "All rights reserved.", f"Posted on 2024-01-{k:02d} by user{k} in News", f"Read more about our new offer {prose(k, 1)} today", prose(100 + k, 12)]
        rows.append((k, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "All rights reserved."), (54, "  All rights\treserved. \n kept"), (None, "All rights reserved.\nnull id")]
    rows += [(60 + k, "one text in many copies\n" + prose(7, 20)) for k in range(20)]  # a copied text counts once
    rows += [(90, "a b c d " + "word " * 30_000 + "\nAll rights reserved.")] * 2
    out = lt.drop_recurring_lines(documents(rows))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "id", "rank", "key", "text", "n_lines", "n_dropped"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append((r.text, r.n_lines, r.n_dropped))
    for k in range(40):
        assert got[k] == [(prose(k, 30) + "\n" + prose(100 + k, 12), 5, 3)]
    assert got[50] == [(None, 0, 0)] and got[51] == [("", 1, 0)] and got[52] == [("\n\n", 3, 0)]
    assert got[53] == [("", 1, 1)] and got[54] == [(" kept", 2, 1)] and got[None] == [("null id", 2, 1)]
    for k in range(60, 80):
        assert got[k] == [("one text in many copies\n" + prose(7, 20), 2, 0)]
    assert [x[1:] for x in got[90]] == [(2, 1)] * 2


def test_chance_agreement_is_no_template(spark, documents, prose):
    rows = [(k, "the same three " + prose(k, 20)) for k in range(60)] + [(100 + k, f"{k} {k}.5 {k}% total") for k in range(30)]
    assert all(r.n_dropped == 0 for r in lt.drop_recurring_lines(documents(rows)).collect())


def test_long_passages_go_from_two_texts_on(spark, documents, prose):
    rows = [(k, f"{prose(k, 30)}\n{prose(500 + k // 2, 60)}\n{prose(700 + k // 2, 40)}") for k in range(8)]
    rows += [(20 + k, f"{prose(20 + k, 30)}\n{prose(800, 30)} name{'xyz'[k]} {prose(801, 30)}") for k in range(3)]  # with a field
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(documents(rows)).collect()}
    for k in range(8):
        assert got[k] == f"{prose(k, 30)}\n{prose(700 + k // 2, 40)}"
    assert all(got[20 + k] == prose(20 + k, 30) for k in range(3))


def test_verbatim_lines_need_no_plain_tokens(spark, documents, prose):
    fixed = ["Page 3", "Version 2.0", "3 May 2021", "Page 3 of 10", "2024-01-01"]
    rows = [(k, "\n".join([prose(k, 30), *fixed, f"Part {k}"])) for k in range(12)]
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(documents(rows)).collect()}
    assert got == {k: f"{prose(k, 30)}\nPart {k}" for k in range(12)}


def test_a_template_does_not_depend_on_the_rest_of_its_leaf(spark, documents, prose):
    city = lambda k: f"city{'abcdefghijklmnopqrstuvwxyz'[k % 26]}"
    planted = [(k, f"{prose(k, 30)}\nwe sell in {city(k)} and {prose(900 + k, 1)} at very low prices") for k in range(24)]
    others = [(100 + k, f"{prose(100 + k, 30)}\nwe sell in {prose(2000 + k, 8)}") for k in range(900)]  # 24 of 924 are below 5 %
    for rows in (planted, planted + others):
        got = {r.doc_id: r.text for r in lt.drop_recurring_lines(documents(rows)).collect()}
        assert got == {k: prose(k, 30) if k < 100 else t for k, t in rows}


def test_empty_table(spark, documents):
    assert lt.drop_recurring_lines(documents([])).count() == 0


def test_query_drops_every_literal_line_that_recurs(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    texts = defaultdict(set)
    for t in docs.values():
        for line in t.split("\n"):
            texts[line].add(t)
    for r in queries.QUERIES["op8_line_templates"](spark, sf).collect():
        lines, kept = docs[r.doc_id].split("\n"), r.text.split("\n")
        assert r.n_lines == len(lines) and (r.n_dropped == len(lines) - len(kept) or r.n_dropped == len(lines) and r.text == "")
        assert not any(len(texts[x]) >= lt.MIN_DOCS for x in kept if x.strip())


def test_only_dataframe_operations(spark, sf):
    plan = queries.QUERIES["op8_line_templates"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Pandas" not in plan


def brute(texts, min_docs, similarity=0.6):
    """The tree by loops over distinct texts: {text: positions that go}."""
    import re

    need = lambda size: min(lt.LONG_DOCS, min_docs) if size > lt.LONG else min_docs
    parsed, holders = {}, defaultdict(set)
    for t in set(texts):
        for pos, raw in enumerate(t.split("\n")):
            tokens = ["<*>" if re.search("[0-9]", x) else x for x in re.sub(r"[ \t\x0b\f\r]+", " ", raw).strip(" ").split(" ")]
            if tokens == [""]:
                continue
            line = tuple(tokens) if sum(x != "<*>" for x in tokens) >= similarity * len(tokens) else raw
            parsed[t, pos] = line, tokens
            holders[line].add(t)
    gone_lines = {line for (t, pos), (line, tokens) in parsed.items() if len(holders[line]) >= need(len(tokens))}
    leaves = defaultdict(dict)
    for line, tokens in parsed.values():
        if line not in gone_lines:
            leaves[len(tokens), tuple(tokens[:3])][line] = tokens
    named = defaultdict(set)
    for (size, lead), held in leaves.items():
        if sum(len(holders[x]) for x in held) < need(size):
            continue
        count = defaultdict(int)
        for line, tokens in held.items():
            for at, x in enumerate(tokens):
                count[at, x] += len(holders[line]) if x != "<*>" else 0
        often = {k for k, n in count.items() if n >= need(size) and k[0] >= 3}
        narrow = {k for k in often if sum(a == k[0] for a, _ in often) <= lt.FAN}
        for line, tokens in held.items():
            for keep in (often, narrow):
                shape = tuple(x if (at < 3 and x != "<*>") or (at, x) in keep else None for at, x in enumerate(tokens))
                if size > 3 and sum(x is not None for x in shape) >= similarity * size:
                    named[shape].add(line)
    for shape, held in named.items():
        if len({t for line in held for t in holders[line]}) >= need(len(shape)):
            gone_lines |= held
    return {t: {pos for (u, pos), (line, _) in parsed.items() if u == t and line in gone_lines} for t in set(texts)}


def test_tree_equals_brute_force(spark, documents, prose):
    import random

    r = random.Random(6)
    days, names = ["Mon", "Tue", "Wed", "Thu", "Fri"], ["Ann", "Bob", "Cy", "Di"]
    makers = [lambda: f"filed on {r.choice(days)} by {r.choice(names)} for the record office", lambda: f"Page {r.randrange(4)}", lambda: f"total  {r.randrange(99)} items sold to {prose(r.randrange(50), 1)} in town ",
              lambda: "All rights reserved.", lambda: prose(r.randrange(10 ** 6), r.randrange(1, 9)), lambda: f"we sell in {prose(r.randrange(9), 1)} and {prose(r.randrange(9), 1)} now", lambda: "", lambda: "\t ",
              lambda: f"{prose(77, 30)} {r.choice(days)} {prose(78, 30)}", lambda: f"a b c {r.choice('defgh')} {r.choice('ijklm')} {r.choice('nopqr')} {r.choice('stuvw')} x y z"]
    texts = ["\n".join(r.choice(makers)() for _ in range(r.randrange(1, 7))) for _ in range(150)]
    texts += texts[:20]
    want = brute(texts, 6)
    out = lt.drop_recurring_lines(documents(list(enumerate(texts))), min_docs=6).collect()
    assert sum(map(len, want.values())) > 100
    for row in out:
        t = texts[row.doc_id]
        assert row.n_dropped == len(want[t]) and row.text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[t])
