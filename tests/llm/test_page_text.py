import html
import re

import numpy as np
import pytest

from stormlens.llm import page_text as pt
from stormlens.llm import queries

PAGES = "page_id long, url string, html string, id long, text string, host string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, 3, "clash", "clash") for r in rows], PAGES)


def article(page):
    return "\n".join(pt.main_lines(pt.page_lines(page), set()))


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>no</title><style>p{}</style></head><body><nav><ul><li>menu</nav><article><h1>T</h1><p>a<b>b</b>\n c<p>d<br>e</article><footer>f", "T\nab c\nd e"),
    ("<main><p>x &amp; y &lt;z&gt; &#233;&nbsp;&copy;</p><script>var p='</p><p>no'</script><p>2</p></main>", "x & y <z> é ©\n2"),
    ("<article><p>1<div class='ad banner'><p>buy</p></div><p>2</p><aside>s</aside><form><p>mail</p></form><section id=comments><p>c</section><p>3", "1\n2\n3"),
    ("<article><header>h</header><p>a</p><!-- <p>no</p> --><p class=notice>n</p><p>b</p><div style='display: none'>x</div><ul><li>i<li>j</ul></article>", "a\nb\ni\nj"),
    ("<article><p>a</p></article><article class=comment><p>reader</p></article><div class='sidebar'><article><p>teaser</p></article></div>", "a"),
    ("<ARTICLE><P>Up<BR/>per</P><p title='a>b'>q</p><select><option>o</select></ARTICLE>", "Up per\nq"),
    ("<body class='has-sidebar home'><div class='with-sidebar'><article class='post sidebar-left'><p>x</article></div><div class='sidebar'>s", "x"),
    ("<div class=sidebar><article><p>only one</article></div><nav>n</nav>", "only one"),
    ("<div><p>the long text of the page</p></div><aside><article>teaser</article></aside>", "the long text of the page"),
    ("<article>loose text<p>tail &am</article>", "loose text\ntail &am"),
    ("<article><p>1 < 2 and 3 > 2</p><p>unclosed", "1 < 2 and 3 > 2\nunclosed"),
])
def test_articles(page, want):
    assert article(page) == want


def test_alignment_is_a_longest_common_subsequence():
    r = np.random.default_rng(0)
    for _ in range(300):
        a, b = r.integers(0, 6, r.integers(0, 25)), r.integers(0, 6, r.integers(0, 25))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        found = a[pt.common_lines(a, b)]
        assert len(found) == table[-1, -1]
        rest = iter(b.tolist())
        assert all(x in rest for x in found.tolist())


def test_long_pages_of_repeated_lines(monkeypatch):
    """Two lines many thousand times: as fast as short pages, and as long a subsequence as any."""
    import time

    began = time.time()
    assert pt.common_lines(np.full(50_000, 7), np.full(40_000, 7)).sum() == 40_000
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2, 6000), r.integers(0, 2, 8000)
    found = a[pt.common_lines(a, b)]
    rest = iter(b.tolist())
    assert all(x in rest for x in found.tolist()) and time.time() - began < 30
    assert len(found) == pt._lengths(a.tolist(), b.tolist())[-1]
    monkeypatch.setattr(pt, "MATCHES", 0)  # rows of bits for all
    for _ in range(200):
        a, b = r.integers(0, 6, r.integers(0, 25)).tolist(), r.integers(0, 6, r.integers(0, 25)).tolist()
        halved, chained = [a[k] for k in np.flatnonzero(pt.common_lines(a, b))], pt._chain(a, b)
        rest = iter(b)
        assert len(halved) == len(chained) and all(x in rest for x in halved)


def test_shared_lines_go_where_no_element_names_the_article(spark, pages):
    frame = "<div>Site</div><div>Home | Shop</div>{}<div>All rights</div>"
    rows = [(k, f"http://h.org/a/{k}", frame.format(f"<div>body {k}</div><div>more {k}</div>")) for k in range(30)]
    rows += [(100, "http://alone.org/x", frame.format("<div>one</div>")), (101, None, "<p>no url</p>"), (102, "http://z.org/", None),
             (103, "http://z.org/", ""), (104, "http://y.org/1", "<article><p>same</p></article>"), (105, "http://y.org/2", "<article><p>same</p></article>"),
             (None, "http://y.org/3", "<article><p>null id</p></article>"), (100, "http://alone.org/x", frame.format("<div>one</div>").replace("one", "two"))]
    got = {}
    out = pt.extract(pages(rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for k in range(30):
        assert got[k] == [f"body {k}\nmore {k}"]
    assert sorted(got[100]) == ["one", "two"] and got[101] == ["no url"] and got[102] == got[103] == [""]
    assert got[104] == got[105] == ["same"] and got[None] == ["null id"]
    assert pt.extract(pages([])).count() == 0


def test_the_alignment_decides_about_lines_beside_and_inside_articles(spark, pages):
    page = "<div>Site</div><article><h1>Title {k}</h1><p>teaser {k}</p><p>Follow us</p></article><div>the long body {k}</div><div>All rights</div>"
    rows = [(k, f"http://h.org/a/{k}", page.format(k=k)) for k in range(12)]
    rows += [(20 + k, f"http://two.org/{k}", f"<div>Site</div><article><p>own {k}</p><p>said twice</p></article>") for k in range(2)]
    got = {r.page_id: r.text for r in pt.extract(pages(rows)).collect()}
    for k in range(12):
        assert got[k] == f"Title {k}\nteaser {k}\nthe long body {k}"
    assert got[20] == "own 0\nsaid twice" and got[21] == "own 1\nsaid twice"  # one other page is no proof inside an article


def test_copies_do_not_delete_each_other(spark, pages, prose):
    frame = "<div>Site</div><div>Home | Shop</div>{}<div>All rights</div>"
    body = [f"{prose(k, 12)}" for k in range(12)]
    text = "".join(f"<p>{x}</p>" for x in body)
    rows = [(k, f"http://h.org/b/1?print={k}", frame.format(text)) for k in range(40)]  # one text under many queries
    rows += [(50 + k, f"http://h.org/b/1?seen={k}", frame.format(text + f"<p>seen {k}</p>")) for k in range(40)]
    rows += [(100 + k, f"http://h.org/{x}/2", frame.format(f"<p>{prose(100 + k, 40)}</p>")) for k, x in enumerate("ac")]
    rows += [(200 + k, "http://copies.org/1", frame.format(text)) for k in range(3)] + [(210, "http://copies.org/1", frame.format(text))] * 2
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("2", "30"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted((r.page_id, r.text) for r in pt.extract(pages(rows)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    got = dict(found[0])
    assert found[0] == found[1] and len(found[0]) == len(rows)
    for k in range(40):
        assert got[k] == "\n".join(body) and got[50 + k] == "\n".join([*body, f"seen {k}"])
    assert got[100] == prose(100, 40) and got[101] == prose(101, 40)
    whole = "\n".join(["Site", "Home | Shop", *body, "All rights"])
    assert all(got[k] == whole for k in (200, 201, 202, 210))  # nothing but copies: no evidence


def test_neighbours_do_not_depend_on_the_ranges(spark, pages):
    keys = spark.createDataFrame([(f"h{k % 4}", f"/p{k * 7 % 50:02d}", k) for k in range(200)] + [("h1", "/p00", 500)] * 3, "host string, path string, id long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(repr, pt.neighbours(keys, ["host", "path", "id"], "host", ["path"]).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == 203


def test_recurring_sentences_inside_articles_stay(spark, pages, prose):
    rows = [(k, f"http://h.org/a/{k}", f"<article><p>{prose(k, 9)}</p><p>said again</p><p>{prose(50 + k, 9)}</p><p>Share this</p></article>") for k in range(9)]
    got = {r.page_id: r.text for r in pt.extract(pages(rows)).collect()}
    assert got == {k: f"{prose(k, 9)}\nsaid again\n{prose(50 + k, 9)}" for k in range(9)}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_gives_the_articles(spark, sf):
    got = {r.page_id: r.text for r in queries.QUERIES["op6_page_text"](spark, sf).collect()}
    source = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(source)
    for r in source:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(x for x in blocks if x)
