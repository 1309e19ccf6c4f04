"""HTML extraction by nearest-URL page differencing.

A page is read into lines (the text of its blocks in page order). Lines inside an element that
says it is not the article (navigation, header, footer, aside, form, or a class or id such as
ad, notice, sidebar, comments) go. All other lines are decided by alignment (longest common
subsequence) with the pages beside it in the order of host and path, two before and two after
on the same host:

* a line outside ``article`` and ``main`` goes if the nearest page has it too (the one next to it
  whose path has the longer beginning in common; ties: the one before);
* a line inside such an element goes if the articles of all pages beside it, at least ``SEVERAL`` that
  differ from each other, begin or end with it too (or with a run of lines that it belongs to), so that
  neither a sentence that recurs nor one more print of the article deletes anything.

Copies say nothing about each other. Two pages are copies if the lines that they share hold at least
``COPY`` of the characters of both (of the article's, where that has half of the text). A run of pages
of which each is a copy of the one before counts as its first page: only first pages are
neighbours, and all pages of a run are compared with the same ones. A neighbour that is a copy
of the page all the same is passed over. A page whose article stands in a frame element is what
has more text, that article or the rest.

The order is exact at any size: pages are dealt by ranges of (host, path, id), neighbours
are taken within a range, and the first and last page of each range close the gaps. Only
hashes of lines travel; the text is read again for the result.

Defined results: a null or empty html gives an empty text; a url without host counts as host
"" and is paired like any other; a page alone on its host, or beside nothing but copies, keeps
every line that no element marks; unclosed elements end with their parent; an unclosed
comment, script or style takes the rest of the page.
"""

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.arrays import with_columns
from stormlens.llm.storage import materialise
from stormlens.llm.url_filter import parts

HIDDEN = frozenset("script style noscript template head title svg iframe object select textarea button canvas math datalist".split())
FRAME = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("article aside body details dialog div dl fieldset figure footer form header html li main menu nav ol section span table td tr ul p".split())
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies
consent disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo
related search share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets""".split())
#: The marks that count on an article element, which often carries the names of its surroundings.
ARTICLE_MARKS = frozenset("ad ads advert comment comments promo related sponsored teaser".split())
ABOUT_OTHERS = frozenset("with has no without is not".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

SEVERAL = 2
COPY = 0.9
MATCHES = 16
RANGE_ROWS = 5000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


def is_frame(name: str, attributes: str) -> bool:
    """Whether an element says that it isn't part of the article."""
    if name in FRAME:
        return True
    if name in ("html", "body", "main"):
        return False
    marks = ARTICLE_MARKS if name == "article" else MARKS
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role":
            if value in ROLES:
                return True
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif key in ("class", "id"):
            for words in map(_WORD.findall, value.split()):
                if words and words[0] not in ABOUT_OTHERS and not marks.isdisjoint(words):
                    return True
    return False


def page_lines(page: str) -> list[tuple[str, bool, bool]]:
    """(text, in an article or main element, in a frame element) of each block with text."""
    lines: list[tuple[str, bool, bool]] = []
    open_: list[tuple[str, bool, bool]] = []  # container, article, frame: as they hold inside it
    text: list[str] = []
    article = frame = False

    def flush():
        if text:
            line = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if line:
                lines.append((line, article, frame))
            text.clear()

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in HIDDEN and not closing:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            text.append(" " if name in ("select", "button", "textarea") else "")
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if name not in CONTAINERS:
            continue
        if closing:
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if depth is not None:
                flush()
                del open_[depth:]
                _, article, frame = open_[-1] if open_ else ("", False, False)
        elif not m[3].rstrip().endswith("/"):
            marked = is_frame(name, m[3])
            if name == "p" or name == "span":
                if not marked:  # paragraphs need no closing tag; only marked ones are followed
                    if name == "p" and open_ and open_[-1][0] == "p":
                        open_.pop()
                        _, article, frame = open_[-1] if open_ else ("", False, False)
                    continue
            flush()
            article = article or name in ("article", "main")
            frame = frame or marked
            open_.append((name, article, frame))
    flush()
    return lines


def _chain(x: list, y: list) -> list[int]:
    """Hunt and Szymanski: places in x of a longest common subsequence, by the longest rising chain of matches."""
    import bisect

    where: dict = {}
    for j in range(len(y) - 1, -1, -1):
        where.setdefault(y[j], []).append(j)
    tails: list[int] = []
    links: list = []
    for i, v in enumerate(x):
        for j in where.get(v, ()):
            k = bisect.bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    link, out = links[-1] if links else None, []
    while link is not None:
        out.append(link[0])
        link = link[1]
    return out


def _lengths(x: list, y: list) -> np.ndarray:
    """Length of the longest common subsequence of x and each beginning of y; the bits of one integer hold a row."""
    masks: dict = {}
    for j, v in enumerate(y):
        masks[v] = masks.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for v in x:
        hit = row & masks.get(v, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(y)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _halved(x: list, y: list, first: int, out: list[int]) -> None:
    """Hirschberg: places (from ``first`` on) in x of a longest common subsequence, in linear space."""
    work = [(x, y, first)]
    while work:
        x, y, first = work.pop()
        if not x or not y:
            continue
        if len(x) == 1:
            if x[0] in y:
                out.append(first)
            continue
        mid = len(x) // 2
        cut = int((_lengths(x[:mid], y) + _lengths(x[mid:][::-1], y[::-1])[::-1]).argmax())
        work += [(x[:mid], y[:cut], first), (x[mid:], y[cut:], first + mid)]


def common_lines(a, b) -> np.ndarray:
    """Which elements of a are in a longest common subsequence of a and b. Few matches are chained one by one; with
    many (repeated lines) rows of bits are halved, so neither time nor memory grows with the number of matches."""
    a, b = [int(v) for v in a], [int(v) for v in b]
    shared = np.zeros(len(a), bool)
    left, least = 0, min(len(a), len(b))
    while left < least and a[left] == b[left]:
        left += 1
    right = 0
    while right < least - left and a[-1 - right] == b[-1 - right]:
        right += 1
    shared[:left] = True
    shared[len(a) - right:] = True
    rest = b[left:len(b) - right]
    counts: dict = {}
    for v in rest:
        counts[v] = counts.get(v, 0) + 1
    places = [k for k in range(left, len(a) - right) if a[k] in counts]
    x = [a[k] for k in places]
    known = set(x)
    y = [v for v in rest if v in known]
    if x and y:
        found: list[int] = []
        if sum(counts[v] for v in x) <= MATCHES * (len(x) + len(y)):
            found = _chain(x, y)
        else:
            _halved(x, y, 0, found)
        shared[[places[k] for k in found]] = True
    return shared


def _hash(line: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) >> 1


def ranges(rows: DataFrame) -> int:
    """Into how many ranges rows are dealt; where they are cut doesn't show in the result."""
    return max(1, -(-rows.count() // RANGE_ROWS))


def neighbours(keys: DataFrame, order: list[str], within: str, carry: list[str]) -> DataFrame:
    """``keys`` with the ``carry`` columns of the row before and after in the order (prev_*,
    next_*), null where that row has another ``within``. Ranges are sorted on their own; the
    first and last rows of all ranges (two a range) fill in what lies across a border."""
    dealt = materialise(keys.repartitionByRange(ranges(keys), *order).withColumn("__range", F.spark_partition_id()), "ordered")
    inside = W.partitionBy("__range").orderBy(*order)
    here = F.struct(within, *carry)
    rows = dealt.withColumns({"__prev": F.lag(here).over(inside), "__next": F.lead(here).over(inside)})
    edges = dealt.groupBy("__range").agg(F.min_by(here, F.struct(*order)).alias("first"), F.max_by(here, F.struct(*order)).alias("last"))
    across = W.orderBy("__range")  # one row a range
    edges = edges.select("__range", F.lag("last").over(across).alias("__before"), F.lead("first").over(across).alias("__after"))
    rows = rows.join(edges, "__range")
    prev, next_ = F.coalesce("__prev", "__before"), F.coalesce("__next", "__after")
    out = {f"{side}_{c}": F.when(x[within] == F.col(within), x[c]) for side, x in (("prev", prev), ("next", next_)) for c in carry}
    return rows.withColumns(out).drop("__range", "__prev", "__next", "__before", "__after")


def _same_beginning(a, b):
    """Length of the common beginning of two strings."""
    n = F.least(F.length(a), F.length(b))
    differs = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.when(n < 1, F.lit(0)).when(F.size(differs) > 0, F.element_at(differs, 1) - 1).otherwise(n)


def filled(rows: DataFrame, order: list[str], column: str) -> DataFrame:
    """``rows`` with nulls of ``column`` taken from the last row before that has a value; ranges as in
    ``neighbours``."""
    dealt = materialise(rows.repartitionByRange(ranges(rows), *order).withColumn("__range", F.spark_partition_id()), "ordered")
    inside = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    last = F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))
    across = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    edges = dealt.groupBy("__range").agg(last.alias("last")).select("__range", F.last("last", ignorenulls=True).over(across).alias("__before"))
    found = dealt.withColumn("__last", F.last(column, ignorenulls=True).over(inside)).join(edges, "__range")
    return found.withColumn(column, F.coalesce("__last", "__before")).drop("__range", "__last", "__before")


class Page:
    """The unmarked lines of a page: hashes, numbers of characters, whether inside an article."""

    def __init__(self, page: dict):
        self.lines, self.sizes, self.inside = page["lines"], page["sizes"], page["inside"]
        self.known = frozenset(self.lines)
        article = sum(n for n, a in zip(self.sizes, self.inside) if a)
        main = self.inside if 2 * article >= sum(self.sizes) else [True] * len(self.lines)
        self.main = [v for v, m in zip(self.lines, main) if m]
        self.weights = [n for n, m in zip(self.sizes, main) if m]
        self.weight = sum(self.weights)

    def copies(self, other: "Page") -> bool:
        least = COPY * max(self.weight, other.weight)
        there = frozenset(other.main)
        if sum(n for v, n in zip(self.main, self.weights) if v in there) < least:
            return False
        return bool(np.array(self.weights)[common_lines(self.main, other.main)].sum() >= least)

    def edges(self, others: list["Page"]) -> list[int]:
        """The numbers of the lines with which the article and those of all ``others`` begin, or end."""
        own, theirs = self.article(), [x.article() for x in others]
        out = []
        for sign in (1, -1):
            for k, place in enumerate(own[::sign]):
                if not all(k < len(t) and x.lines[t[::sign][k]] == self.lines[place] for t, x in zip(theirs, others)):
                    break
                out.append(place)
        return out

    def article(self) -> list[int]:
        return [k for k, inside in enumerate(self.inside) if inside]

    def gone(self, others: list["Page"]) -> np.ndarray:
        """The numbers of the lines that go; ``others``: pages beside it, the nearest first."""
        distinct: list[Page] = []
        for other in others:
            if not any(other.copies(x) for x in (self, *distinct)):
                distinct.append(other)
        out = np.zeros(len(self.lines), bool)
        if distinct:
            if any(v in distinct[0].known and not a for v, a in zip(self.lines, self.inside)):
                out = common_lines(self.lines, distinct[0].lines) & ~np.array(self.inside, bool)
            edges = self.edges(distinct) if len(distinct) >= SEVERAL else []
            if edges:
                shared = np.logical_and.reduce([common_lines(self.lines, x.lines) for x in distinct])
                out[edges] |= shared[edges]
        return np.flatnonzero(out)


_PAGE = "struct<lines:array<bigint>,sizes:array<int>,inside:array<boolean>>"


def _key(url: str, html: str):
    return F.xxhash64(F.coalesce(F.col(url), F.lit("")), F.lit(0), F.col(html))


def beside(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``others``: up to two pages before and two after on the same host, nearest first."""
    one = neighbours(rows, order, "host", ["path", "page"])
    before, after = _same_beginning(F.col("prev_path"), F.col("path")), _same_beginning(F.col("next_path"), F.col("path"))
    one = one.withColumn("later", F.coalesce(after > before, F.col("prev_page").isNull())).drop("prev_path", "next_path")
    two = neighbours(one, order, "host", ["prev_page", "next_page"])
    sides = [F.array("prev_page", "next_page"), F.array("prev_prev_page", "next_next_page")]
    others = F.concat(*[F.when(F.col("later"), F.reverse(x)).otherwise(x) for x in sides])
    return two.select(*rows.columns, F.array_compact(others).alias("others"))


def frame_lines(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, key, gone): the numbers of each page's unmarked lines that the pages beside it delete.
    ``key`` is a hash of url and html, so that repeated ids are told apart."""
    def run(batches):
        for batch in batches:
            found = [[(_hash(t), len(t), article) for t, article, frame in page_lines(h.as_py() or "") if not frame] for h in batch.column("html")]
            fields = [pa.array([[x[k] for x in f] for f in found], pa.list_(t)) for k, t in enumerate((pa.int64(), pa.int32(), pa.bool_()))]
            yield with_columns(batch, ("html",), page=pa.StructArray.from_arrays(fields, names=["lines", "sizes", "inside"]))

    rows = pages.select(F.col(id).cast("long").alias("id"), _key(url, html).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("__url"), F.col(html).alias("html"))
    host, path = parts(F.col("__url"))
    lined = rows.select("id", "key", host.alias("host"), path.alias("path"), "html") \
        .mapInArrow(run, f"id long, key long, host string, path string, page {_PAGE}").filter(F.size("page.lines") > 0)
    lined = materialise(lined, "page-lines")
    order = ["host", "path", "id", "key"]

    def begin(batches):
        for batch in batches:
            more = [b is not None and Page(a).copies(Page(b)) for a, b in zip(batch.column("page").to_pylist(), batch.column("prev_page").to_pylist())]
            yield with_columns(batch, ("prev_page",), more=pa.array(more, pa.bool_()))

    runs = neighbours(lined, order, "host", ["page"]).drop("next_page") \
        .mapInArrow(begin, f"id long, key long, host string, path string, page {_PAGE}, more boolean")
    runs = materialise(runs, "runs")
    firsts = beside(runs.filter(~F.col("more")), order)
    paired = filled(firsts.unionByName(runs.filter("more"), allowMissingColumns=True), [*order, "more"], "others")

    def align(batches):
        for batch in batches:
            gone = [Page(a).gone([Page(b) for b in others or ()]).tolist()
                    for a, others in zip(batch.column("page").to_pylist(), batch.column("others").to_pylist())]
            yield with_columns(batch, ("page", "others"), gone=pa.array(gone, pa.list_(pa.int32())))

    return paired.select("id", "key", "page", "others").repartition(ranges(lined), "key").mapInArrow(align, "id long, key long, gone array<int>") \
        .filter(F.size("gone") > 0).dropDuplicates(["id", "key"])


def main_lines(lines: list[tuple[str, bool, bool]], gone: set[int]) -> list[str]:
    """The page's text from its lines; ``gone`` numbers the unmarked ones that the alignment deletes.
    Where an article stands in a frame element only, it is what has more text, that article or the rest."""
    unmarked = [(t, article) for t, article, frame in lines if not frame]
    rest = [t for k, (t, _) in enumerate(unmarked) if k not in gone]
    if any(article for _, article in unmarked):
        return rest
    framed = [t for t, article, _ in lines if article]
    return framed if sum(map(len, framed)) > sum(map(len, rest)) else rest


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    gone = materialise(frame_lines(pages, id, url, html), "frames").withColumnsRenamed({"id": "__id", "key": "__key"})

    def run(batches):
        for batch in batches:
            texts = []
            for page, drop in zip(batch.column("html"), batch.column("gone")):
                texts.append("\n".join(main_lines(page_lines(page.as_py() or ""), set(drop.as_py() or ()))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"), _key(url, html).alias("key"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left")
    return joined.select("id", "url", "html", "gone").mapInArrow(run, "id long, url string, text string, n_chars long") \
        .withColumnsRenamed({"id": id, "url": url})
