"""Hard-negative mining by Fagin's threshold algorithm.

Vectors are made integers. Rows are dealt into blocks of about ``BLOCK`` rows and anchors into slabs of
about ``SLAB`` by hash, so a label or a vector that a third of all rows share lies in all blocks;
every slab meets every block in a task of its own. Such a task keeps, for each dimension, the
block's rows sorted by that component. For an anchor the lists are read from the end that its sign names, all
to the same depth; a row met for the first time is scored by its whole integer inner product
(random access). The sum of the anchor's components times the last values read is the threshold: no
row that wasn't met scores more. An anchor is done when for each of its windows the threshold is strictly below
the kth score found in it (a row that ties could have a smaller id), or strictly below the window itself, or
when the lists end. Anchors are read in batches, whose list heads and scores are shared; depth grows by ``GROW``.

Two searches: the first rows of an anchor's own label (one window without bounds, over the lists
of that label's rows alone) give the positives; each positive's score gives a window for the rows
of other labels. A task emits at most k rows for each window; they are merged by window functions.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no
part; rows equal in id, label and vector count once; rows of one id with different labels or
vectors are rows of their own, but no row of an anchor's id is its positive or negative;
a shorter vector ends in zeros; components beyond +-sqrt(2 ** 55 / dimensions) after scaling
count as that bound, so that scores and their hundredfold fit a long. Ties go by the smaller id.
Anchors without a positive, and positives without a negative, give no row; an empty table gives
an empty result. Other columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
BLOCK = 16_384
SLAB = 4_096
BATCH = 64
DEPTH = 16
GROW = 4
_HITS = "key long, anchor long, window long, id long, score long"
_MIN, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Lists:
    """Rows of a block, with one list a dimension in the order of its components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        top = int(np.abs(vectors).max(initial=0))
        # sums of products below 2 ** 53 are exact in doubles, which multiply faster
        self.exact = lambda anchors: top * int(np.abs(anchors).max(initial=0)) * vectors.shape[1] < 1 << 53
        self.doubles = vectors.astype(np.float64) if top < 1 << 26 else None

    def heads(self, a: np.ndarray, start: int, end: int) -> np.ndarray:
        """Rows between two depths of the lists of one sign: of the high ends where ``a`` is true, else of the low ends."""
        n = len(self.ids)
        return np.concatenate([self.order[n - end:n - start, a[0]].ravel(), self.order[start:end, a[1]].ravel()])

    def last(self, anchors: np.ndarray, end: int) -> np.ndarray:
        """The threshold of each anchor when all its lists are read to ``end``."""
        n = len(self.ids)
        high, low = self.sorted[n - end], self.sorted[end - 1]
        return (np.maximum(anchors, 0) * high + np.minimum(anchors, 0) * low).sum(1)

    def scores(self, rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """Inner products, anchors x rows."""
        if self.doubles is not None and self.exact(anchors):
            return (anchors.astype(np.float64) @ self.doubles[rows].T).astype(np.int64)
        return anchors @ self.vectors[rows].T


class Best:
    """The k first rows within one window: scores from ``low`` to ``high``, higher ones first, then smaller ids."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def kth(self) -> int:
        return int(self.scores[self.k - 1]) if len(self.scores) >= self.k else _MIN

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        within = (scores >= max(self.low, self.kth())) & (scores <= self.high)
        scores, ids = scores[within], ids[within]
        if len(scores) > 4 * self.k:  # cut to those at or above the kth before they are sorted
            bar = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= bar], ids[scores >= bar]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[first], ids[first]

    def done(self, threshold: int) -> bool:
        return self.low > self.high or threshold < self.low or (len(self.scores) >= self.k and threshold < self.kth())


def search(lists: Lists, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray | None, windows: list[list[tuple[int, int]]], k: int) -> list[list[Best]]:
    """For each anchor and window the k first rows of ``lists``; rows with the anchor's id, and with its label if
    labels are given, take no part."""
    best = [[Best(low, high, k) for low, high in w] for w in windows]
    n, at, depth = len(lists.ids), 0, DEPTH
    met, open_ = np.zeros(n, bool), [a for a in range(len(anchors)) if any(b.low <= b.high for b in best[a])]
    while open_ and at < n:
        end, now = min(n, at + depth), np.array(open_)
        signs = ((anchors[now] > 0).any(0), (anchors[now] < 0).any(0))
        if not (signs[0].any() or signs[1].any()):
            signs[0][0] = True  # an anchor of zeros reads one list to its end
        rows = np.unique(lists.heads(signs, at, end))
        rows = rows[~met[rows]]
        met[rows] = True
        scores, threshold, left = lists.scores(rows, anchors[now]), lists.last(anchors[now], end), []
        for a, its, bar in zip(open_, scores, threshold.tolist()):
            other = lists.ids[rows] != ids[a]
            if labels is not None:
                other &= lists.labels[rows] != labels[a]
            for b in best[a]:
                b.add(its[other], lists.ids[rows][other])
            if not all(b.done(bar) for b in best[a]):
                left.append(a)
        open_, at, depth = left, end, depth * GROW
    return best


def _matrix(column, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.int64).reshape(n, -1)


def _columns(table: pa.Table, prefix: str, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {c: np.asarray(table.column(prefix + c), np.int64) for c in names} | {"vector": _matrix(table.column(prefix + "vector"), len(table))}


def _sides(anchors: pa.Table, block: pa.Table) -> tuple[dict, dict]:
    return _columns(anchors, "", ("key", "id", "label")), _columns(block, "its_", ("id", "label"))


def _batches(rows: np.ndarray):
    return (rows[at:at + BATCH] for at in range(0, len(rows), BATCH))


def _emit(out: list, anchors: dict, some: np.ndarray, best: list[list[Best]], names: list) -> None:
    for a, found, name in zip(some, best, names):
        for b, window in zip(found, name):
            out.extend((int(anchors["key"][a]), int(anchors["id"][a]), window, int(i), int(s)) for i, s in zip(b.ids, b.scores))


def _hits(out: list) -> pa.Table:
    names = ("key", "anchor", "window", "id", "score")
    columns = zip(*out) if out else ([] for _ in names)
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns)})


def _nearest(k: int):
    """The k first rows of each anchor's own label in a block."""
    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out: list = []
        if not len(anchors) or not len(block):
            return _hits(out)
        a, b = _sides(anchors, block)
        for label in np.unique(a["label"]):
            of = np.flatnonzero(b["label"] == label)
            if not len(of):
                continue
            lists = Lists(b["id"][of], b["label"][of], b["vector"][of])
            for some in _batches(np.flatnonzero(a["label"] == label)):
                best = search(lists, a["vector"][some], a["id"][some], None, [[(_MIN + 1, _MAX)]] * len(some), k)
                _emit(out, a, some, best, [[0]] * len(some))
        return _hits(out)

    return run


def _within(k: int, low: int, high: int):
    """The k first rows of other labels in a block for each window of each anchor; a window is named by its positive's score."""
    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out: list = []
        if not len(anchors) or not len(block):
            return _hits(out)
        a, b = _sides(anchors, block)
        positives = anchors.column("windows").to_pylist()
        lists = Lists(b["id"], b["label"], b["vector"])
        for some in _batches(np.arange(len(anchors))):
            names = [positives[x] for x in some]
            windows = [[(-(-low * p // 100), high * p // 100) for p in n] for n in names]
            best = search(lists, a["vector"][some], a["id"][some], a["label"][some], windows, k)
            _emit(out, a, some, best, names)
        return _hits(out)

    return run


def integers(rows: DataFrame, id: str, label: Column, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vector, key): the rows that take part, with vectors of scaled integers."""
    x = F.col("vector")
    whole = rows.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")) \
        .filter("id is not null and label is not null and vector is not null") \
        .filter(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    size = int(whole.agg(F.max(F.size(x))).first()[0] or 1) or 1
    bound = float(int((2 ** 55 / size) ** 0.5))
    number = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), v * scale))).cast("long"))
    padded = F.concat(number, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(x)))
    whole = whole.select("id", "label", padded.alias("vector")).withColumn("key", F.xxhash64("id", "label", "vector"))
    return whole.dropDuplicates(["key", "id", "label"])


def mine(rows: DataFrame, id: str = "vec_id", label: str | Column = "label", vector: str = "embedding", anchors: Column | None = None, scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK, slab: int = SLAB) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``anchors`` is a condition on
    ``id`` (default: every row); a negative's score is from ``low`` to ``high`` hundredths of the positive's."""
    rows = materialise(integers(rows, id, F.col(label) if isinstance(label, str) else label, vector, scale), "vectors")
    chosen = rows if anchors is None else rows.filter(anchors)
    blocks = max(1, -(-rows.count() // block))
    slabs = max(1, -(-chosen.count() // slab))
    deal = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = chosen.withColumn("slab", deal(slabs, 1)).withColumn("block", every(blocks))
    right = rows.select(deal(blocks, 2).alias("block"), *[F.col(c).alias(f"its_{c}") for c in ("id", "label", "vector")]) \
        .withColumn("slab", every(slabs)).groupBy("slab", "block")

    found = left.groupBy("slab", "block").cogroup(right).applyInArrow(_nearest(positives), _HITS)
    first = lambda k, *by: F.row_number().over(W.partitionBy(*by).orderBy(F.col("score").desc(), "id")) <= k
    near = materialise(found.withColumn("first", first(positives, "key", "anchor")).filter("first").drop("first", "window"), "positives")
    windows = near.groupBy(F.col("key").alias("__key"), F.col("anchor").alias("__anchor")).agg(F.collect_set("score").alias("windows"))
    asked = left.join(windows, (F.col("key") == F.col("__key")) & (F.col("id") == F.col("__anchor"))).drop("__key", "__anchor")
    found = asked.groupBy("slab", "block").cogroup(right).applyInArrow(_within(negatives, low, high), _HITS)
    rank = F.row_number().over(W.partitionBy("key", "anchor", "window").orderBy(F.col("score").desc(), "id"))
    hard = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    pairs = near.select(F.col("key").alias("__key"), F.col("anchor").alias("__anchor"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    same = (F.col("key") == F.col("__key")) & (F.col("anchor") == F.col("__anchor")) & (F.col("window") == F.col("positive_score"))
    return hard.join(pairs, same).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                                         F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
