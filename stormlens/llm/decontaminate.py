"""Benchmark decontamination: pigeonhole edit matching.

A test item leaks into a document when some substring of the document is within
``floor(rate * length)`` edits of the item (insert, delete, replace a byte of normalised
UTF-8: lower case, every run of ASCII characters other than letters and digits one space).
With an error budget of k, an item is split into k + 1 pieces; k edits leave one piece intact,
so every leak shows an exact piece hit. Hits are found on the bytes of whole texts (8-byte
windows against a sorted key table, then at most two more windows of the piece), and the window around each
one is verified by Myers' bit-parallel edit distance.

The test items are a stated query set: they are read in blocks of at most ``BLOCK_BYTES``
of text, each broadcast to one scan of the documents; the bound doesn't grow with either table.

An item so short that its budget is 0 matches exactly and as whole words only; a rate that would
make pieces shorter than 8 bytes is an error.

Defined results: null and empty texts match nothing, nor do items without a letter or digit; repeated rows give repeated
matches; repeated items match each under its own id (once for equal pairs of id and text); items
without an id count like others and are reported with a null item_id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlens.llm.arrays import LOWER

RATE = 0.06
KEY = 8
PIECE_BYTES = 24
BLOCK_BYTES = 4_000_000

_CLASS = LOWER.copy()
_CLASS[:128][~np.isin(np.arange(128), [*range(48, 58), *range(65, 91), *range(97, 123)])] = 0x20


def normalise(text: str) -> np.ndarray:
    """Lower-cased UTF-8 bytes with one space for each run of other ASCII characters."""
    b = _CLASS[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]
    space = b == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    return b[keep]


def trimmed(text: str) -> np.ndarray:
    return np.frombuffer(normalise(text).tobytes().strip(), np.uint8)


def windows(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one number."""
    if len(b) < KEY:
        return np.zeros(0, np.uint64)
    w = b.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        w = w[:-step] | (w[step:] << np.uint64(bits))
    return w


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any substring of ``text``, where the first such
    substring ends); the bits of one integer hold a whole column of the matrix."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        diag = ((((eq & up) + up) ^ up) | eq | down) & full
        right, left = (down | ~(diag | up)) & full, up & diag
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up, down = (left | ~((eq | down) | right)) & full, right & (eq | down)
        if score < best:
            best, end = score, j
    return best, end


class Pieces:
    """The pieces of a block of items, sorted by their first 8 bytes."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.short, keys, rows = [], [], [], []
        for item, text in items:
            b = trimmed(text)
            if len(b) < KEY:
                if len(b):
                    self.short.append((item, b" " + b.tobytes() + b" "))
                continue
            budget = int(rate * len(b))
            if len(b) // (budget + 1) < KEY:
                raise ValueError(f"at a rate of {rate} pieces are shorter than {KEY} bytes")
            cuts = np.linspace(0, len(b), budget + 2).astype(int)
            for a, z in zip(cuts[:-1], cuts[1:]):
                w = windows(b[a:min(z, a + PIECE_BYTES)])
                keys.append(w[0])
                rows.append((len(self.items), a, w[-1], len(w) - 1, w[min(KEY, len(w) - 1)], min(KEY, len(w) - 1)))
            self.items.append((item, b.tobytes(), budget))
        order = np.argsort(np.array(keys, np.uint64), kind="stable") if keys else np.zeros(0, int)
        self.keys = np.array(keys, np.uint64)[order]
        self.item, self.at, self.last, self.last_at, self.middle, self.middle_at = (
            np.array([r[k] for r in rows], np.uint64 if k in (2, 4) else np.int64)[order] for k in range(6))
        self.filter = np.zeros(1 << 18, bool)
        self.filter[self.slot(self.keys)] = True

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)

    def hits(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, where it would begin) of every exact piece hit."""
        w = windows(b)
        pos = np.flatnonzero(self.filter[self.slot(w)])
        lo, hi = np.searchsorted(self.keys, w[pos], "left"), np.searchsorted(self.keys, w[pos], "right")
        pos, lo, n = pos[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        pos = np.repeat(pos, n)
        piece = np.repeat(lo, n) + np.arange(len(pos)) - np.repeat(np.cumsum(n) - n, n)
        for value, offset in ((self.last, self.last_at), (self.middle, self.middle_at)):
            there = pos + offset[piece]
            ok = there < len(w)
            pos, piece, there = pos[ok], piece[ok], there[ok]
            ok = w[there] == value[piece]
            pos, piece = pos[ok], piece[ok]
        return self.item[piece], pos - self.at[piece]

    def leaks(self, b: np.ndarray):
        """(item id, distance, begin, end) of the best match of every leaked item in a text."""
        best: dict[int, tuple[int, int, int]] = {}
        item, begin = self.hits(b) if len(self.keys) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.lexsort((begin, item))
        a = 0
        while a < len(order):
            i = int(item[order[a]])
            _, pattern, budget = self.items[i]
            z = a + 1  # hits close to each other share one window
            if not budget:
                first = int(begin[order[a]])
                end = first + len(pattern)
                whole = (first == 0 or b[first - 1] == 0x20) and (end >= len(b) or b[end] == 0x20)
                if i not in best and whole and b[first:end].tobytes() == pattern:
                    best[i] = (0, first, end)
                a = z
                continue
            while z < len(order) and item[order[z]] == i and begin[order[z]] - begin[order[z - 1]] <= 2 * budget + 1:
                z += 1
            first = max(0, int(begin[order[a]]) - budget)
            found, end = myers(pattern, b[first:int(begin[order[z - 1]]) + len(pattern) + budget].tobytes())
            if found <= budget and (i not in best or found < best[i][0]):
                best[i] = (found, max(0, first + end - len(pattern)), first + end)
            a = z
        out = [(self.items[i][0], *best[i]) for i in sorted(best)]
        if self.short:
            padded = b" " + b.tobytes() + b" "
            out += [(item, 0, at, at + len(word) - 2) for item, word in self.short if (at := padded.find(word)) >= 0]
        return out


def item_blocks(items: DataFrame, id: str, text: str, block_bytes: int = BLOCK_BYTES):
    """The test items in lists of at most about ``block_bytes`` of text."""
    t = items.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter("text is not null").distinct()
    size = t.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size * 2 // block_bytes) or 1
    for k in range(blocks):
        yield sorted(((r.id, r.text) for r in t.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(id, item_id, distance, begin, end): the best match of each leaked item in each document;
    begin and end are byte positions in the normalised text. No row for a clean document."""
    found = None
    for block in item_blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Pieces(block, rate))

        def run(batches, shared=shared):
            pieces = shared.value
            for batch in batches:
                rows = []
                for key, t in zip(batch.column(0), batch.column(1)):
                    t = t.as_py()
                    if t:
                        rows += [(key.as_py(), *r) for r in pieces.leaks(normalise(t))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)],
                                                 names=["id", "item_id", "distance", "begin", "end"])

        part = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")) \
            .mapInArrow(run, "id long, item_id long, distance long, begin long, end long")
        found = part if found is None else found.union(part)
    return found.withColumnRenamed("id", id)


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no test item leaks; no shuffle."""
    for block in item_blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Pieces(block, rate))

        def run(batches, shared=shared):
            pieces = shared.value
            for batch in batches:
                texts = (t.as_py() for t in batch.column(text))
                yield batch.filter(pa.array([not (t and pieces.leaks(normalise(t))) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
