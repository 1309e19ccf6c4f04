"""Token-ID output: ORC files of token ids in ascending document order, and their reader.

A row is one document: id, ``n_tokens`` and the token ids (an array of integers, stored with
ORC's integer run-length encoding). Documents are sorted by id over all files and within each,
so stripe and row-index statistics and the Bloom filter on the id let a reader skip stripes;
any number of tasks may read different stripes at once. Counts are columns of their own:
positions come from them without reading a token.

The tokenizer is the given vocabulary file (byte-level: pieces of letters, digits or marks, a
space starts a piece) in the tokenizers library. Texts are encoded in chunks that end where
such a vocabulary always splits, and a chunk's ids are kept for its next occurrence under
its 64-bit hash (among ten million chunks of one process, two clash with a chance of 3e-6).

Defined results: a null text is an empty one (the end id only); rows with one id stand
together in an order fixed by their texts; a null id comes first; an empty table is written
as an empty folder with the schema.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.arrays import hash_spans, slices

END = 2
SCHEMA = "id long, n_tokens int, ids array<int>, part int, pos int"
MOST_IDS = 12_000_000

_SOLID = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
_WORD = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)])
_MARK = _SOLID & ~_WORD


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text, and inside texts where a byte-level vocabulary always
    begins a piece - at a single space or line end between two visible characters, after
    such a line end, and at a mark after a letter or digit. Visible characters, letters and
    digits are those of ASCII, and À to ÿ but for × and ÷; next to others nothing is cut. A text with
    the beginning of a special string (``<|``) is one chunk."""
    n = len(data)
    begin = np.zeros(n + 1, bool)
    begin[offsets] = True
    if n > 2:
        before, now, after = data[:-2], data[1:-1], data[2:]
        lead = np.zeros(n, bool)  # second byte of a Latin letter: 0xC3 and a byte of 0x80-0xBF without the two signs
        lead[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        first = np.zeros(n, bool)
        first[:-1] = lead[1:]
        between = (_SOLID[before] | lead[:-2]) & (_SOLID[after] | first[2:])
        line = (now == 0x0A) & between
        begin[1:n - 1] |= ((now == 0x20) & between) | line | (_MARK[now] & (_WORD[before] | lead[:-2]))
        begin[2:n] |= line
    special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if n > 1 else ()
    for text in np.unique(np.searchsorted(offsets, special, "right") - 1):
        begin[offsets[text] + 1:offsets[text + 1]] = False
    return np.flatnonzero(begin[:n])


class Encoder:
    """Bytes of texts -> token ids, a slice of texts at a time. The ids of chunks met before
    are found by the chunk's 64-bit hash in sorted arrays; when more than ``MOST_IDS`` ids are
    held, all are dropped and collected anew."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.old = self.new = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.pool, self.held = np.zeros(1 << 16, np.int32), 0

    def whole(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        """Encode chunks and keep their ids; ``hashes`` rise and are not known yet."""
        ids = self.whole(chunks)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.int32, int(counts.sum()))
        while self.held + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.held:self.held + len(flat)] = flat
        at = self.held + np.cumsum(counts) - counts
        self.held += len(flat)
        self.new = self._merged(self.new, (hashes, at, counts))
        if len(self.new[0]) > 1 << 16:
            self.old = self._merged(self.old, self.new)
            self.new = tuple(x[:0] for x in self.new)

    @staticmethod
    def _merged(a, b):
        place = np.searchsorted(a[0], b[0])
        return tuple(np.insert(x, place, y) for x, y in zip(a, b))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, where the ids begin, how many) of each hash."""
        known, at, counts = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for h, where, n in (self.old, self.new):
            if len(h):
                i = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
                hit = h[i] == hashes
                known |= hit
                at[hit], counts[hit] = where[i[hit]], n[i[hit]]
        return known, at, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with ``end`` after each, where each text's ids begin and the last end)."""
        if self.held > MOST_IDS:
            self.clear()
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes, first, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        known, at, counts = self.find(hashes)
        if not known.all():
            missing = first[~known]
            self.learn(hashes[~known], [data[a:b].tobytes() for a, b in zip(starts[missing], ends[missing])])
            _, at, counts = self.find(hashes)
        n = counts[back]
        ids = self.pool[np.repeat(at[back] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        text = np.searchsorted(offsets, starts, "right") - 1
        by_text = np.bincount(text, weights=n, minlength=len(offsets) - 1).astype(np.int64) if len(n) else np.zeros(len(offsets) - 1, np.int64)
        bounds = np.concatenate([[0], np.cumsum(by_text + 1)])
        out = np.full(bounds[-1], end, np.int32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(by_text)), by_text)] = ids
        return out, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python process; later tasks go on with what it knows."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = END,
                 files: int | None = None, stripe_mb: int = 64) -> None:
    """Write ``docs`` to ``path``; ``files`` range partitions by id (default: shuffle partitions)."""
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    t = t.repartitionByRange(files, "id", F.xxhash64("text"), F.pmod(F.monotonically_increasing_id(), F.lit(64))) \
        .sortWithinPartitions("id", F.xxhash64("text"), "text")

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        own, part, pos = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                ids, bounds = own.encode(data, offsets, end)
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, n), pa.array(np.diff(bounds), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                     pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(pos, pos + n), pa.int32())],
                    names=["id", "n_tokens", "ids", "part", "pos"])
                pos += n

    t.mapInArrow(run, SCHEMA).write.option("orc.stripe.size", stripe_mb << 20).option("orc.create.index", "true") \
        .option("orc.row.index.stride", 1000).option("orc.bloom.filter.columns", "id").option("orc.bloom.filter.fpp", 0.01) \
        .option("orc.compress", "SNAPPY").orc(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows of a written folder; a range of ids is answered from the stripes whose
    statistics and Bloom filters allow it."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if first is not None:
        rows = rows.filter(F.col("id") >= first)
    return rows if last is None else rows.filter(F.col("id") <= last)


def with_start(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the number of ids of all documents before each. Parts are added up first
    (one row a file), documents only within their part."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = counts.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    offsets = sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, "part") \
        .withColumn("start", F.col("offset") + F.col("inside")).drop("offset", "inside", "part", "pos")


def digest(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            values, off = np.asarray(ids.values, "<i4"), np.asarray(ids.offsets)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
            keep = [batch.column(c) for c in ("id", "part", "pos")]
            yield pa.RecordBatch.from_arrays([*keep, batch.column("n_tokens").cast(pa.int64()), pa.array(crc, pa.int64())],
                                             names=["id", "part", "pos", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(run, "id long, part int, pos int, n_tokens long, ids_crc32 long")
    return with_start(rows, read_tokens(spark, path)).select(F.col("id").alias(id), "start", "n_tokens", "ids_crc32")
