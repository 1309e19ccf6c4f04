"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a document: its distinct words hashed into ``2**bits`` buckets (each worth 1 / their
number), and structure statistics and the length (metadata) as one active bin each.
With weights w and low-rank vectors v the machine adds to the linear part all pairwise
interactions in linear time: 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). It is fitted by
AdaGrad on logistic loss over a bounded, hash-chosen sample of labelled documents
(``sample_rows``; the sample's ids, bounded too, are what is broadcast to find the texts).

Defined results: null and empty texts have no words and the lowest bins, and get a score as any
other text; labels that are null are left out, repeated labels of an id count once by the
largest mark; without both marks in the sample every score is the share of mark 1 (0.5 if
there is no label); repeated rows are scored alike.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlens.llm.arrays import hash_spans, mix, slices, with_columns, word_spans
from stormlens.llm.quality_rules import text_counts

BITS = 15
FACTORS = 8
SAMPLE_ROWS = 6000
EPOCHS = 4
RATE = 0.1
PENALTY = 1e-5
BINS = 16
STATISTICS = 9

_UPPER, _POINT = (np.zeros(256, bool) for _ in range(2))
_UPPER[65:91] = True
_POINT[[ord(c) for c in ".,;:!?'\"()-"]] = True


def size(bits: int) -> int:
    return (1 << bits) + STATISTICS * BINS


def features(column, bits: int):
    """(bucket numbers, values) of each text of an Arrow column."""
    for _, data, offsets in slices(column):
        starts, ends, first = word_spans(data, offsets)
        words = hash_spans(data, starts, ends)
        found = text_counts(data, offsets, starts, ends, first, words)
        bucket = (mix(words + np.uint64(7)) >> np.uint64(64 - bits)).astype(np.int64)
        length = np.diff(offsets)
        lines = np.array([1 + np.count_nonzero(data[a:b] == 10) for a, b in zip(offsets[:-1], offsets[1:])])
        n, chars = np.maximum(found["n_words"], 1), np.maximum(length, 1)
        share = lambda mask: np.array([np.count_nonzero(mask[data[a:b]]) for a, b in zip(offsets[:-1], offsets[1:])]) / chars
        ratio = lambda x: np.minimum(BINS - 1, np.rint((BINS - 1) * np.sqrt(np.minimum(x, 1)))).astype(np.int64)
        scale = lambda x: np.minimum(BINS - 1, np.log2(x + 1)).astype(np.int64)
        distinct = [np.unique(bucket[a:b]) for a, b in zip(first[:-1], first[1:])]
        stats = np.stack([
            scale(length), scale(found["n_words"]), scale(found["n_words"] / lines * 8),
            np.minimum(BINS - 1, found["word_chars"] / n).astype(np.int64), ratio(found["n_symbols"] / chars * 4),
            ratio(found["n_repeat_words"] / n), ratio(share(_UPPER)), ratio(share(_POINT) * 4),
            ratio(np.array([len(d) for d in distinct]) / n)], axis=1) + (1 << bits) + np.arange(STATISTICS) * BINS
        for d, s in zip(distinct, stats):
            yield np.concatenate([d, s]), np.concatenate([np.full(len(d), 1 / max(1, len(d)) ** 0.5), np.full(STATISTICS, 1.0)])


class Machine:
    """bias, w (size) and v (size x factors)."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray, bits: int):
        self.bias, self.w, self.v, self.bits = bias, w, v, bits

    def margin(self, i: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[i] * x[:, None]
        s = vx.sum(axis=0)
        return float(self.bias + self.w[i] @ x + 0.5 * (s @ s - (vx * vx).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, bits: int, factors: int = FACTORS, epochs: int = EPOCHS,
        rate: float = RATE, penalty: float = PENALTY, seed: int = 0) -> Machine:
    """AdaGrad, one document at a time, in the given order."""
    share = float(marks.mean()) if len(marks) else 0.5
    n = size(bits)
    if share in (0.0, 1.0) or not len(marks):
        return Machine(float(np.log((share * len(marks) + 0.5) / ((1 - share) * len(marks) + 0.5))), np.zeros(n), np.zeros((n, factors)), bits)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(n), np.random.default_rng(seed).normal(0, 0.05, (n, factors)), bits)
    gw, gv = np.full(n, 1e-2), np.full((n, factors), 1e-2)
    for _ in range(epochs):
        for (i, x), y in zip(rows, marks):
            v = m.v[i]
            vx = v * x[:, None]
            s = vx.sum(axis=0)
            z = m.bias + m.w[i] @ x + 0.5 * (s @ s - (vx * vx).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            dw = g * x + penalty * m.w[i]
            dv = g * (x[:, None] * s - vx * x[:, None]) + penalty * v
            gw[i] += dw * dw
            gv[i] += dv * dv
            m.w[i] -= rate * dw / np.sqrt(gw[i])
            m.v[i] -= rate * dv / np.sqrt(gv[i])
            m.bias -= 0.01 * g
    return m


def held_out(id: str = "doc_id", mod: int = 3, rest: int = 1) -> Column:
    """Documents whose crc32 of the id as text leaves ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % mod == rest, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", bits: int = BITS,
          sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` of ``labels`` (already without held-out ids)."""
    marks = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).alias("mark"))
    share = sample_rows / max(1, marks.count())
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    chosen = marks.filter(draw < 0.95 * share * (1 << 30)).orderBy(draw, "id").limit(sample_rows) if share < 1 else marks

    def run(batches):
        for batch in batches:
            found = list(features(batch.column("text"), bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("mark").cast(pa.int64()),
                 pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())], names=["id", "mark", "i", "x"])

    texts = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "id") \
        .groupBy("id", "mark").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # of an id with many rows, one
    sample = texts.mapInArrow(run, "id string, mark long, i binary, x binary").toArrow().to_pylist()  # bounded by sample_rows
    sample.sort(key=lambda r: (zlib.crc32(b"order:" + r["id"].encode()), r["id"], r["i"]))
    rows = [(np.frombuffer(r["i"], "<i4"), np.frombuffer(r["x"], "<f4")) for r in sample]
    return fit(rows, np.array([min(1, max(0, r["mark"])) for r in sample], np.float64), bits)


def predict(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` without the text, with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = shared.value
        for batch in batches:
            z = np.array([m.margin(i, x) for i, x in features(batch.column("__text"), m.bits)])
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield with_columns(batch, ("__text",), score=pa.array(score, pa.float64()), predicted=pa.array((score >= 0.5).astype(np.int32)))

    others = [c for c in docs.columns if c not in (text, "score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + "score double, predicted int")


def quality_classifier(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
                       bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the labels that aren't held out, score all documents."""
    known = labels.filter(~held_out(id))
    return predict(docs.withColumn("held_out", held_out(id)), train(docs, known, id, text, label, bits, sample_rows), text)
