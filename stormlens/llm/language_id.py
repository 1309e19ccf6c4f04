"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased text (what isn't a letter is a space) are hashed into ``2**bits`` buckets; a
document's vector is term frequency (share of its n-grams) times inverse document
frequency. Document frequencies cover all training documents. Weights are fitted with
follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on a bounded,
hash-chosen sample of distinct rows (``sample_rows`` over all languages, evenly by language),
one fifth of which only sets the temperature of the softmax.

Defined results: a text that is null or has no letter is ``und`` with score 0; no training
row gives ``und`` for every text; languages are whatever non-null values the training rows
hold; ties go to the language first in code point order; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.arrays import with_columns
from stormlens.llm.storage import materialise

BITS = 16
ORDERS = 3
SAMPLE_ROWS = 2000
STEPS = 24_000
SCALE = 30.0
ALPHA, BETA, L1, L2 = 0.5, 0.1, 0.05, 1e-4
UNKNOWN = "und"
_PIECE = 1 << 20
#: Code points below 0x250 that are no letters count as spaces, and so do the blocks of general and CJK punctuation.
_BLANK = np.array([not chr(c).isalpha() for c in range(0x250)])


def _letters(cp: np.ndarray) -> np.ndarray:
    low = np.minimum(cp, 0x24F)
    other = (cp >= 0x2000) & (cp < 0x2070) | (cp >= 0x3000) & (cp < 0x3040)
    return np.where(_BLANK[low] & (cp < 0x250) | other, np.uint32(32), cp)


def _grams(text: str, bits: int):
    """Bucket arrays of all n-grams of a text, digits and marks as spaces, piece by piece
    (pieces overlap by the order)."""
    text = text.lower()
    for a in range(0, max(len(text), 1), _PIECE):
        cp = np.frombuffer(text[a:a + _PIECE + ORDERS - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        cp = _letters(cp)
        own = min(_PIECE, len(text) - a)
        h = np.zeros(len(cp), np.uint32)
        for n in range(1, ORDERS + 1):
            m = len(cp) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) + cp[n - 1:] + np.uint32(n)
            x = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield ((x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits))[:own]


def vector(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of the text's n-grams) without the inverse document frequency."""
    total = np.zeros(1 << bits, np.int64)
    for g in _grams(text, bits):
        total += np.bincount(g, minlength=1 << bits)
    seen = np.flatnonzero(total)
    return seen, total[seen] / max(1, total.sum())


def document_frequencies(texts: DataFrame, bits: int = BITS) -> DataFrame:
    """(bucket, n) over all texts of a one-column frame; bucket -1 counts the texts."""
    def count(batches):
        df, n, mark = np.zeros(1 << bits, np.int64), 0, np.zeros(1 << bits, bool)
        for batch in batches:
            for text in batch.column(0):
                n += 1
                mark[:] = False
                for g in _grams(text.as_py() or "", bits):
                    mark[g] = True
                df += mark
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], n))], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, classes: int, size: int, epochs: int,
             alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights (size x classes) of a softmax by follow-the-regularised-leader; many are 0."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(epochs):
        for (i, x), y in zip(rows, marks):
            w = weights(i)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(slice(None))


def temperature(scores: np.ndarray, marks: np.ndarray) -> float:
    """The softmax temperature of least log loss (golden section on its logarithm)."""
    if not len(scores):
        return 1.0

    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), marks]))

    a, b, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class LanguageModel:
    """Languages, inverse document frequencies folded into weights, and the temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, heat: float, bits: int):
        self.languages, self.weights, self.heat, self.bits = languages, weights, heat, bits

    def probabilities(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for g in _grams(text, self.bits):
            total += self.weights[g].sum(axis=0, dtype=np.float64)
            n += len(g)
        s = total / max(1, n) / self.heat
        p = np.exp(s - s.max())
        return p / p.sum()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", bits: int = BITS,
          sample_rows: int = SAMPLE_ROWS, steps: int = STEPS) -> LanguageModel | None:
    """Fit on ``docs`` (the training documents). The sample is ``sample_rows`` / languages distinct
    rows of each language, the first in the order of a hash of id, language and text, so it is the same in every
    run and copies of a row count once; it is gone over as often as ``steps`` updates need."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    distinct = materialise(docs.select("id", "lang", F.xxhash64("text").alias("hash")).distinct(), "language-rows")
    counts = {r["lang"]: r["count"] for r in distinct.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return None
    languages = sorted(counts)
    idf = np.zeros(1 << bits)
    found = document_frequencies(docs.select("text"), bits).toArrow()  # 2**bits + 1 rows at most
    seen, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    idf[seen[seen >= 0]] = SCALE * (np.log((1 + n[seen < 0].sum()) / (1 + n[seen >= 0])) + 1)

    each = -(-sample_rows // len(counts))
    share = F.lit(0.0)
    for name, n in counts.items():  # about twice as many as wanted and 100 more, of which the first are taken
        share = F.when(F.col("lang") == name, F.lit((2 * each + 100) / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("id", "lang", "hash"), F.lit(1 << 40))
    first = F.row_number().over(W.partitionBy("lang").orderBy("draw", "id", "hash")) <= each
    chosen = distinct.withColumn("draw", draw).filter(F.col("draw") < share * float(1 << 40)).withColumn("first", first).filter("first") \
        .select(F.col("id").alias("__id"), F.col("lang").alias("__lang"), "hash")
    picked = docs.withColumn("text_hash", F.xxhash64("text")) \
        .join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("__id")) & (F.col("lang") == F.col("__lang")) & (F.col("text_hash") == F.col("hash"))) \
        .dropDuplicates(["id", "lang", "text_hash"])  # at most ``each`` rows a language

    def vectors(batches):
        for batch in batches:
            found = [vector(t.as_py(), bits) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("id").cast(pa.string()),
                 pa.array([i.astype("<u4").tobytes() for i, _ in found], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())], names=["lang", "id", "i", "x"])

    sample = picked.select("lang", "id", "text").mapInArrow(vectors, "lang string, id string, i binary, x binary").toArrow()
    number = {name: k for k, name in enumerate(languages)}
    sample = sample.combine_chunks()
    ids, names = sample.column("id").to_pylist(), sample.column("lang").to_pylist()
    # all vectors stay in two arrays; a row is a view of its part
    buckets, bounds = _joined(sample.column("i"), "<u4")
    values = _joined(sample.column("x"), "<f4")[0] * idf.astype(np.float32)[buckets]
    del sample
    parts = [slice(p, q) for p, q in zip(bounds[:-1], bounds[1:])]
    order = sorted(range(len(ids)), key=lambda k: (hash_order(ids[k]), ids[k] or "", names[k], buckets[parts[k]].tobytes()))
    vecs = [(buckets[parts[k]], values[parts[k]]) for k in order]
    marks = np.array([number[names[k]] for k in order], np.int64)
    cut = len(vecs) // 5
    w = fit_ftrl(vecs[cut:], marks[cut:], len(languages), 1 << bits, -(-steps // max(1, len(vecs) - cut)))
    heat = temperature(np.array([x @ w[i] for i, x in vecs[:cut]]).reshape(cut, len(languages)), marks[:cut])
    del vecs, parts, buckets, values
    pa.default_memory_pool().release_unused()
    w *= idf[:, None]
    return LanguageModel(languages, w.astype(np.float32), heat, bits)


def _joined(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of a binary column, where each row's begin and the last one's end)."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), kind), (offsets - offsets[0]) // 4


def hash_order(id: str | None) -> int:
    """A fixed shuffling of the sample, so that neighbours in it are unrelated."""
    import zlib

    return zlib.crc32(b"order:" + (id or "").encode())


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` (all columns) with lang_pred and score."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))

    def run(batches):
        m = shared.value
        for batch in batches:
            names, scores = [], []
            for t, known in zip(batch.column(text), batch.column("__letters")):
                if not known.as_py():
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = m.probabilities(t.as_py())
                best = int(p.argmax())
                names.append(m.languages[best])
                scores.append(float(p[best]))
            yield with_columns(batch, ("__letters",), lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.withColumn("__letters", letters).mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(id: str = "doc_id", mod: int = 4, rest: int = 2) -> Column:
    """Documents whose crc32 of the id as text leaves ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % mod == rest, F.lit(False))


def language_id(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", bits: int = BITS,
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the documents that aren't held out, predict all."""
    marked = docs.withColumn("held_out", held_out(id))
    return predict(marked, train(marked.filter(~F.col("held_out")), text, lang, id, bits, sample_rows), text)
