"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

A document's set holds the distinct 5-word shingles of its text (A-Z lowered; fewer words:
the whole sequence as one shingle). Documents with equal sets are one class, known by the
set's signature. Every link between different classes with
100 * |intersection| >= 80 * |union| is decided; none is sampled or capped away:

1. Column blocks. The incidence matrix is cut by n-gram ranges. Each block counts in how many
   classes its n-grams occur; an n-gram of one class only cannot add to any overlap and is
   left out. N-grams above a fixed share of the whole (at most 1 / ``HEAVY`` of them can
   exist) are found beforehand and never gathered in one place.
2. Size-derived bounds. With the rarest n-grams first, two sets that link share one of the
   first n - ceil(0.8 n) + 1 n-grams of either; classes that share none are never compared.
3. Row blocks. Classes connected by such n-grams form a group. A group of up to ``BLOCK`` classes is
   one matrix product over their shared n-grams; a larger one is cut into blocks, with a
   product for each pair of blocks but those whose classes all link to the group's centre.
   Pairs below the bound are discarded and a spanning forest of the links is kept.

Signatures and n-grams are 64-bit hashes: a wrong link needs a clash of two of them.

Defined results: null, empty or blank texts have an empty set, no link and their own id;
a null id stays null unless its class has an id; rows with one id and different texts are
one node only if their texts link; an empty table gives an empty result.
"""

from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlens.llm.arrays import LOWER, hash_spans, mix, ngram_hashes, slices, word_spans
from stormlens.llm.components import connected_components
from stormlens.llm.storage import materialise

WORDS = 5
PERCENT = 80
BLOCK = 512
HEAVY = 1e-6
MIN_HEAVY = 64
POSTINGS_PER_BLOCK = 2_000_000
MIN_BLOCKS = 64
BATCH_ROWS = 1024
_NEVER = np.uint32(0xFFFFFFFF)


def shingle_sets(column, words: int = WORDS):
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    for _, data, offsets in slices(column):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        h = hash_spans(data, starts, ends)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= words:
                yield np.unique(ngram_hashes(h[a:b], words))
            elif b > a:
                yield mix(ngram_hashes(h[a:b], int(b - a)) + np.uint64(b - a))
            else:
                yield h[:0]


def small_batches(batches):
    """Batches of at most ``BATCH_ROWS`` rows, which bounds what a task holds at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(a, BATCH_ROWS)


def signature(s: np.ndarray) -> int:
    """A signed 64-bit number for a whole set; 0 for the empty one."""
    if not len(s):
        return 0
    x = mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.array([len(s)], np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return int(x.view(np.int64)[0]) or 1


def document_sets(docs: DataFrame, id: str, text: str, words: int = WORDS) -> DataFrame:
    """(id, n_shingles, sig, heavy): one row a document, and one row a task with id null, sig
    null and the n-grams that are frequent in that task with their counts."""
    def run(batches):
        total, n = {}, 0
        for batch in small_batches(batches):
            sets = list(shingle_sets(batch.column("text"), words))
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array([signature(s) for s in sets], pa.int64()),
                 pa.nulls(len(sets), pa.binary())], names=["id", "n_shingles", "sig", "heavy"])
            n += sum(sizes)
            if n:
                u, c = np.unique(np.concatenate(sets), return_counts=True)
                often = c >= 2  # what is missed stands at most once in each batch
                for k, v in zip(u[often].tolist(), c[often].tolist()):
                    total[k] = total.get(k, 0) + v
        if total:
            found = np.array(sorted(total.items()), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.array([n], pa.int64()), pa.nulls(1, pa.int64()), pa.array([found.tobytes()])],
                names=["id", "n_shingles", "sig", "heavy"])

    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, "id long, n_shingles long, sig long, heavy binary")


def heavy_ngrams(sets: DataFrame, total: int) -> np.ndarray:
    """The sorted n-grams that make up more than ``HEAVY`` of all; 1 / HEAVY of them at most
    (8 MB)."""
    def unpack(batches):
        for batch in batches:
            for x in batch.column(0):
                pairs = np.frombuffer(x.as_py(), np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, k].astype(np.int64)) for k in (0, 1)], names=["h", "c"])

    counts = sets.filter("heavy is not null").select("heavy").mapInArrow(unpack, "h long, c long")
    found = counts.groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= max(MIN_HEAVY, HEAVY * total))
    return np.sort(found.select("h").toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))


def column_blocks(docs: DataFrame, text: str, heavy: np.ndarray, blocks: int, words: int = WORDS) -> DataFrame:
    """(part, sig, n, doc, h): the incidence matrix in compact rows, one for each batch of
    documents and each n-gram range. Heavy n-grams go by their document instead of their value."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        often = shared.value
        for batch in small_batches(batches):
            known = {}
            for s in shingle_sets(batch.column(0), words):
                if len(s):
                    known.setdefault(signature(s), s)
            if not known:
                continue
            sigs = np.fromiter(known, np.int64, len(known))
            sets = list(known.values())
            sizes = np.array([len(s) for s in sets], np.uint32)
            h, doc = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
            part = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)
            if len(often):
                at = np.minimum(np.searchsorted(often, h), len(often) - 1)
                hot = often[at] == h
                part[hot] = blocks + (mix(sigs.view(np.uint64))[doc[hot]] % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            h, doc, part = h[order], doc[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            rows = {"part": [], "sig": [], "n": [], "doc": [], "h": []}
            for a, b in zip(cuts, np.r_[cuts[1:], len(part)]):
                used, at = np.unique(doc[a:b], return_inverse=True)
                rows["part"].append(int(part[a]))
                rows["sig"].append(sigs[used].tobytes())
                rows["n"].append(sizes[used].tobytes())
                rows["doc"].append(at.astype(np.uint32).tobytes() if len(used) > 65535 else at.astype(np.uint16).tobytes())
                rows["h"].append(h[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32())] + [pa.array(rows[k], pa.binary()) for k in ("sig", "n", "doc", "h")],
                                             names=list(rows))

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "part int, sig binary, n binary, doc binary, h binary")


def _shared_columns(blocks: int):
    """For one block of columns: its n-grams of two classes or more, dealt by class."""
    def run(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["h"]])
        sig, n = [], []
        for r in pdf.itertuples():
            own = np.frombuffer(r.sig, np.int64)
            doc = np.frombuffer(r.doc, np.uint32 if len(own) > 65535 else np.uint16)
            sig.append(own[doc])
            n.append(np.frombuffer(r.n, np.uint32)[doc])
        sig, n = np.concatenate(sig), np.concatenate(n)
        order = np.argsort(h)
        h, sig, n = h[order], sig[order], n[order]
        if part < blocks:
            same = h[1:] == h[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            h, sig, n = h[keep], sig[keep], n[keep]
        order = np.lexsort((sig, h))
        h, sig, n = h[order], sig[order], n[order]
        if len(h):
            keep = np.r_[True, (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])]
            h, sig, n = h[keep], sig[keep], n[keep]
        if part < blocks:
            _, at, c = np.unique(h, return_inverse=True, return_counts=True)
            keep = c[at] >= 2
            h, sig, n, df = h[keep], sig[keep], n[keep], c[at][keep].astype(np.uint32)
        else:
            df = np.full(len(h), _NEVER)
        q = (mix(sig.view(np.uint64)) % np.uint64(blocks)).astype(np.int32)
        order = np.argsort(q, kind="stable")
        rows = []
        for k in np.unique(q):
            a, b = np.searchsorted(q[order], [k, k + 1])
            i = order[a:b]
            rows.append((int(k), sig[i].tobytes(), n[i].tobytes(), h[i].tobytes(), df[i].tobytes()))
        return pd.DataFrame(rows, columns=["q", "sig", "n", "h", "df"])

    return run


def _candidates(percent: int):
    """For one share of the classes: their shared n-grams, and the prefix by rising frequency."""
    def run(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        cat = lambda k, t: np.concatenate([np.frombuffer(x, t) for x in pdf[k]])
        sig, n, h, df = cat("sig", np.int64), cat("n", np.uint32).astype(np.int64), cat("h", np.uint64), cat("df", np.uint32)
        order = np.lexsort((h, df, sig))
        sig, n, h = sig[order], n[order], h[order]
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
        rows = []
        for a, b in zip(first, np.r_[first[1:], len(sig)]):
            size = int(n[a])
            prefix = size - (percent * size + 99) // 100 + 1 - (size - (b - a))  # the n-grams of one class come first
            if prefix > 0:
                rows.append((int(sig[a]), size, h[a:b].tobytes(), h[a:a + prefix].view(np.int64).tolist()))
        return pd.DataFrame(rows, columns=["sig", "n", "shared", "prefix"])

    return run


def overlap_edges(sig: np.ndarray, n: np.ndarray, sets: list[np.ndarray], percent: int, wide: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the links among some classes: the product of their incidence
    matrix with its transpose, ``wide`` columns at a time."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] >= 2
    _, column = np.unique(column[keep], return_inverse=True)
    doc = doc[keep]
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        i, j = np.searchsorted(column, [a, a + wide])
        x = np.zeros((len(sets), min(wide, int(column[j - 1]) - a + 1)), np.float32)
        x[doc[i:j], column[i:j] - a] = 1
        overlap += x @ x.T
    links = 100 * overlap.astype(np.int64)
    links = links >= percent * (n[:, None] + n[None, :] - overlap.astype(np.int64))
    left, edges = np.ones(len(sets), bool), []
    for i in range(len(sets)):
        if left[i]:
            group, new = np.zeros(len(sets), bool), np.zeros(len(sets), bool)
            new[i] = True
            while new.any():
                group |= new
                new = links[new].any(axis=0) & ~group
            left &= ~group
            members = sig[group]
            if len(members) > 1:
                edges += [(int(m), int(members.min())) for m in members if m != members.min()]
    return edges


def _products(percent: int):
    def run(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, g in pdf.groupby(["root", "lo", "hi"], sort=False):
            edges += overlap_edges(g["sig"].to_numpy(np.int64), g["n"].to_numpy(np.int64),
                                   [np.frombuffer(x, np.uint64) for x in g["shared"]], percent)
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")

    return run


def large_groups(members: DataFrame, block: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For groups of more than ``block`` classes: (links to the group's centre, the pairs of
    blocks that are still to be multiplied). The centre is the class with the largest share of
    n-grams in common with others, for near copies their original. Classes that link to it
    are one component, so they needn't be compared with each other, only with the rest."""
    centre = members.groupBy("root").agg(F.max_by(
        F.struct("sig", "n", "shared"), F.struct(F.octet_length("shared") / F.col("n"), F.col("sig"))).alias("c"))

    def judge(batches):
        for batch in batches:
            linked = []
            for x, y, m, n in zip(*(batch.column(c) for c in ("shared", "c_shared", "n", "c_n"))):
                both = len(np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True))
                linked.append(100 * both >= percent * (m.as_py() + n.as_py() - both))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("sig", "n", "shared", "root", "c_sig")] + [pa.array(linked, pa.bool_())],
                                             names=["sig", "n", "shared", "root", "c_sig", "linked"])

    judged = materialise(members.join(centre, "root").select(
        "sig", "n", "shared", "root", F.col("c.sig").alias("c_sig"), F.col("c.n").alias("c_n"), F.col("c.shared").alias("c_shared"))
        .mapInArrow(judge, "sig long, n long, shared binary, root long, c_sig long, linked boolean"), "judged")
    counts = judged.groupBy("root").agg(F.ceil(F.count_if("linked") / block).cast("int").alias("nl"),
                                        F.ceil(F.count_if(~F.col("linked")) / block).cast("int").alias("nr"))
    at = F.when(F.col("linked"), F.pmod(F.xxhash64("sig"), F.col("nl"))).otherwise(F.col("nl") + F.pmod(F.xxhash64("sig"), F.col("nr")))
    every, rest = F.sequence(F.lit(0), F.col("nl") + F.col("nr") - 1), F.sequence(F.col("nl"), F.col("nl") + F.col("nr") - 1)
    others = F.when(~F.col("linked"), every).when(F.col("nr") > 0, rest)
    pairs = judged.join(counts, "root").withColumns({"at": at.cast("int"), "other": F.explode(others)}) \
        .select("sig", "n", "shared", "root", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi"))
    return judged.filter("linked and sig <> c_sig").select(F.col("sig").alias("a"), F.col("c_sig").alias("b")), pairs


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS,
                       percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``."""
    sets = materialise(document_sets(docs, id, text, words), "sets")
    own = sets.filter("heavy is null").drop("heavy")
    total = own.agg(F.sum("n_shingles")).first()[0] or 0
    heavy = heavy_ngrams(sets, total)
    blocks = max(MIN_BLOCKS, -(-total // POSTINGS_PER_BLOCK))

    shared = column_blocks(docs, text, heavy, blocks, words).groupBy("part") \
        .applyInPandas(_shared_columns(blocks), "q int, sig binary, n binary, h binary, df binary")
    candidates = materialise(shared.groupBy("q").applyInPandas(
        _candidates(percent), "sig long, n long, shared binary, prefix array<long>"), "candidates")

    postings = candidates.select("sig", F.explode("prefix").alias("h"))
    lead = postings.groupBy("h").agg(F.min("sig").alias("lead"), F.count("*").alias("m")).filter("m > 1")
    groups = materialise(connected_components(postings.join(lead, "h").filter("sig <> lead").select("sig", "lead").distinct()), "groups")
    sizes = groups.groupBy("root").agg(F.count("*").alias("members"))
    members = candidates.select("sig", "n", "shared").join(groups.join(sizes, "root").withColumnRenamed("node", "sig"), "sig")
    small = members.filter(F.col("members") <= block).select("sig", "n", "shared", "root", F.lit(0).alias("lo"), F.lit(0).alias("hi")) \
        .withColumn("bin", F.pmod(F.xxhash64("root"), F.lit(blocks * 4)))  # small groups share a task call
    links = small.groupBy("bin").applyInPandas(_products(percent), "a long, b long")
    if (sizes.agg(F.max("members")).first()[0] or 0) > block:
        stars, pairs = large_groups(members.filter(F.col("members") > block), block, percent)
        pairs = pairs.withColumn("bin", F.xxhash64("root", "lo", "hi"))  # each pair of blocks has its own
        links = links.union(stars).union(pairs.groupBy("bin").applyInPandas(_products(percent), "a long, b long"))
    linked = connected_components(links)

    classes = own.filter("n_shingles > 0").groupBy("sig").agg(F.min("id").alias("least"))
    named = classes.join(linked.withColumnRenamed("node", "sig"), "sig", "left") \
        .withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    component = named.join(least, "root").select("sig", "component_id")
    return own.join(component, "sig", "left").select(
        F.col("id").alias(id), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
