"""Vectorised work on Arrow text columns: words, lines and their 64-bit hashes.

Texts are handled as UTF-8 bytes of a whole batch. A word is a run of bytes other than
the ASCII white space 0x20 and 0x09-0x0D, so its hash does not depend on where it stands.
Hash equality stands for text equality (64 bits after mixing; within one document or one
pair of documents a clash has a chance below 1e-12).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        p = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        p[0] = 1
        _powers[kind] = np.cumprod(p, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column, limit: int = SLICE_BYTES):
    """Cut a text column into (first row, bytes, offsets) of about ``limit`` bytes each; a
    longer text stands alone."""
    data, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """A 64-bit hash of each span data[start:end]; spans in order, without overlap."""
    out, a, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + limit, "right")))
        first, last = int(starts[a]), int(ends[b - 1])
        total = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, last - first), out=total[1:])
        s, e = starts[a:b] - first, ends[a:b] - first
        out[a:b] = mix((total[e] - total[s]) * _power("down", _INVERSE, last - first + 1)[s])
        a = b
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words of all texts, and by text the number of its first."""
    inside = ~WHITE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # first bytes of texts that aren't empty
    begins[edge] = inside[edge]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of the \\n-split lines of all texts."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    return starts, np.sort(ends), text


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n neighbouring word hashes (runs over text borders included)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1]
    for j in range(1, n):
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + words[j: len(words) - n + 1 + j])
    return h


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...], **new) -> pa.RecordBatch:
    """The batch without ``drop``, with further Arrow arrays."""
    keep = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + list(new.values()), names=keep + list(new))
