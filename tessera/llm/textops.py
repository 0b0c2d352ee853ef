"""Array kernels over whole Arrow batches of texts, used inside Spark tasks.

Texts are handled as UTF-8 bytes.  A batch is cut into pieces of bounded size
(never inside a text), and each piece is processed with a fixed number of
NumPy passes, so memory per task does not depend on the partition size.

Hashes are 64-bit polynomials over a fixed byte table, finished with an
avalanche step; equal byte strings always have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
PIECE_ROWS = 4096          # document index inside a piece fits 12 bits

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche finish of 64-bit values (wrapping arithmetic)."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_TABLE_LOWER = _TABLE[LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), _U)
    out[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        np.multiply(out[:m], _U(pow(base, k, 1 << 64)), out=out[k:k + m])
        k += m
    return out


class _Powers:
    """Powers of the base and of its inverse, grown on demand per worker."""

    up = np.empty(0, _U)
    down = np.empty(0, _U)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up = _powers(_BASE, n)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_null(arr.type):
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    if pa.types.is_string_view(arr.type) or pa.types.is_binary_view(arr.type):
        arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type)
                           or pa.types.is_large_binary(arr.type) else "")
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    kind = np.dtype(np.int64 if large else np.int32)
    _, offs, data = arr.buffers()
    if len(arr) == 0 or offs is None:
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    off = np.frombuffer(offs, kind, len(arr) + 1, arr.offset * kind.itemsize).astype(np.int64)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(batches, column: str = "text", limit: int = PIECE_BYTES,
           rows: int = PIECE_ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sub-batches with at most ``limit`` text bytes (or one longer text) and
    ``rows`` rows, each with its bytes and offsets."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at, n = 0, batch.num_rows
        while at < n:
            to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            to = min(max(to, at + 1), at + rows, n)
            yield batch.slice(at, to - at), data[off[at]:off[to]], off[at:to + 1] - off[at]
            at = to


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, doc)`` of the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    inside = ~WHITE[data]
    cut = np.zeros(n + 1, bool)          # a text starts here
    cut[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside
    last[:-1] &= ~last[1:] | cut[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    doc = np.searchsorted(off, start, "right") - 1
    return start, end, doc


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray,
              lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span (A-Z lowered if ``lower``)."""
    up, down = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((_TABLE_LOWER if lower else _TABLE)[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def window_hash(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-byte window (text ends are not respected)."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, _U)
    up, down = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_TABLE[data] * up[:len(data)], out=total[1:])
    return mix((total[width:] - total[:n]) * down[:n])


def prefix_hash(data: np.ndarray, second: bool = False) -> np.ndarray:
    """Prefix sums from which ``range_hash`` hashes any byte range."""
    up, _ = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    table = mix(_TABLE) if second else _TABLE
    np.cumsum(table[data] * up[:len(data)], out=total[1:])
    return total


def range_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of byte ranges from prefix sums; the length is hashed too."""
    _, down = _Powers.get(len(total))
    return mix((total[end] - total[start]) * down[start]
               + (end - start).astype(_U) * _U(0xD1342543DE82EF95))


def shingle_hash(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, doc)`` of every n-word shingle; a text with fewer words than
    ``n`` (but at least one) gives its whole word sequence as one shingle."""
    k = len(words)
    if k == 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    mult = [_U(pow(0x2545F4914F6CDD1D, i + 1, 1 << 64)) for i in range(n)]
    out_h, out_d = [], []
    if k >= n:
        h = np.zeros(k - n + 1, _U)
        for i in range(n):
            h += words[i:k - n + 1 + i] * mult[i]
        full = doc[:k - n + 1] == doc[n - 1:]
        out_h.append(h[full])
        out_d.append(doc[:k - n + 1][full])
    count = np.bincount(doc)
    first = np.zeros(len(count), np.int64)
    first[1:] = np.cumsum(count)[:-1]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            h = np.zeros(len(short), _U)
            for i in range(size):
                h += words[first[short] + i] * mult[i]
            out_h.append(h + _U(size))
            out_d.append(short)
    return mix(np.concatenate(out_h)), np.concatenate(out_d)


def doc_distinct(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(hash, doc)`` sorted by document then hash.  The document
    index takes the top 12 bits, the hash keeps its 52 high bits."""
    key = (doc.astype(_U) << _U(52)) | (hashes >> _U(12))
    key.sort()
    if len(key):
        keep = np.ones(len(key), bool)
        keep[1:] = key[1:] != key[:-1]
        key = key[keep]
    return key & _U((1 << 52) - 1), (key >> _U(52)).astype(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))
