"""Vectorised byte-level helpers for Arrow string columns.

Text stays in the Arrow buffer: words, shingles and rolling hashes are computed
on one uint8 array per slice of a batch, never string by string. Words are the
runs of bytes other than space and 0x09-0x0D; as these are ASCII, byte runs and
character runs are the same in UTF-8.

Every function takes empty input; null strings count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
# Word separators: space and the bytes 0x09 to 0x0D.
SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# ASCII lower-casing of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.RandomState(20240229)
_BYTE = _rng.randint(1, 2**63 - 1, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE_LOWER = _BYTE[LOWER]
_P = 0x9E3779B97F4A7C15 | 1
_LOW = 11  # powers are products of two small tables


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` up to 2^_LOW - 1, and of base^(2^_LOW) as far as ``n``."""
    out = []
    for b, m in ((base, 1 << _LOW), (pow(base, 1 << _LOW, 2**64), (n >> _LOW) + 1)):
        x = np.full(m, b, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


_INVERSE = pow(_P, -1, 2**64)


def _powers(n: int) -> np.ndarray:
    """P^0 to P^(n-1); made anew, as a kept table would stay in every worker."""
    low, high = _tables(_P, n)
    return (high[:, None] * low[None, :]).reshape(-1)[:n]


def _inverse_powers(at: np.ndarray, n: int) -> np.ndarray:
    low, high = _tables(_INVERSE, n)
    return high[at >> _LOW] * low[at & ((1 << _LOW) - 1)]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(uint8 bytes, int64 offsets of length n + 1) of a string column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches, column: str, max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into row runs of about ``max_bytes`` of text (a single
    longer text stays whole) and give (rows, bytes, offsets) for each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        buf, off = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), buf[off[at]:off[to]], off[at:to + 1] - off[at]
            at = to


def words(buf: np.ndarray, off: np.ndarray, separators: np.ndarray = SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word, in order; words never cross rows."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    sep = separators[buf]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = sep[:-1]
    edges = off[(off > 0) & (off < n)]
    first[edges] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = sep[1:]
    last[edges - 1] = True
    starts = np.flatnonzero(first & ~sep)
    ends = np.flatnonzero(last & ~sep) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every byte span; equal bytes give equal hashes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(buf)
    s = np.empty(n + 1, np.uint64)
    s[0] = 0
    terms = _powers(n)
    terms *= (_BYTE_LOWER if lower else _BYTE)[buf]
    np.cumsum(terms, dtype=np.uint64, out=s[1:])
    return mix((s[ends] - s[starts]) * _inverse_powers(starts, n + 1) + (ends - starts).astype(np.uint64))


_STEP = U(0xA24BAED4963EE407)


def shingles(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``k`` words within a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _STEP + h[j:j + n]
    inside = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(out[inside] + U(k)), inside


def whole_hashes(h: np.ndarray, row_start: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each given row (short rows only)."""
    out = np.zeros(len(rows), np.uint64)
    for i, r in enumerate(rows):
        x = U(0)
        with np.errstate(over="ignore"):
            seq = h[row_start[r]:row_start[r + 1]]
            for v in seq:
                x = x * _STEP + v
        out[i] = mix(np.array([x + U(len(seq))], np.uint64))[0]
    return out


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles per row as (row, hash), sorted by both. A row
    with 1 to k-1 words has its whole sequence as one; without words, none."""
    s, e, row = words(buf, off)
    h = span_hashes(buf, s, e)
    n_rows = len(off) - 1
    sh, at = shingles(h, row, k)
    srow = row[at]
    row_start = np.searchsorted(row, np.arange(n_rows + 1))
    n_words = np.diff(row_start)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        sh = np.concatenate([sh, whole_hashes(h, row_start, short)])
        srow = np.concatenate([srow, short])
    order = np.lexsort((sh, srow))
    sh, srow = sh[order], srow[order]
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (srow[1:] != srow[:-1])
    return srow[keep], sh[keep]


def byte_grams(buf: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` bytes (over row borders too)."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level, size, out, done = _BYTE[buf], 1, None, 0
    while True:
        if k & size:
            part = level[done:done + n]
            out = part if out is None else (out ^ (out >> U(31))) * _STEP + part
            done += size
        if size * 2 > k:
            out = (out ^ (out >> U(32))) * U(0xD6E8FEB86659FD93)
            return out ^ (out >> U(29))
        level = (level[:-size] ^ (level[:-size] >> U(29))) * U(_P) + level[size:]
        size *= 2


def window_fold(h: np.ndarray, w: int, fold=np.minimum) -> np.ndarray:
    """Minimum (or another idempotent fold) of every run of ``w`` values."""
    if len(h) < w:
        return h[:0]
    size = 1
    n = len(h) - w + 1
    while size * 2 <= w:
        h = fold(h[:-size], h[size:])
        size *= 2
    return fold(h[:n], h[w - size:w - size + n]) if size < w else h[:n]


def distinct_words(buf: np.ndarray, off: np.ndarray, lower: bool = False
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of one occurrence of every distinct word of a slice, and for
    every (row, word) pair: row, index of the distinct word, count."""
    s, e, row = words(buf, off)
    h = span_hashes(buf, s, e, lower=lower)
    u, first, inv = np.unique(h, return_index=True, return_inverse=True)
    pair = row * max(len(u), 1) + inv
    p, n = np.unique(pair, return_counts=True)
    return s[first], e[first], p // max(len(u), 1), p % max(len(u), 1), n


def spelled(buf: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, each between two spaces, and the word of each byte."""
    ln = e - s + 2
    at = np.concatenate([[0], np.cumsum(ln)])
    word = np.repeat(np.arange(len(s)), ln)
    pos = np.arange(at[-1]) - at[word]
    inner = (pos > 0) & (pos < ln[word] - 1)
    out = np.full(at[-1], 32, np.uint8)
    out[inner] = buf[(s[word] + pos - 1)[inner]]
    return (LOWER[out] if lower else out), word


def grams(data: np.ndarray, word: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of every byte after the first of a word, and the byte with its
    longest context (at most ``order`` bytes, within the word), packed as
    depth * 2^56 + bytes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
    depth = np.minimum(np.arange(n) - start[word], order)
    key = np.zeros(n, np.int64)
    for j in range(order, -1, -1):
        key <<= 8
        key[j:] |= data[:n - j]
    i = np.flatnonzero(depth > 0)
    d = depth[i]
    mask = (np.int64(1) << (8 * (np.arange(order + 1) + 1))) - 1
    return i, (key[i] & mask[d]) | (d << 56)
