"""Open-addressed interning of byte spans, one numpy table per batch.

Spans are hashed by XXH64 (vectorised by length; spans of 32 bytes and more go
through the ``xxhash`` library) and placed by linear probing, all spans of a
batch at once: in each round every pending span looks at its slot, free slots
are taken by one of those that look at them, spans whose slot is held by equal
bytes are done, and the others step on. Equal spans always look at the same
slot, so none is interned twice. A slot is shared only after its bytes have been
compared: different spans with equal hashes get slots of their own.
"""

from __future__ import annotations

import numpy as np
import xxhash

from loadcast.llm.textnp import LOWER

U = np.uint64
# The five primes of XXH64, and the rotations of its lanes.
P1, P2, P3, P4, P5 = (U(11400714785074694791), U(14029467366897019727), U(1609587929392839161),
                      U(9650029242287828579), U(2870177450012600261))
SHORT = 32  # XXH64 has a path of its own from this length on
PAD = 8


def _rotl(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U(by)) | (x >> U(64 - by))


def _lanes(buf: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian number that starts at each byte of a padded buffer."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(buf) - size + 1,), kind, buf, strides=(1,))


def compact(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words (in order, none in another) joined by one space each, A-Z
    lower-cased, zero-padded, and their starts and ends: a run of words is one span."""
    size = ends - starts
    to = np.cumsum(size + 1) - 1
    at = to - size
    out = np.full((int(to[-1]) + 1 if len(to) else 0) + PAD, 32, np.uint8)
    out[len(out) - PAD:] = 0
    inner = np.ones(len(out) - PAD, bool)
    inner[to] = False
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1
    words = buf[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    out[:len(inner)][inner] = LOWER[words] if lower else words
    return out, at, to


def xxh64(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of each span of a buffer padded by ``PAD`` bytes."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    eight, four = _lanes(buf, "<u8"), _lanes(buf, "<u4")
    kind = np.minimum(sizes, SHORT)
    order = np.argsort(kind.astype(np.int8), kind="stable")
    edges = np.searchsorted(kind[order], np.arange(SHORT + 2))
    for size in range(SHORT):
        rows = order[edges[size]:edges[size + 1]]
        if not len(rows):
            continue
        at = starts[rows]
        h = np.full(len(rows), P5 + U(size), np.uint64)
        done = 0
        while size - done >= 8:
            h ^= _rotl(eight[at + done] * P2, 31) * P1
            h = _rotl(h, 27) * P1 + P4
            done += 8
        if size - done >= 4:
            h ^= four[at + done].astype(np.uint64) * P1
            h = _rotl(h, 23) * P2 + P3
            done += 4
        while done < size:
            h ^= buf[at + done].astype(np.uint64) * P5
            h = _rotl(h, 11) * P1
            done += 1
        h ^= h >> U(33)
        h *= P2
        h ^= h >> U(29)
        h *= P3
        out[rows] = h ^ (h >> U(32))
    for i in order[edges[SHORT]:]:
        out[i] = xxhash.xxh64_intdigest(buf[starts[i]:starts[i] + sizes[i]])
    return out


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans of ``sizes`` bytes at ``a`` and at ``b`` are equal."""
    eight = _lanes(buf, "<u8")
    same = np.ones(len(a), bool)
    todo = np.arange(len(a))
    done = 0
    while len(todo):
        rest = sizes[todo] - done
        diff = eight[a[todo] + done] ^ eight[b[todo] + done]
        short = np.minimum(rest, 8)
        unequal = (diff << ((8 - short) * 8).astype(np.uint64)) != 0
        same[todo[unequal]] = False
        done += 8
        todo = todo[~unequal & (rest > 8)]
    return same


def intern(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray | None = None
           ) -> tuple[np.ndarray, np.ndarray]:
    """(owner, slot): the slot of every span, and the index of the span that owns
    each slot of the table (-1: free). Spans must not be empty."""
    n = len(starts)
    h = xxh64(buf, starts, sizes) if hashes is None else hashes
    size = 1 << max(int(2 * n - 1).bit_length(), 3)
    mask = size - 1
    owner = np.full(size, -1, np.int64)
    slot = (h & U(mask)).astype(np.int64)
    pending = np.arange(n)
    while len(pending):
        s = slot[pending]
        free = owner[s] < 0
        owner[s[free]] = pending[free]
        o = owner[s]
        done = (o == pending)
        like = np.flatnonzero(~done & (h[o] == h[pending]) & (sizes[o] == sizes[pending]))
        done[like] = same_bytes(buf, starts[o[like]], starts[pending[like]], sizes[pending[like]])
        pending = pending[~done]
        slot[pending] = (slot[pending] + 1) & mask
    return owner, slot
