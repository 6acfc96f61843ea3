"""Language-model scoring: causal self-attention over subword ids, in numpy.

A text is the sequence of its lower-cased words and an end; each word, with a
space before it, is cut into the subword ids of a given public vocabulary. The
probability of an id is that of its class times that of the id within the class:

* the class comes from a causal self-attention layer with relative position
  biases over the ids before. A text is cut into blocks of ``BLOCK`` inputs, and
  each block attends to itself and to the block before it, under a causal mask:
  windows overlap by half, and every token is scored once, in its own block, with
  at least ``BLOCK`` inputs of context where the text has them. Blocks of many
  texts are one batch of masked attention;
* the shares within classes are corpus counts over all training texts.

Classes are clusters of ids by their neighbours, counted over all training texts.
Attention weights are learned from all training texts too, by Adam in the tasks:
each text belongs to one round, by a hash, and within it to one share of about
``SHARE_TOKENS`` ids. Every share goes on from the weights of the round before,
and its own count towards the next by the tokens that it has (sums of whole
numbers, so that their order does not matter). The first round is one share, which
is gone over until ``steps`` steps are made; all later ones are gone over once.

A text is cut into subword ids once; ids are stored for all passes.

The base is a word unigram with add-one smoothing. Word counts stay distributed:
the ``head_words`` most frequent go to the tasks as two arrays (16 bytes each);
the other words of a text are joined to their counts by hash, and sums per text
combine before they are shuffled.

Nulls and odd input: a null text is an empty text, which has its end as its only
token; texts are never cut short; rows that repeat an id are scored one by one;
without training texts all counts are 0 and the model is uniform; a null doc_id
counts as '' for the fold. Only the text enters a score.
"""

from __future__ import annotations

import base64
import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import prepare, slot, stored, table
from loadcast.llm.textnp import LOWER, mix, slices, span_hashes, text_buffer, words

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the vocabulary file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 16
WIDTH = 16
HEAD = 8
CLASSES = 128
INPUTS = 4096
NEIGHBOURS = 64
STEPS = 800
STEP_BLOCKS = 256
RATE = 1e-2
WARM_UP = 30
SHARE_TOKENS = 1_000_000
ROUND_SHARE = 0.2  # no round has more of the texts than this
FIXED = 1 << 20  # weights are added up as whole numbers of this fraction
HASHES = 1 << 30
HEAD_WORDS = 300_000
FLUSH_WORDS = 1_000_000
CHUNK = 64
END_WORD = np.uint64(0x1F83D9ABFB41BD6B)  # stands for the end among word hashes
ROW_TOKENS = 100_000
BATCH_BYTES = 8 << 20
COUNT_BYTES = 4 << 20  # large slices cut fewer words twice into subwords
IDS_BYTES = 1 << 20
SUM_BYTES = 512 << 10
RUN_BYTES = 512 << 10
WORD_RUN = 16_384  # words that are written out at once
KNOWN_IDS = 2_000_000
COUNT_LIMIT = 1 << 30  # neighbours that a task counts in 32 bits before it sends them


# ---------------------------------------------------------------- subword ids

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path) as f:
        return {base64.b64decode(a): int(b) for a, b in map(str.split, f)}


class Subwords:
    """Subword ids of words; the id after the last is the end."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken
        self.encoding = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.starts = np.zeros(self.size, bool)
        for piece, i in ranks.items():
            self.starts[i] = piece[:1] == b" "

    def encode(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, offsets by word)."""
        # the words one after the other, a space before each
        size = e - s + 1
        total = np.concatenate([[0], np.cumsum(size)])
        raw = np.empty(total[-1], np.uint8)
        for x in range(0, len(s), WORD_RUN):
            y = min(x + WORD_RUN, len(s))
            at = np.arange(total[x], total[y])
            raw[total[x]:total[y]] = LOWER[buf[np.repeat(s[x:y] - 1 - total[x:y], size[x:y]) + at]]
        raw[total[:-1]] = 32
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        text = raw.tobytes().decode("utf-8", "replace")
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        at = np.flatnonzero(self.starts[ids])
        if len(at) != len(s):  # a word with white space of its own
            parts = [self.encoding.encode_ordinary(" " + w) for w in text[1:].split(" ")]
            ids = np.array([i for p in parts for i in p], np.int64)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1]
        return ids, np.concatenate([at, [len(ids)]])


class KnownWords:
    """Subword ids of the words that a task has met, by their hashes: a word is cut
    once for all slices. Above ``KNOWN_IDS`` ids it begins anew."""

    def __init__(self, subwords: Subwords):
        self.subwords = subwords
        self.forget()

    def forget(self):
        self.h, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begin = self.size = np.zeros(0, np.int64)

    def cut(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first id among ``ids``, number of ids) of distinct words, whose
        hashes ``h`` ascend."""
        if len(self.ids) > KNOWN_IDS:
            self.forget()
        new = np.ones(len(h), bool)
        if len(self.h):
            new = self.h[np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)] != h
        if new.any():
            ids, at = self.subwords.encode(buf, s[new], e[new])
            both = np.concatenate([self.h, h[new]])
            order = np.argsort(both, kind="stable")
            self.begin = np.concatenate([self.begin, at[:-1] + len(self.ids)])[order]
            self.size = np.concatenate([self.size, np.diff(at)])[order]
            self.h, self.ids = both[order], np.concatenate([self.ids, ids.astype(np.int32)])
        at = np.searchsorted(self.h, h)
        return self.begin[at], self.size[at]


def hashed_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, hash) of every word, in order. Runs of rows are hashed one
    by one: the arrays on the way take many times the bytes of the text."""
    none, at = np.zeros(0, np.int64), 0
    parts = [(none, none, none, none.astype(np.uint64))]
    while at < len(off) - 1:
        to = max(int(np.searchsorted(off, off[at] + RUN_BYTES, side="right")) - 1, at + 1)
        run = buf[off[at]:off[to]]
        s, e, row = words(run, off[at:to + 1] - off[at])
        parts.append((s + off[at], e + off[at], row + at, span_hashes(run, s, e)))
        at = to
    s, e, row, h = (np.concatenate(x) for x in zip(*parts))
    return s, e, row, h


def id_rows(buf: np.ndarray, off: np.ndarray, subwords: Subwords, known: KnownWords | None = None
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all rows, offsets by row), without ends; hashes of the distinct words;
    number of the distinct word, and the row, of every word."""
    s, e, row, h = hashed_words(buf, off)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    first, inv = order[new], np.empty(len(h), np.int64)
    inv[order] = np.cumsum(new) - 1
    u, known = h[first], known or KnownWords(subwords)
    begin, each = known.cut(buf, s[first], e[first], u)
    size = each[inv]
    total = np.concatenate([[0], np.cumsum(size)])
    out = known.ids[np.repeat(begin[inv] - total[:-1], size) + np.arange(total[-1])]
    return out, total[np.searchsorted(row, np.arange(len(off)))], u, inv, row


def id_type(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


def id_bytes(ids: np.ndarray, off: np.ndarray, size: int) -> pa.Array:
    """One binary value a row."""
    kind = id_type(size)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * np.dtype(kind).itemsize).astype(np.int32)),
                                                             pa.py_buffer(ids.astype(kind))])


def bytes_ids(buf: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, offsets by row) of :func:`id_bytes`."""
    kind = id_type(size)
    return buf.view(kind).astype(np.int64), off // np.dtype(kind).itemsize


# ------------------------------------------------------------------ attention

def layout(ids: np.ndarray, off: np.ndarray, end: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all rows: inputs (block, BLOCK) with a padding block before each
    row, targets of the same shape (-1: none), number of each row's padding
    block, and the indices of the blocks that are scored."""
    n = np.diff(off) + 1  # an end per row
    blocks = -(-n // BLOCK) + 1
    first = np.concatenate([[0], np.cumsum(blocks)])
    inputs = np.full(first[-1] * BLOCK, pad, np.int64)
    targets = np.full(first[-1] * BLOCK, -1, np.int64)
    row = np.repeat(np.arange(len(n)), n - 1)
    at = (first[:-1][row] + 1) * BLOCK + np.arange(len(ids)) - off[row]
    targets[at] = ids
    inputs[at + 1] = ids
    inputs[(first[:-1] + 1) * BLOCK] = end
    targets[(first[:-1] + 1) * BLOCK + n - 1] = end
    scored = np.ones(first[-1], bool)
    scored[first[:-1]] = False
    return inputs.reshape(-1, BLOCK), targets.reshape(-1, BLOCK), first[:-1], np.flatnonzero(scored)


_q, _k = np.arange(BLOCK)[:, None] + BLOCK, np.arange(2 * BLOCK)[None, :]
DISTANCE = np.maximum(_q - _k, 0)
CAUSAL = np.where(_k <= _q, 0.0, -1e9).astype(np.float32)


class Attention:
    """One causal self-attention layer with a direct path, to class logits."""

    NAMES = ("emb", "wq", "wk", "wv", "rel", "wa", "wx", "b")

    def __init__(self, units: int, classes: int, seed: int = 5, dtype=np.float32):
        r = np.random.RandomState(seed)
        g = lambda *s: (r.randn(*s) * (s[0] ** -0.5)).astype(dtype)
        self.pad = units
        self.emb = (r.randn(units + 1, WIDTH) * 0.3).astype(dtype)
        self.wq, self.wk, self.wv = g(WIDTH, HEAD), g(WIDTH, HEAD), g(WIDTH, WIDTH)
        self.rel = np.zeros(2 * BLOCK, dtype)
        self.wa, self.wx, self.b = g(WIDTH, classes), g(WIDTH, classes), np.zeros(classes, dtype)

    def flat(self) -> np.ndarray:
        """All weights, one after the other."""
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def copy(self, flat: np.ndarray | None = None) -> Attention:
        """The same layer with weights of its own, or with the given ones."""
        out, at = copy.copy(self), 0
        for k in self.NAMES:
            w = getattr(self, k)
            setattr(out, k, w.copy() if flat is None else flat[at:at + w.size].reshape(w.shape).astype(w.dtype))
            at += w.size
        return out

    def forward(self, keys: np.ndarray) -> dict:
        """``keys`` are the units of (block before, block)."""
        t = {"x": self.emb[keys]}
        t["xq"] = t["x"][:, BLOCK:]
        t["q"], t["k"], t["v"] = t["xq"] @ self.wq, t["x"] @ self.wk, t["x"] @ self.wv
        mask = CAUSAL + np.where(keys == self.pad, np.float32(-1e9), np.float32(0))[:, None, :]
        s = t["q"] @ t["k"].transpose(0, 2, 1) * np.float32(HEAD ** -0.5) + self.rel[DISTANCE] + mask
        s = np.exp(s - s.max(axis=2, keepdims=True))
        t["a"] = s / s.sum(axis=2, keepdims=True)
        t["z"] = t["a"] @ t["v"]
        t["logits"] = t["z"] @ self.wa + t["xq"] @ self.wx + self.b
        return t

    def gradients(self, keys: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean loss over targets that are not -1, and its gradients."""
        t = self.forward(keys)
        z = t["logits"] - t["logits"].max(axis=2, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=2, keepdims=True)
        ok = target >= 0
        n = max(int(ok.sum()), 1)
        i, j = np.nonzero(ok)
        loss = -float(np.log(np.maximum(p[i, j, target[i, j]], 1e-30)).sum()) / n
        d = np.where(ok[:, :, None], p, 0)
        d[i, j, target[i, j]] -= 1
        d /= n
        flat = lambda m: m.reshape(-1, m.shape[-1])
        g = {"wa": flat(t["z"]).T @ flat(d), "wx": flat(t["xq"]).T @ flat(d), "b": flat(d).sum(axis=0)}
        dz, dxq = d @ self.wa.T, d @ self.wx.T
        da, dv = dz @ t["v"].transpose(0, 2, 1), t["a"].transpose(0, 2, 1) @ dz
        ds = t["a"] * (da - (da * t["a"]).sum(axis=2, keepdims=True))
        g["rel"] = np.bincount(DISTANCE.ravel(), ds.sum(axis=0).ravel(), minlength=2 * BLOCK).astype(self.rel.dtype)
        ds = ds * np.float32(HEAD ** -0.5)
        dq, dk = ds @ t["k"], ds.transpose(0, 2, 1) @ t["q"]
        g["wq"], g["wk"], g["wv"] = flat(t["xq"]).T @ flat(dq), flat(t["x"]).T @ flat(dk), flat(t["x"]).T @ flat(dv)
        dx = dk @ self.wk.T + dv @ self.wv.T
        dx[:, BLOCK:] += dxq + dq @ self.wq.T
        g["emb"] = np.zeros_like(self.emb)
        np.add.at(g["emb"], keys.ravel(), flat(dx))
        g["emb"][self.pad] = 0
        return loss, g

    def chain_gradients(self, units: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """As :meth:`gradients` over the blocks after the first of ``units``, each
        with the one before it: what two blocks share is computed once."""
        n, scale = len(target), np.float32(HEAD ** -0.5)
        x = self.emb[units]
        flat = lambda m: m.reshape(-1, m.shape[-1])
        times = lambda m, w: (flat(m) @ w).reshape(*m.shape[:-1], w.shape[1])

        def pairs(m):  # (block before, block) as one view of the rows
            return np.lib.stride_tricks.as_strided(m, (n, 2 * BLOCK, m.shape[2]), m.strides)

        def halves(d):  # sum over both places of a block
            out = np.zeros((n + 1, BLOCK, d.shape[2]), d.dtype)
            out[:-1] += d[:, :BLOCK]
            out[1:] += d[:, BLOCK:]
            return out

        xq = x[1:]
        q, k, v = times(xq, self.wq) * scale, pairs(times(x, self.wk)), pairs(times(x, self.wv))
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += self.rel[DISTANCE] + CAUSAL
        pad = np.where(units == self.pad, np.float32(-1e9), np.float32(0))
        a += np.concatenate([pad[:-1], pad[1:]], axis=1)[:, None, :]
        a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(axis=2, keepdims=True)
        zx = np.concatenate([flat(np.matmul(a, v)), flat(xq)], axis=1)
        w = np.concatenate([self.wa, self.wx])
        p = zx @ w
        p += self.b
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        t = target.ravel()
        i = np.flatnonzero(t >= 0)
        m = max(len(i), 1)
        loss = -float(np.log(np.maximum(p[i, t[i]], 1e-30)).sum()) / m
        p[i, t[i]] -= 1
        if len(i) < len(t):
            p[t < 0] = 0
        # the mean over targets, where the arrays are small
        gw, dzx = zx.T @ p / p.dtype.type(m), p @ w.T / p.dtype.type(m)
        g = {"wa": gw[:WIDTH], "wx": gw[WIDTH:], "b": np.ones(len(p), p.dtype) @ p / p.dtype.type(m)}
        dz, dxq = dzx[:, :WIDTH].reshape(n, BLOCK, WIDTH), dzx[:, WIDTH:].reshape(n, BLOCK, WIDTH)
        ds = np.matmul(dz, v.transpose(0, 2, 1))
        ds -= (ds * a).sum(axis=2, keepdims=True)
        ds *= a
        g["rel"] = np.bincount(DISTANCE.ravel(), ds.sum(axis=0).ravel(), minlength=2 * BLOCK).astype(self.rel.dtype)
        dq = np.matmul(ds, k) * scale
        dk, dv = halves(np.matmul(ds.transpose(0, 2, 1), q)), halves(np.matmul(a.transpose(0, 2, 1), dz))
        g["wq"], g["wk"], g["wv"] = flat(xq).T @ flat(dq), flat(x).T @ flat(dk), flat(x).T @ flat(dv)
        dx = times(dk, self.wk.T) + times(dv, self.wv.T)
        dx[1:] += dxq + times(dq, self.wq.T)
        order = np.argsort(units.astype(np.uint16) if self.pad < 1 << 16 else units, axis=None, kind="stable")
        u = units.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        g["emb"] = np.zeros_like(self.emb)
        g["emb"][u[first]] = np.add.reduceat(flat(dx)[order], first, axis=0)
        g["emb"][self.pad] = 0
        return loss, g

    def fit(self, inputs: np.ndarray, targets: np.ndarray, blocks: np.ndarray, steps: int, batch: int = 128,
            rate: float = RATE, seed: int = 7) -> list[float]:
        r, losses, adam = np.random.RandomState(seed), [], Adam(self)
        for step in range(1, steps + 1):
            pick = blocks[r.randint(0, len(blocks), batch)]
            loss, g = self.gradients(np.concatenate([inputs[pick - 1], inputs[pick]], axis=1), targets[pick])
            losses.append(loss)
            adam.step(g, rate * (1 - 0.95 * step / steps))
        return losses

    def fit_chain(self, inputs: np.ndarray, targets: np.ndarray, rate: tuple[float, float], steps: int = 0,
                  batch: int = STEP_BLOCKS) -> list[float]:
        """Go over all blocks after the first in order, once or until ``steps`` steps
        are made; the rate goes from the first to the second value."""
        once = -(-(len(inputs) - 1) // batch)
        total = once * max(1, -(-steps // max(once, 1)))
        adam, losses = Adam(self), []
        for step in range(total):
            x = step % once * batch
            y = min(x + batch, len(inputs) - 1)
            loss, g = self.chain_gradients(inputs[x:y + 1], targets[x + 1:y + 1])
            losses.append(loss)
            adam.step(g, rate[0] + (rate[1] - rate[0]) * step / total)
        return losses


class Adam:
    def __init__(self, net: Attention):
        self.net, self.steps = net, 0
        self.m = {k: np.zeros_like(getattr(net, k)) for k in net.NAMES}
        self.v = {k: np.zeros_like(getattr(net, k)) for k in net.NAMES}

    def step(self, g: dict, rate: float):
        self.steps += 1
        rate *= min(1.0, self.steps / WARM_UP)
        for k in self.net.NAMES:
            m, v, w = self.m[k], self.v[k], getattr(self.net, k)
            m *= m.dtype.type(0.9)
            m += m.dtype.type(0.1) * g[k]
            v *= v.dtype.type(0.99)
            v += v.dtype.type(0.01) * g[k] * g[k]
            size = np.sqrt(v)
            size *= v.dtype.type((1 - 0.99 ** self.steps) ** -0.5)
            size += v.dtype.type(1e-8)
            w -= m * m.dtype.type(rate / (1 - 0.9 ** self.steps)) / size


class Model:
    """Attention over units, classes of ids, and shares within classes."""

    def __init__(self, unit: np.ndarray, cls: np.ndarray, share: np.ndarray, net: Attention, end: int):
        self.unit, self.cls, self.end, self.net = unit, cls, end, net
        self.log_share = np.log(share).astype(np.float32)
        # per unit: query, key, value with a one beside it, and the direct logits;
        # the padding's value and one are 0, so it has no weight
        e = net.emb
        self.q, self.k = e @ net.wq * np.float32(HEAD ** -0.5), e @ net.wk
        self.v = np.concatenate([e @ net.wv, np.ones((len(e), 1), e.dtype)], axis=1)
        self.v[net.pad] = 0
        self.direct = e @ net.wx + net.b
        # bounds of all attention scores and logits: within them exp needs no shift
        norm = lambda m: np.linalg.norm(m, axis=1).max()
        self.tame = (norm(self.q) * norm(self.k) + np.abs(net.rel).max() < 60
                     and np.abs(self.direct).max() + np.abs(self.v[:, :WIDTH] @ net.wa).max() < 60)

    def score(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        """log10 probability of every row, each token scored once."""
        out, at = np.zeros(len(off) - 1), 0
        while at < len(out):
            to = max(int(np.searchsorted(off, off[at] + ROW_TOKENS, side="right")) - 1, at + 1)
            out[at:to] = self._score(ids[off[at]:off[to]], off[at:to + 1] - off[at])
            at = to
        return out / np.log(10)

    def _score(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        inputs, targets, first, _ = layout(ids, off, self.end, -1)
        units = np.where(inputs >= 0, self.unit[inputs], self.net.pad)
        valid = targets >= 0
        cls = self.cls[np.maximum(targets, 0)]
        own = np.where(valid, self.log_share[np.maximum(targets, 0)], 0).sum(axis=1, dtype=np.float64)
        per_block = np.zeros(len(inputs))

        def pairs(m):  # (block before, block) as one view of the rows
            return np.lib.stride_tricks.as_strided(m, (len(m) - 1, 2 * BLOCK, m.shape[2]), m.strides)

        k, v = pairs(self.k[units]), pairs(self.v[units])
        bias = self.net.rel[DISTANCE] + CAUSAL
        ones = np.ones(self.net.wa.shape[1], np.float32)
        for x in range(1, len(inputs), CHUNK):
            y = min(x + CHUNK, len(inputs))
            u = units[x:y]
            s = np.matmul(self.q[u], k[x - 1:y - 1].transpose(0, 2, 1))
            s += bias
            if not self.tame:
                s -= s.max(axis=2, keepdims=True)
            np.exp(s, out=s)
            z = np.matmul(s, v[x - 1:y - 1]).reshape(-1, WIDTH + 1)
            logits = (z[:, :WIDTH] / (z[:, WIDTH:] + np.float32(1e-30))) @ self.net.wa
            logits += self.direct[u.ravel()]
            if not self.tame:
                logits -= logits.max(axis=1, keepdims=True)
            goal = logits[np.arange(len(logits)), cls[x:y].ravel()]
            np.exp(logits, out=logits)
            got = (goal - np.log(logits @ ones)).reshape(-1, BLOCK)
            per_block[x:y] = np.where(valid[x:y], got, 0).sum(axis=1, dtype=np.float64)
        return np.add.reduceat(per_block + own, first)


def columns_of(count: np.ndarray) -> np.ndarray:
    """Number of every id among the ``NEIGHBOURS`` - 1 most frequent ones; the others
    have the last."""
    by_count = np.argsort(-count, kind="stable")[:NEIGHBOURS - 1]
    top = np.full(len(count), NEIGHBOURS - 1)
    top[by_count] = np.arange(len(by_count))
    return top


def add_neighbours(ids: np.ndarray, off: np.ndarray, top: np.ndarray, out: np.ndarray):
    """Add to ``out`` (by id, next and previous neighbour) those of all rows, an end
    before and after each."""
    end = len(top) - 1
    seq = np.concatenate([[end], np.insert(ids, off[1:], end)])
    here, there = seq[:-1], seq[1:]
    one = out.dtype.type(1)  # of another type it would be converted at every place
    np.add.at(out, here * (2 * NEIGHBOURS) + top[there], one)
    np.add.at(out, there * (2 * NEIGHBOURS) + NEIGHBOURS + top[here], one)


def cluster(count: np.ndarray, neighbours: np.ndarray, classes: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Class of every id, by which frequent ids stand before and after it; the
    most frequent ids have classes of their own, unseen ids share the last."""
    seen = np.flatnonzero(count)
    alone = min(classes // 2, len(seen))
    by_count = seen[np.argsort(-count[seen], kind="stable")]
    cls = np.full(len(count), classes - 1)
    cls[by_count[:alone]] = np.arange(alone)
    rest, k = by_count[alone:], classes - 1 - alone
    if not len(rest) or k < 1:
        return cls
    x = np.sqrt(neighbours.reshape(-1, 2 * NEIGHBOURS)[rest].astype(np.float32))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    r = np.random.RandomState(seed)
    weighted = x * count[rest].astype(np.float32)[:, None]
    centre = x[:k].copy() if len(rest) >= k else x.copy()
    for _ in range(rounds):
        near = (x @ centre.T).argmax(axis=1)
        sums = (near == np.arange(len(centre))[:, None]).astype(np.float32) @ weighted
        empty = ~sums.any(axis=1)
        sums[empty] = x[r.randint(0, len(x), int(empty.sum()))]
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    cls[rest] = alone + near
    return cls


def outline(counts: np.ndarray, neighbours: np.ndarray, classes: int = CLASSES, inputs: int = INPUTS
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, Attention]:
    """(unit, class and share of every id, weights before learning) from full counts."""
    size = len(counts)
    cls = cluster(counts, neighbours, classes)
    order = np.argsort(-counts, kind="stable")
    unit = cls + min(inputs, size)  # an id that is not frequent enters as its class
    unit[order[:inputs]] = np.arange(min(inputs, size))
    net = Attention(min(inputs, size) + classes, classes)
    used = np.bincount(cls, minlength=classes)
    total = np.bincount(cls, counts, minlength=classes)
    share = (counts + 1.0) / (total + used)[cls]
    net.b[:] = np.log((total + 1.0) / (total.sum() + classes)).astype(np.float32)
    return unit, cls, share, net


def build(ids: np.ndarray, off: np.ndarray, counts: np.ndarray, end: int, steps: int = STEPS, classes: int = CLASSES,
          inputs: int = INPUTS) -> Model:
    """The model of texts that fit one process."""
    neighbours = np.zeros((end + 1) * 2 * NEIGHBOURS, np.int64)
    add_neighbours(ids, off, columns_of(counts), neighbours)
    unit, cls, share, net = outline(counts, neighbours, classes, inputs)
    if len(off) > 1:
        x, t, _, blocks = layout(ids, off, end, -1)
        net.fit(np.where(x >= 0, unit[x], net.pad), np.where(t >= 0, cls[t], -1), blocks, steps)
    return Model(unit, cls, share, net, end)


# ---------------------------------------------------------------------- Spark

def subword_table(rows: DataFrame, ranks, size: int) -> DataFrame:
    """One pass over the texts: (doc_id, base_key, learn, n_tokens, ids) of every row
    of (doc_id, base_key, learn, text), and, with null ids, rows of (word, n): counts of
    word hashes, the end among them, over the rows to learn from. A task adds up its
    own counts first."""
    schema = "doc_id long, base_key long, learn boolean, n_tokens long, ids binary, word long, n long"
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        subwords = Subwords(ranks.value)
        known = KnownWords(subwords)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pending = rows = 0

        def record(size, /, **have):
            return pa.RecordBatch.from_arrays([have[c] if c in have else pa.nulls(size, t) for c, t in zip(names, kinds)], names)

        def flush():
            u, inv = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(inv, np.concatenate([h[1] for h in held])).astype(np.int64)
            return record(len(u), word=pa.array(u.view(np.int64)), n=pa.array(n))

        for batch, buf, off in slices(batches, "text", COUNT_BYTES):
            ids, at, u, inv, row = id_rows(buf, off, subwords, known)
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            yield record(batch.num_rows, doc_id=batch.column("doc_id"), base_key=batch.column("base_key"), learn=batch.column("learn"),
                         n_tokens=pa.array(np.bincount(row, minlength=batch.num_rows) + 1), ids=id_bytes(ids, at, size))
            n = np.bincount(inv, learn[row], minlength=len(u)).astype(np.int64)
            rows += int(learn.sum())
            held.append((u[n > 0], n[n > 0]))
            pending += len(u)
            if pending > FLUSH_WORDS:
                yield flush()
                held, pending = [], 0
        held.append((np.array([END_WORD]), np.array([rows])))
        yield flush()

    return rows.select("doc_id", "base_key", "learn", "text").mapInArrow(run, schema)


def added(parts: DataFrame, length: int, keys: int) -> np.ndarray:
    """Sums by key of (key, values: 64-bit whole numbers as bytes), at most ``length``
    to a key, one after the other. Values are added up in tasks."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("key").to_pylist(), batch.column("values")):
                v = np.frombuffer(v.as_buffer(), np.int64)
                sums[k] = sums[k] + v if k in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                             ["key", "values"])

    out = np.zeros((keys, length), np.int64)
    for r in parts.repartition("key").mapInArrow(run, "key long, values binary").toPandas().itertuples():
        v = np.frombuffer(r.values, np.int64)
        out[r.key, :len(v)] = v
    return out.reshape(-1)


def in_parts(values: np.ndarray, length: int):
    """Rows for :func:`added`, without those that are 0 throughout."""
    for k, at in enumerate(range(0, len(values), length)):
        v = values[at:at + length]
        if v.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([v.astype(np.int64).tobytes()], pa.binary())], ["key", "values"])


def count_ids(train: DataFrame, size: int) -> np.ndarray:
    """Counts of all ids, the end among them."""
    def run(batches):
        n = np.zeros(size, np.int64)
        for batch, buf, off in slices(batches, "ids", IDS_BYTES):
            ids, _ = bytes_ids(buf, off, size)
            n += np.bincount(ids, minlength=size)
            n[size - 1] += batch.num_rows
        yield from in_parts(n, size)

    return added(train.select("ids").mapInArrow(run, "key long, values binary"), size, 1)


def count_neighbours(train: DataFrame, counts: np.ndarray) -> np.ndarray:
    """Neighbours of all ids, as :func:`add_neighbours` has them."""
    spark, size = train.sparkSession, len(counts)
    columns = spark.sparkContext.broadcast(columns_of(counts))
    length = SUM_BYTES // 8

    def run(batches):
        n, pending = np.zeros(size * 2 * NEIGHBOURS, np.int32), 0
        for _, buf, off in slices(batches, "ids", IDS_BYTES):
            ids, at = bytes_ids(buf, off, size)
            if pending + len(ids) + len(at) > COUNT_LIMIT:
                yield from in_parts(n, length)
                n[:], pending = 0, 0
            pending += len(ids) + len(at)
            add_neighbours(ids, at, columns.value, n)
        yield from in_parts(n, length)

    keys = -(-size * 2 * NEIGHBOURS // length)
    return added(train.select("ids").mapInArrow(run, "key long, values binary"), length, keys)[:size * 2 * NEIGHBOURS]


def rounds_of(tokens: int) -> list[tuple[float, float, int]]:
    """(from, to, shares): each round has as much of the texts as all before it, the
    first one share, none more than ``ROUND_SHARE`` (of several)."""
    edges = [0.0, min(1.0, SHARE_TOKENS / max(tokens, 1))]
    while edges[-1] < 1:
        edges.append(min(edges[-1] + min(edges[-1], ROUND_SHARE), 1.0))
    return [(a, b, max(1, round((b - a) * tokens / SHARE_TOKENS))) for a, b in zip(edges, edges[1:])]


def learn(train: DataFrame, unit: np.ndarray, cls: np.ndarray, net: Attention, tokens: int, steps: int) -> Attention:
    """Weights after all rounds over (doc_id, ids) of all rows of ``train``."""
    spark, size = train.sparkSession, len(unit)
    place = F.xxhash64("doc_id", "ids")
    rows = train.select("ids", place.alias("place"), F.pmod(place, F.lit(HASHES)).alias("turn"))
    of_ids = spark.sparkContext.broadcast((unit, cls))
    for first, last, shares in rounds_of(tokens):
        start = spark.sparkContext.broadcast(net)
        rate = (RATE * (1 - 0.95 * first), RATE * (1 - 0.95 * last))
        least = steps if first == 0 else 0

        def run(batches, start=start, rate=rate, least=least):
            unit, cls = of_ids.value

            def fitted(ids, sizes):
                net = start.value.copy()
                off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                x, t, _, _ = layout(np.concatenate(ids).astype(np.int64), off, size - 1, -1)
                t = np.where(t >= 0, cls[t], -1)
                net.fit_chain(np.where(x >= 0, unit[x], net.pad), t, rate, least)
                n = int((t >= 0).sum())
                yield from in_parts(np.concatenate([np.rint(net.flat().astype(np.float64) * FIXED).astype(np.int64) * n, [n]]), SUM_BYTES // 8)

            now, ids, sizes = None, [], []
            for batch in batches:
                share = np.asarray(batch.column("share"))
                buf, off = text_buffer(batch.column("ids"))
                every, off = buf.view(id_type(size)), off // np.dtype(id_type(size)).itemsize
                for s in np.unique(share):  # in order
                    mine = np.flatnonzero(share == s)
                    if now is not None and s != now:
                        yield from fitted(ids, sizes)
                        ids, sizes = [], []
                    now = s
                    ids.append(every[off[mine[0]]:off[mine[-1] + 1]].copy())
                    sizes.append(np.diff(off[mine[0]:mine[-1] + 2]))
            if now is not None:
                yield from fitted(ids, sizes)

        here = rows.filter((F.col("turn") >= round(first * HASHES)) & (F.col("turn") < round(last * HASHES)))
        here = here.withColumn("share", F.pmod(F.xxhash64("place"), F.lit(shares)).cast("int"))
        # a share's rows come in the order of their hashes, however they were dealt before
        parts = here.repartitionById(shares, "share").sortWithinPartitions("share", "place").select("share", "ids")
        length, n = SUM_BYTES // 8, net.flat().size + 1
        sums = added(parts.mapInArrow(run, "key long, values binary"), length, -(-n // length))[:n]
        if sums[-1]:
            net = net.copy(sums[:-1] / (FIXED * float(sums[-1])))
        start.unpersist()
    return net


class Places:
    """Places of hashes in an ascending array, from where their leading bits begin."""

    def __init__(self, words: np.ndarray):
        bits = max(4 * len(words), 2).bit_length()
        self.words, self.shift = words, np.uint64(64 - bits)
        count = np.bincount((words >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = (np.cumsum(count) - count).astype(np.int32)

    def of(self, h: np.ndarray) -> np.ndarray:
        """As ``searchsorted``, the last place for what lies above all."""
        last = max(len(self.words) - 1, 0)
        at = np.minimum(self.first[(h >> self.shift).astype(np.int64)], last).astype(np.int64)
        if len(self.words):
            below = np.flatnonzero(self.words[at] < h)
            while len(below):
                below = below[at[below] < last]
                at[below] += 1
                below = below[self.words[at[below]] < h[below]]
        return at


def base_scores(docs: DataFrame, counts: DataFrame, n_all: int, n_types: int, head_words: int = HEAD_WORDS) -> DataFrame:
    """(base_key, known, gain): per text, tokens with a count and the sum of
    log10(count + 1)."""
    spark = docs.sparkSession
    level = counts.groupBy(F.least("n", F.lit(100_000)).alias("level")).count().toPandas().sort_values("level", ascending=False)
    fits = level[level["count"].cumsum() <= head_words]["level"]
    least = int(fits.min()) if len(fits) else 100_001
    top = counts.filter(F.col("n") >= least).orderBy("word").toPandas()
    order = np.argsort(top["word"].to_numpy().view(np.uint64))
    head = spark.sparkContext.broadcast((top["word"].to_numpy().view(np.uint64)[order], top["n"].to_numpy()[order]))

    def run(batches):
        word, n = head.value
        log, places = np.log10(n + 1.0), Places(word)
        for batch, buf, off in slices(batches, "text", COUNT_BYTES):
            key = np.asarray(batch.column("base_key"))
            _, _, row, h = hashed_words(buf, off)
            rows = len(off) - 1
            h = np.concatenate([h, np.full(rows, END_WORD)])
            row = np.concatenate([row, np.arange(rows)])
            at = places.of(h)
            hit = word[at] == h if len(word) else np.zeros(len(h), bool)
            known = np.bincount(row[hit], minlength=rows)
            gain = np.bincount(row[hit], log[at[hit]], minlength=rows)
            # of the rest, one row per text and word
            r, w = row[~hit], h[~hit]
            o = np.lexsort((w, r))
            r, w = r[o], w[o]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.concatenate([first, [len(r)]]))
            # a row of a text's own sums has a hash that spreads it, and no count
            own = mix(key.view(np.uint64) + np.uint64(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own, w[first]]).view(np.int64)), pa.array(np.concatenate([key, key[r[first]]])),
                 pa.array(np.concatenate([np.zeros(rows, np.int64), times])), pa.array(np.concatenate([known, np.zeros(len(first), np.int64)])),
                 pa.array(np.concatenate([gain, np.zeros(len(first))]))], ["word", "base_key", "times", "known", "gain"])

    rows = docs.select("base_key", "text").mapInArrow(run, "word long, base_key long, times long, known long, gain double")
    # equal rows of the input have equal keys and sums: one of them stays
    rows = rows.repartition("word").groupBy("word", "base_key", F.expr("times > 0").alias("open")).agg(
        F.max("times").alias("times"), F.max("known").alias("known"), F.max("gain").alias("gain"))
    c = counts.filter(F.col("n") < least).select(F.col("word").alias("count_word"), F.col("n").alias("c"))
    j = rows.join(c, (rows["word"] == c["count_word"]) & F.col("open"), "left")
    return j.groupBy("base_key").agg(
        F.sum(F.col("known") + F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("gain") + F.coalesce(F.col("times") * F.log10(F.col("c") + 1.0), F.lit(0.0))).alias("gain"))


def attention_scores(docs: DataFrame, model, size: int) -> DataFrame:
    """(doc_id, base_key, n_tokens, n_subwords, score) of every row with its ids."""
    def run(batches):
        m = model.value
        for batch, buf, off in slices(batches, "ids", IDS_BYTES):
            ids, at = bytes_ids(buf, off, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base_key"), batch.column("n_tokens"), pa.array(np.diff(at) + 1), pa.array(m.score(ids, at))],
                ["doc_id", "base_key", "n_tokens", "n_subwords", "score"])

    return docs.select("doc_id", "base_key", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, base_key long, n_tokens long, n_subwords long, score double")


def score_texts(docs: DataFrame, held_out: Column | None = None, vocabulary: str = VOCABULARY, steps: int = STEPS,
                head_words: int = HEAD_WORDS) -> DataFrame:
    """Base and model scores of every row; rows for which ``held_out`` holds are
    never learned from."""
    spark = prepare(docs.sparkSession, BATCH_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("base_key", F.xxhash64("doc_id", "text"))
    rows = rows.withColumn("learn", F.lit(True) if held_out is None else F.coalesce(~held_out, F.lit(False)))

    raw = read_ranks(vocabulary)
    ranks = spark.sparkContext.broadcast(raw)
    size = max(raw.values()) + 2
    tokens = stored(subword_table(rows, ranks, size))
    texts = tokens.filter("ids is not null")
    train = texts.filter("learn")
    counts = count_ids(train, size)
    unit, cls, share, net = outline(counts, count_neighbours(train, counts))
    net = learn(train, unit, cls, net, int(counts.sum()), steps)
    model = spark.sparkContext.broadcast(Model(unit, cls, share, net, size - 1))

    by_word = stored(tokens.filter("ids is null").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"))
    total = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    base = base_scores(rows, by_word, total["n"], total["v"], head_words)
    scored = attention_scores(texts, model, size)
    j = scored.join(base.withColumnRenamed("base_key", "known_key"), F.col("base_key") == F.col("known_key"))
    floor = float(np.log10(total["n"] + total["v"] + 1))
    return j.select("doc_id", "n_tokens", F.col("known").alias("n_known"), F.lit(int(total["n"])).cast("long").alias("train_tokens"),
                    (F.col("gain") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score", "n_subwords")


def op7(spark, sf_dir):
    held = slot("doc_id", 7) == 2
    return score_texts(table(spark, sf_dir, "documents"), held).withColumn("held_out", held)


QUERIES = {"op7_attention_lm": op7}
ORACLES: dict[str, str] = {}
