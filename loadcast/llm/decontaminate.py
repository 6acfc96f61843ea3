"""Benchmark decontamination by SimHash over item-sized windows.

An item of n words is compared with windows of n words of every text. Windows
and items are fingerprinted by SimHash over their 5-word shingles (64 bits, each
occurrence of a shingle has weight one). The items' fingerprints are indexed by
their eight 8-bit blocks: two fingerprints within ``RADIUS`` = 23 bits have a
block that differs in at most 2 bits, so looking up all values within 2 bits of
every block finds all of them. What is found is verified by the exact similarity
of the weighted shingles: sum of the smaller over sum of the larger counts,
0.8 or more. (At similarity 0.8 fingerprints differ in 9.7 bits on average with
a deviation of 2.9, so the radius is 4.6 deviations away; equal windows differ
in none.)

Only windows that hold at least one shingle of the benchmark are fingerprinted:
any other has similarity 0. The benchmark is the query set: it is taken in blocks
of about ``block_items`` items, each broadcast with a checked size, against all
rows of the corpus.

Nulls and odd input: null or empty texts and items match nothing; an item of
fewer than 5 words has its whole sequence as its only shingle, and so have the
windows of its size; items with null id are ignored; items with equal text all
match; rows that repeat a doc_id are reported once per item, with the best
window; rows with null doc_id are reported under null, and dropped from the
corpus if contaminated; ties between windows go to the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import prepare, table
from loadcast.llm.textnp import shingles, slices, span_hashes, text_buffer, whole_hashes, words

K = 5
BITS = 64
BLOCK_BITS = 8
NEAR = 2
RADIUS = (BITS // BLOCK_BITS) * (NEAR + 1) - 1
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 64 << 20
STRIDE = 20_000
_NEIGHBOURS = [[v for v in range(256) if bin(u ^ v).count("1") <= NEAR] for u in range(256)]


def planes(sh: np.ndarray) -> np.ndarray:
    """+1/-1 per bit of each shingle hash."""
    bits = np.unpackbits(sh.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def fold(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as eight bytes from sums of bit planes."""
    return np.packbits(sums > 0, axis=1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger shingle counts."""
    u, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    ca, cb = np.bincount(inv[:len(a)], minlength=len(u)), np.bincount(inv[len(a):], minlength=len(u))
    return float(np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()) if len(u) else 0.0


class Items:
    """One block of the benchmark: shingles of all items, and by item size a
    multi-index of fingerprint blocks."""

    def __init__(self, ids: list[int], texts: list[str]):
        data = pa.array([t or "" for t in texts], pa.large_string())
        buf, off = text_buffer(data)
        s, e, row = words(buf, off)
        h = span_hashes(buf, s, e)
        start = np.searchsorted(row, np.arange(len(ids) + 1))
        self.ids, self.size = ids, np.diff(start)
        sh, at = shingles(h, row, K)
        begin = np.searchsorted(row[at], np.arange(len(ids) + 1)) if len(at) else np.zeros(len(ids) + 1, np.int64)
        short = np.flatnonzero((self.size > 0) & (self.size < K))
        whole = dict(zip(short.tolist(), whole_hashes(h, start, short)))
        self.sets = [np.array([whole[i]], np.uint64) if i in whole else sh[begin[i]:begin[i + 1]] for i in range(len(ids))]
        self.known = np.unique(np.concatenate([x for n, x in zip(self.size, self.sets) if n >= K] or [np.zeros(0, np.uint64)]))
        self.by_size: dict[int, tuple] = {}
        for n in np.unique(self.size[self.size > 0]).tolist():
            mine = np.flatnonzero(self.size == n)
            prints = fold(np.stack([planes(self.sets[i]).sum(axis=0, dtype=np.int32) for i in mine]))
            index = [[[] for _ in range(256)] for _ in range(8)]
            for j, p in enumerate(prints):
                for b in range(8):
                    for v in _NEIGHBOURS[p[b]]:
                        index[b][v].append(j)
            self.by_size[n] = (mine, prints, [[np.array(x, np.int64) for x in blk] for blk in index])
        # which sizes a hit on a shingle concerns
        self.sizes_of: dict[int, set[int]] = {}
        for n, x in zip(self.size.tolist(), self.sets):
            if n >= K:
                for v in x.tolist():
                    self.sizes_of.setdefault(v, set()).add(n)

    def candidates(self, prints: np.ndarray, n: int) -> np.ndarray:
        """(window, item) pairs of size ``n`` within the radius."""
        mine, own, index = self.by_size[n]
        found = []
        for b in range(8):
            for v in np.unique(prints[:, b]):
                items = index[b][v]
                if len(items):
                    w = np.flatnonzero(prints[:, b] == v)
                    found.append(np.stack([np.repeat(w, len(items)), np.tile(items, len(w))], axis=1))
        if not found:
            return np.zeros((0, 2), np.int64)
        pairs = np.unique(np.concatenate(found), axis=0)
        apart = np.unpackbits(prints[pairs[:, 0]] ^ own[pairs[:, 1]], axis=1).sum(axis=1)
        pairs = pairs[apart <= RADIUS]
        pairs[:, 1] = mine[pairs[:, 1]]
        return pairs

    def match(self, h: np.ndarray, percent: int) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of one text's word hashes: the
        best window for every item that reaches ``percent``."""
        best: dict[int, tuple[float, int]] = {}

        def judge(item: int, window: np.ndarray, at: int):
            sim = weighted_similarity(window, self.sets[item])
            if 100 * sim >= percent - 1e-9 and (item not in best or (-sim, at) < (-best[item][0], best[item][1])):
                best[item] = (sim, at)

        row = np.zeros(len(h), np.int64)
        sh, _ = shingles(h, row, K)
        hits = np.flatnonzero(np.isin(sh, self.known)) if len(sh) and len(self.known) else np.zeros(0, np.int64)
        sizes: dict[int, list[int]] = {}
        for p in hits.tolist():
            for n in self.sizes_of.get(int(sh[p]), ()):
                sizes.setdefault(n, []).append(p)
        for n, at in sizes.items():
            if n > len(h):  # the whole text is the one window
                prints = fold(planes(sh).sum(axis=0, dtype=np.int32)[None])
                for _, item in self.candidates(prints, n):
                    judge(int(item), sh, 0)
                continue
            # starts of all windows of n words that hold a hit
            span = n - K + 1
            delta = np.zeros(len(sh) + span + 1, np.int64)
            np.add.at(delta, np.maximum(np.array(at) - span + 1, 0), 1)
            np.add.at(delta, np.array(at) + 1, -1)
            starts = np.flatnonzero(np.cumsum(delta)[:len(h) - n + 1] > 0)
            for x in range(0, len(starts), STRIDE):
                part = starts[x:x + STRIDE]
                lo, hi = part[0], part[-1] + span
                total = np.zeros((hi - lo + 1, BITS), np.int32)
                np.cumsum(planes(sh[lo:hi]), axis=0, out=total[1:])
                prints = fold(total[part - lo + span] - total[part - lo])
                for w, item in self.candidates(prints, n):
                    judge(int(item), sh[part[w]:part[w] + span], int(part[w]))
        for n in range(1, K):  # items shorter than a shingle
            if n in self.by_size and len(h) >= n:
                wins, at = shingles(h, row, n)
                whole = np.array([self.sets[i][0] for i in self.by_size[n][0]])
                for w in np.flatnonzero(np.isin(wins, whole)):
                    for item in self.by_size[n][0]:
                        if self.sets[item][0] == wins[w]:
                            judge(int(item), wins[w:w + 1], int(at[w]))
        return [(i, s, a, min(int(self.size[i]), len(h))) for i, (s, a) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES):
    """The benchmark as :class:`Items`, a block at a time, each of bounded size."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null")
    total = b.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    n = max(1, -(-total["n"] // block_items), -(-(total["size"] or 0) // block_bytes))
    for i in range(n):
        rows = b.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).orderBy("item_id").toPandas()
        if len(rows):
            yield Items(rows["item_id"].tolist(), rows["text"].tolist())


def _rows(buf, off):
    """Word hashes of every row."""
    s, e, row = words(buf, off)
    h = span_hashes(buf, s, e)
    start = np.searchsorted(row, np.arange(len(off)))
    sh, at = shingles(h, row, K)
    return h, start, sh, row[at]


def _worth(items: Items, buf, off):
    """(row, word hashes) of the rows that share a shingle with the items, or
    could hold an item shorter than a shingle."""
    h, start, sh, srow = _rows(buf, off)
    if any(n < K for n in items.by_size):
        rows = range(len(off) - 1)
    else:
        rows = np.unique(srow[np.isin(sh, items.known)]) if len(sh) else []
    for r in rows:
        yield int(r), h[start[r]:start[r + 1]]


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = 80, **blocks) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best window of
    every document for every item that it holds."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, **blocks):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = shared.value
            for batch, buf, off in slices(batches, "text"):
                found = [(r, items.ids[i], s, a, n) for r, h in _worth(items, buf, off) for i, s, a, n in items.match(h, percent)]
                if found:
                    r, i, s, a, n = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(r)), pa.array(i, pa.int64()), pa.array(s, pa.float64()),
                         pa.array(a, pa.int64()), pa.array(n, pa.int64())], [c.split()[0] for c in schema.split(", ")])

        out = out.union(rows.mapInArrow(run, schema))
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "n_words"))
    return (out.groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", F.round("best.similarity", 9).alias("similarity"), (-F.col("best.back")).alias("first_word"), "best.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, **blocks) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    spark = prepare(docs.sparkSession)
    out = docs
    for block in item_blocks(benchmark, **blocks):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = shared.value
            for batch, buf, off in slices(batches, "text"):
                keep = np.ones(batch.num_rows, bool)
                for r, h in _worth(items, buf, off):
                    keep[r] = not items.match(h, percent)
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def op5(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontaminate_simhash": op5}
ORACLES: dict[str, str] = {}
