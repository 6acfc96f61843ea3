"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for each code point, the polynomial hash of all
before it, modulo 2^31 - 1 to two bases. The hash of any span is a difference of
two entries, so any two spans are compared in constant time, and how far two
texts agree from two places on (their longest common extension) is found by
binary search over span lengths (``common_extensions``).

A fingerprint is a sample of the prefix array that keeps this: the entries at up
to ``GRID`` evenly spaced places, and at up to ``ANCHORS`` places that the eight
code points before them select, so that a passage has the same ones wherever it
stands. Selected places have levels, and a long text keeps the higher levels
only; two fingerprints are compared at the higher of their levels, which is only
a matter of leaving out entries, as spans between any two of them have a hash.

``likeness`` is the share of both texts' code points that lie in their common
prefix or in a common run of spans of at least ``MIN_RUN`` code points; both are
extended by binary search. Equal texts have equal fingerprints and likeness 1.

``edited_fingerprints`` needs each document's successor in the order of doc_id:
rows are dealt to ranges of ids (by quantiles of the ids), each range ends with a
copy of the first row of the next one, and the sorted ranges are streamed. One
shuffle carries the texts.

Nulls and odd input: null texts count as empty; a null doc_id comes first; rows
with an equal id follow each other by text, repeated rows included; a single row
is its own successor; an empty text has likeness 0 to any other and 1 to an empty
one; an empty table gives no rows. Only doc_id and text are read where documents
are followed by their successors; ``with_fingerprints`` keeps all columns and
replaces ``n_chars`` and ``fingerprint``.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.llm import textnp
from loadcast.llm.common import prepare, table, typed

M = (1 << 31) - 1
BASES = (1_000_003_919, 1_664_525_731)
GRID = 16
ANCHORS = 48
WINDOW = 8  # code points that select a place
MIN_LEVEL = 4  # one place in 2^MIN_LEVEL is selected at most
MIN_RUN = 12
SLICE_BYTES = 1 << 20
FIRST = -(1 << 63)  # order of a null doc_id


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo M, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base
    while done < n:
        part = out[:min(done, n - done)]
        out[done:done + len(part)] = part * np.uint64(step) % np.uint64(M)
        done *= 2
        step = step * step % M
    return out


@functools.lru_cache(maxsize=len(BASES))
def _kept_powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse for a slice of the usual size."""
    return tuple(_powers(b, SLICE_BYTES + 1).astype(np.uint32) for b in (base, pow(base, -1, M)))


def power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= SLICE_BYTES + 1:
        return _kept_powers(base)
    return _powers(base, n), _powers(pow(base, -1, M), n)


class PrefixHashes:
    """Prefix arrays of a run of code points, which may hold many texts."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.n, self.sums, self.inverse = n, [], []
        wide = points.astype(np.uint64) + np.uint64(1)
        for base in BASES:
            powers, inverse = power_tables(base, n + 1)
            s = np.zeros(n + 1, np.uint64)
            # terms are under 2^31, so 2^33 of them add up within 64 bits
            np.cumsum(wide * powers[:n] % np.uint64(M), out=s[1:])
            self.sums.append(s)
            self.inverse.append(inverse)

    def residues(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hashes of the spans [i, j) to base k."""
        m = np.uint64(M)
        return (self.sums[k][j] - self.sums[k][i]) % m * self.inverse[k][i] % m

    def spans(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hashes of the spans [i, j) as one 62-bit number each."""
        i, j = np.asarray(i), np.asarray(j)
        return (self.residues(0, i, j) << np.uint64(31)) | self.residues(1, i, j)

    def windows(self, w: int) -> np.ndarray:
        """Hashes to base 0 of every run of ``w`` code points."""
        m, s = np.uint64(M), self.sums[0]
        return (s[w:] - s[:-w]) % m * self.inverse[0][:max(self.n - w + 1, 0)] % m if self.n >= w else s[:0]

    def extension(self, i: np.ndarray, i_end: np.ndarray, j: np.ndarray, j_end: np.ndarray) -> np.ndarray:
        """Longest common extension of the places i and j, each within its end."""
        i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
        lo, hi = np.zeros(len(i), np.int64), np.minimum(np.asarray(i_end) - i, np.asarray(j_end) - j)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.spans(i, i + mid) == self.spans(j, j + mid)
            lo = np.where(same, mid, lo)
            hi = np.where(same, hi, mid - 1)
        return lo


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, offsets)."""
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), off


@dataclass
class Print:
    """A fingerprint: length, hash of the whole text, prefix hashes on the grid, and
    the selected places with their levels and prefix hashes."""
    n: int
    whole: int
    grid: np.ndarray
    at: np.ndarray
    level: np.ndarray
    prefix: np.ndarray
    lowest: int
    inverse: list[np.ndarray]  # inverse powers at the selected places, one array a base

    @property
    def step(self) -> int:
        return grid_step(self.n)

    def text(self) -> str:
        head = struct.pack("<QQBBB", self.n, self.whole, self.lowest, len(self.grid), len(self.at))
        return base64.b64encode(head + self.grid.astype("<u8").tobytes() + self.prefix.astype("<u8").tobytes()
                                + self.at.astype("<u4").tobytes() + self.level.astype("u1").tobytes()).decode()

    @staticmethod
    def parse(text: str) -> Print:
        raw = base64.b64decode(text)
        n, whole, lowest, g, k = struct.unpack_from("<QQBBB", raw)
        at = 19
        parts = []
        for kind, count in (("<u8", g), ("<u8", k), ("<u4", k), ("u1", k)):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        inverse = [np.array([pow(base, -int(x), M) for x in parts[2]], np.uint64) for base in BASES]
        return Print(n, whole, parts[0], parts[2].astype(np.int64), parts[3].astype(np.int64), parts[1], lowest, inverse)


def grid_step(n: int) -> int:
    """log2 of the distance of grid places: as fine as ``GRID`` places allow."""
    step = 0
    while n >> step > GRID:
        step += 1
    return step


def prints(points: np.ndarray, off: np.ndarray) -> list[Print]:
    """Fingerprints of all texts of a run of code points."""
    n_rows, sizes = len(off) - 1, np.diff(off)
    hashes = PrefixHashes(points)
    mixed = textnp.mix(hashes.windows(WINDOW) + np.uint64(1))
    place = np.flatnonzero((mixed & np.uint64((1 << MIN_LEVEL) - 1)) == 0)
    low = mixed[place] & np.uint64((1 << 32) - 1)
    of = np.searchsorted(off, place, side="right") - 1  # the text that the window begins in
    inside = place + WINDOW <= off[of + 1]
    place, low, of = place[inside] + WINDOW, low[inside], of[inside]
    level = np.where(low == 0, 32, np.log2(np.maximum(low & (~low + np.uint64(1)), 1).astype(np.float64)).astype(np.int64))
    count = np.bincount(of * 33 + level, minlength=n_rows * 33).reshape(n_rows, 33)
    above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1]  # places at a level or higher
    lowest = np.maximum((above > ANCHORS).sum(axis=1), MIN_LEVEL)
    chosen = level >= lowest[of]
    place, level, of = place[chosen], level[chosen], of[chosen]
    prefix = hashes.spans(off[of], place)
    edge = np.searchsorted(of, np.arange(n_rows + 1))
    whole = hashes.spans(off[:-1], off[1:])
    steps = np.array([grid_step(int(n)) for n in sizes], np.int64)
    grids = sizes >> steps
    grid_row = np.repeat(np.arange(n_rows), grids)
    grid_edge = np.concatenate([[0], np.cumsum(grids)]).astype(np.int64)
    grid_at = off[grid_row] + ((np.arange(grid_edge[-1]) - grid_edge[grid_row] + 1) << steps[grid_row])
    grid = hashes.spans(off[grid_row], grid_at)
    place -= off[of]
    inverse = [inv[place].astype(np.uint64) for inv in hashes.inverse]
    return [Print(int(sizes[r]), int(whole[r]), grid[grid_edge[r]:grid_edge[r + 1]], place[a:b], level[a:b], prefix[a:b],
                  int(lowest[r]), [inv[a:b] for inv in inverse])
            for r, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist()))]


def _common_prefix(a: Print, b: Print) -> int:
    """Code points of the longest agreeing prefix that ends on both grids."""
    step = max(a.step, b.step)
    ga, gb = (p.grid[(1 << (step - p.step)) - 1::1 << (step - p.step)] for p in (a, b))
    lo, hi = 0, min(len(ga), len(gb))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if ga[mid - 1] == gb[mid - 1] else (lo, mid - 1)
    return lo << step


class _Spans:
    """The spans between selected places (with 0 and n) at a level and above."""

    def __init__(self, p: Print, lowest: int):
        chosen = p.level >= lowest
        tail = [] if chosen.any() and p.at[chosen][-1] == p.n else [p.n]
        self.at = np.concatenate([[0], p.at[chosen], np.array(tail, np.int64)]).astype(np.int64)
        prefix = np.concatenate([np.zeros(1, np.uint64), p.prefix[chosen], np.array([p.whole] * len(tail), np.uint64)])
        self.prefix = (prefix >> np.uint64(31), prefix & np.uint64(M))
        self.inverse = [np.concatenate([np.ones(1, np.uint64), v[chosen], np.ones(len(tail), np.uint64)]) for v in p.inverse]

    def hashes(self, i, j):
        """62-bit hashes of the spans from place i to place j."""
        m = np.uint64(M)
        a, b = ((s[j] + m - s[i]) % m * v[i] % m for s, v in zip(self.prefix, self.inverse))
        return (a << np.uint64(31)) | b

    def each(self) -> list[int]:
        return self.hashes(slice(0, -1), slice(1, None)).tolist()

    def span(self, i: int, j: int) -> tuple[int, int]:
        return int(self.at[j] - self.at[i]), int(self.hashes(i, j))


def likeness(a: Print, b: Print) -> float:
    """Share of the code points of both texts in common prefixes and runs."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    if a.n == 0 or b.n == 0:
        return 0.0
    lowest = max(a.lowest, b.lowest)
    sides = (_Spans(a, lowest), _Spans(b, lowest))
    one, two = (s.each() for s in sides)
    prefix = _common_prefix(a, b)
    total = 2 * prefix
    common = set(one).intersection(two)
    if common:
        places = defaultdict(list)
        for j, s in enumerate(two):
            if s in common:
                places[s].append(j)
        covered = (np.zeros(len(one), bool), np.zeros(len(two), bool))
        for i, s in enumerate(one):
            for j in places.get(s, ()):
                if i and j and one[i - 1] == two[j - 1]:
                    continue  # inside a run that began before
                lo, hi = 1, min(len(one) - i, len(two) - j)
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    lo, hi = (mid, hi) if sides[0].span(i, i + mid) == sides[1].span(j, j + mid) else (lo, mid - 1)
                size, found = sides[0].span(i, i + lo)
                if size >= min(MIN_RUN, a.n, b.n) and (size, found) == sides[1].span(j, j + lo):
                    covered[0][i:i + lo] = covered[1][j:j + lo] = True
        for side, inside in zip(sides, covered):
            total += int(np.maximum(side.at[1:] - np.maximum(side.at[:-1], prefix), 0)[inside].sum())
    return total / (a.n + b.n)


@F.pandas_udf(T.DoubleType())
def likeness_column(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two fingerprint columns; null if either is."""
    return pd.Series([None if x is None or y is None else likeness(Print.parse(x), Print.parse(y)) for x, y in zip(a, b)], dtype="float64")


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """The documents with n_chars and fingerprint."""
    prepare(docs.sparkSession)
    docs = docs.drop("n_chars", "fingerprint").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for rows, _, _ in textnp.slices(batches, "text", SLICE_BYTES):
            found = prints(*code_points([t or "" for t in rows.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([p.n for p in found], pa.int64()), pa.array([p.text() for p in found])],
                                             names=[*rows.schema.names, "n_chars", "fingerprint"])

    return docs.mapInArrow(run, f"{schema}, n_chars long, fingerprint string")


def common_extensions(pairs: DataFrame) -> DataFrame:
    """Pairs of places with ``extension``, the number of code points on which
    left_text from left_at and right_text from right_at agree. Null texts count
    as empty, null places as 0; places outside a text have extension 0."""
    prepare(pairs.sparkSession)
    pairs = pairs.drop("extension")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in pairs.schema.fields)

    def run(batches):
        for rows, _, _ in textnp.slices(batches, "left_text", SLICE_BYTES):
            ends, starts = [], []
            texts = [t or "" for c in ("left_text", "right_text") for t in rows.column(c).to_pylist()]
            points, off = code_points(texts)
            n = rows.num_rows
            for k, c in enumerate(("left_at", "right_at")):
                at = np.array([x or 0 for x in rows.column(c).to_pylist()], np.int64)
                lo, hi = off[k * n:(k + 1) * n], off[k * n + 1:(k + 1) * n + 1]
                ends.append(hi)
                starts.append(np.where((at >= 0) & (at < hi - lo), lo + at, hi))
            found = PrefixHashes(points).extension(starts[0], ends[0], starts[1], ends[1])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found)], names=[*rows.schema.names, "extension"])

    return pairs.mapInArrow(run, f"{schema}, extension long")


def id_ranges(rows: DataFrame, count: int) -> DataFrame:
    """Rows of (at, text) with ``range``, dealt by quantiles of ``at``, and after the
    rows of each range a copy (``ghost``) of the first row of the next one; the
    last range ends with the first row of all."""
    bounds = np.unique(rows.approxQuantile("at", [i / count for i in range(1, count)], 0.2 / count)) if count > 1 else np.zeros(0)

    @F.pandas_udf(T.IntegerType())
    def which(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy().astype(np.float64), side="right").astype(np.int32))

    dealt = rows.withColumn("range", which("at"))
    first = sorted((r["range"], r["at"]) for r in
                   dealt.select("at", "range").groupBy("range").agg(F.min("at").alias("at")).collect())  # ``count`` rows
    spark = rows.sparkSession
    before = [(at, first[i - 1][0]) for i, (_, at) in enumerate(first)]
    heads = spark.createDataFrame(before, "at long, range int")
    ghosts = (rows.join(F.broadcast(heads), "at").groupBy("at", "range").agg(F.min("text").alias("text"))
              .select("at", "text", "range", F.lit(True).alias("ghost")))
    return dealt.select("at", "text", "range", F.lit(False).alias("ghost")).union(ghosts)


def _edit(batches) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges in order -> fingerprints of every row that is no ghost."""
    held = None  # the last row, until its successor comes
    for rows, _, _ in textnp.slices(batches, "text", SLICE_BYTES):
        ats, texts, ghosts = (rows.column(c).to_pylist() for c in ("at", "text", "ghost"))
        if held is not None:
            ats, texts, ghosts = [held[0], *ats], [held[1], *texts], [False, *ghosts]
        held = None if ghosts[-1] else (ats[-1], texts[-1])
        mine = [i for i in range(len(ats) - 1) if not ghosts[i]]
        if not mine:
            continue
        edits = []
        for i in mine:
            cut = len(texts[i]) // 4
            edits.append(texts[i][:len(texts[i]) - cut] + texts[i + 1][:cut])
        own, new = prints(*code_points(texts)), prints(*code_points(edits))
        yield pa.RecordBatch.from_arrays([
            pa.array([ats[i] for i in mine], pa.int64()), pa.array([own[i].n for i in mine], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits]),
            pa.array([own[i].text() for i in mine]), pa.array([p.text() for p in new]),
            pa.array([likeness(own[i], p) for i, p in zip(mine, new)], pa.float64()),
            pa.array([likeness(own[i], own[i + 1]) for i in mine], pa.float64())],
            names=["at", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its text with the last quarter replaced
    by the beginning of the next document, and its likeness to both."""
    spark = prepare(docs.sparkSession)
    count = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = typed(docs, "doc_id long", "text string").select(
        F.coalesce("doc_id", F.lit(FIRST).cast("long")).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["range", "ghost", "at", "text"]
    done = (id_ranges(rows, count).repartition("range").sortWithinPartitions(*order)
            .mapInArrow(_edit, "at long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                               "near_edited double, near_next double"))
    return done.withColumn("doc_id", F.when(F.col("at") != FIRST, F.col("at"))).select("doc_id", *[c for c in done.columns if c != "at"])


def op11(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op11_prefix_fingerprints": op11}
ORACLES = {}
