"""Quality rules: gradient-boosted trees over document statistics.

One pass over the texts computes the statistics (Arrow batches, byte-level
numpy; a batch is worked through in bounded slices). The trees are fitted on the
statistics of at most ``sample_rows`` labelled documents, taken in the order of
a hash of their id -- a documented bound on a classifier's training sample --
and flattened into numpy node arrays. Scoring walks all rows of a batch through
a level of the tree at a time. Statistics named in ``MONOTONE`` may only lower
(-1) or raise (+1) the predicted quality: a split that would break the order is
not taken, and each side's leaf values are bounded by the middle of the parent
split, so the whole ensemble is monotonic.

Null or empty texts have no words and fail the base rule. Documents labelled
both good and bad, and labels or ids that are null, are not trained on; without
two classes to learn from the verdict is "keep". Each input row gives one row,
also when an id repeats. Input columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import prepare, stored, table
from loadcast.llm.textnp import SEP, shingles, slices, span_hashes, words

WINDOW = 8
SAMPLE_ROWS = 40_000

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_LEAD = np.ones(256, np.uint8)
_LEAD[0x80:0xC0] = 0  # continuation bytes do not start a code point
_DIGIT = np.zeros(256, np.uint8)
_DIGIT[0x30:0x3A] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[0x41:0x5B] = 1
_PUNCT = np.zeros(256, np.uint8)
_PUNCT[list(b".,;:!?")] = 1

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_digits", "n_upper", "n_punct", "n_distinct_words", "longest_word"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "words_per_line",
            "digit_share", "upper_share", "punct_per_word", "distinct_share", "longest_word", "log_lines"]
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per row."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return np.bincount(r[new], minlength=n)


def repeated_words(h: np.ndarray, row: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Words per row that lie in a window found at least twice in that row."""
    sh, at = shingles(h, row, window)
    if not len(sh):
        return np.zeros(n, np.int64)
    order = np.lexsort((sh, row[at]))
    s, r = sh[order], row[at][order]
    same = (s[1:] == s[:-1]) & (r[1:] == r[:-1])
    dup = np.zeros(len(s), bool)
    dup[1:] |= same
    dup[:-1] |= same
    starts = at[order][dup]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)


def statistics(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for every row of a slice."""
    n = len(off) - 1
    s, e, row = words(buf, off)
    h = span_hashes(buf, s, e, lower=False)
    sep = SEP[buf]
    out = {"n_words": np.bincount(row, minlength=n),
           "word_chars": _per_row(_LEAD[buf] * ~sep, off),
           "n_symbols": _per_row(_SYMBOL[buf], off),
           "n_digits": _per_row(_DIGIT[buf], off),
           "n_upper": _per_row(_UPPER[buf], off),
           "n_punct": _per_row(_PUNCT[buf], off),
           "n_distinct_words": _distinct(row, h, n),
           "n_repeat_words": repeated_words(h, row, n)}
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, row, e - s)
    out["longest_word"] = longest
    # lines: between the borders of rows and line feeds
    feeds = np.flatnonzero(buf == 10)
    ls = np.sort(np.concatenate([off[:-1], feeds + 1]))
    le = np.sort(np.concatenate([off[1:], feeds]))
    has_word = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ls, le = ls[has_word], le[has_word]
    lrow = np.searchsorted(off, ls, side="right") - 1
    out["n_lines"] = np.bincount(lrow, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - _distinct(lrow, span_hashes(buf, ls, le, lower=False), n)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts): one row per input row, over whole texts."""
    prepare(docs.sparkSession)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches):
        for rows, buf, off in slices(batches, "text"):
            st = statistics(buf, off)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id")] + [pa.array(st[c].astype(np.int64)) for c in COUNTS], ["doc_id", *COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def features(pdf: pd.DataFrame) -> np.ndarray:
    c = {k: pdf[k].to_numpy(np.float64) for k in COUNTS}
    w, ch, ln = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / w, c["n_symbols"] / ch, c["n_dup_lines"] / ln,
        c["n_repeat_words"] / w, w / ln, c["n_digits"] / ch, c["n_upper"] / ch, c["n_punct"] / w,
        c["n_distinct_words"] / w, c["longest_word"], np.log1p(c["n_lines"])])


class Trees:
    """Flattened ensemble: for tree t and node j, split feature (-1 at a leaf),
    threshold and value; children of node j are 2j+1 and 2j+2."""

    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        self.feature: np.ndarray = np.zeros((0, 0), np.int32)
        self.threshold: np.ndarray = np.zeros((0, 0))
        self.value: np.ndarray = np.zeros((0, 0))

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        at = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                split = f[node] >= 0
                right = x[at, np.maximum(f[node], 0)] > t[node]
                node = np.where(split, 2 * node + 1 + right, node)
            total += v[node]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, n_trees: int = 60, depth: int = 3,
              rate: float = 0.2, bins: int = 32, l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Histogram boosting with logistic loss and monotonic constraints."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(depth, float(np.log(p / (1 - p))))
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    code = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)])
    raw = np.full(len(y), model.base)
    size = 2 ** (depth + 1) - 1
    fs, ts, vs = [], [], []
    for _ in range(n_trees):
        prob = 1 / (1 + np.exp(-raw))
        g, h = y - prob, prob * (1 - prob)
        f, t, v = np.full(size, -1, np.int32), np.zeros(size), np.zeros(size)
        low, high = np.full(size, -np.inf), np.full(size, np.inf)
        rows = {0: np.arange(len(y))}
        for node in range(size):
            if node not in rows:
                continue
            r = rows[node]
            gs, hs = g[r].sum(), h[r].sum()
            v[node] = np.clip(gs / (hs + l2), low[node], high[node])
            if node >= size // 2 or len(r) < 2 * min_rows:
                continue
            best = (1e-6, None)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                m = len(e) + 1
                gl = np.cumsum(np.bincount(code[r, j], g[r], m))[:-1]
                hl = np.cumsum(np.bincount(code[r, j], h[r], m))[:-1]
                nl = np.cumsum(np.bincount(code[r, j], minlength=m))[:-1]
                left = np.clip(gl / (hl + l2), low[node], high[node])
                right = np.clip((gs - gl) / (hs - hl + l2), low[node], high[node])
                gain = (left * gl - left**2 * (hl + l2) / 2) + (right * (gs - gl) - right**2 * (hs - hl + l2) / 2) \
                    - (v[node] * gs - v[node]**2 * (hs + l2) / 2)
                ok = (nl >= min_rows) & (len(r) - nl >= min_rows) & (monotone[j] * (right - left) >= 0)
                gain = np.where(ok, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, left[k], right[k]))
            if best[1] is None:
                continue
            j, k, vl, vr = best[1]
            f[node], t[node] = j, edges[j][k]
            a, b = 2 * node + 1, 2 * node + 2
            goes = code[r, j] > k
            rows[a], rows[b] = r[~goes], r[goes]
            low[a] = low[b] = low[node]
            high[a] = high[b] = high[node]
            if monotone[j]:
                mid = (vl + vr) / 2
                (high if monotone[j] > 0 else low)[a] = mid
                (low if monotone[j] > 0 else high)[b] = mid
        v *= rate
        fs.append(f), ts.append(t), vs.append(v)
        model.feature, model.threshold, model.value = f[None], t[None], v[None]
        raw += model.raw(x) - model.base
    model.feature, model.threshold, model.value = np.array(fs), np.array(ts), np.array(vs)
    return model


def train(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **how) -> Trees:
    """Fit on the statistics of at most ``sample_rows`` labelled documents."""
    lab = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
           .agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).filter("y = y2").drop("y2"))
    one = stats.join(lab, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).toPandas()
    mono = np.array([MONOTONE.get(k, 0) for k in FEATURES])
    if one.empty:
        return Trees(3, 10.0)
    return fit_trees(features(one), (one["y"].to_numpy() > 0).astype(float), mono, **how)


def quality_verdicts(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
                     threshold: float = 0.5) -> DataFrame:
    """Statistics, base rule, predicted quality and verdict of every document."""
    stats = stored(document_statistics(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(stats, labels, sample_rows))

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(model.value.predict(features(pd.DataFrame(dict(zip(COUNTS, cols))))))

    failed = F.expr(f"n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    out = stats.withColumn("base_failed", failed).withColumn("quality_score", score(*COUNTS))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold))


def op4(spark, sf_dir):
    return (quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "quality_score"))


QUERIES = {"op4_quality_trees": op4}
ORACLES: dict[str, str] = {}
