"""Language identification by prediction by partial matching.

Each language has a variable-order byte context tree. A text is the sequence of
its words, and the context of a byte is up to ``ORDER`` bytes before it within
the word (a word starts and ends with a space byte), so a word has one code
length per language and is scored once per batch however often it occurs. The
trees are counted over the words of all training rows, frozen, and turned into
code lengths once: escape method C with full exclusion, i.e. the probability of
a byte after an escape is taken among the bytes not seen in the longer context.
The code lengths are therefore those of a proper code: per context the
probabilities of all 256 bytes sum to one. The language with the shortest code
wins; the score is its share of the posterior over languages, computed from
code lengths per byte with a fixed evidence length (``EVIDENCE_BYTES``), so that
it stays comparable between short and long texts.

Nothing is cut: every context and every language of the training rows is in the
model. It is collected by the driver, ``COLLECT_GRAMS`` counts at a time, and
broadcast, so its size is that of the distinct (language, context, byte) rows.

Nulls and odd input: rows with null text or lang are not learned from; null
text, or text without a letter, is ``und`` with score 0; bytes are never
decoded, so any text has a finite code length; without training rows every text
is ``und``; each input row gives one row, also when an id repeats; a null doc_id
counts as '' for the fold. lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import prepare, slot, stored, table
from loadcast.llm.textnp import distinct_words, grams, slices, spelled

ORDER = 4
EVIDENCE_BYTES = 40
COLLECT_GRAMS = 500_000
FLUSH_GRAMS = 2_000_000
BATCH_BYTES = 16 << 20
SLICE_BYTES = 8 << 20
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    first = LETTER.search(text)
    return first is not None and (first[0].isalpha() or any(map(str.isalpha, text)))


def with_shorter(key: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams and counts, with those of all shorter contexts added."""
    keys, counts = [key], [n]
    depth = key >> 56
    for o in range(order):
        deep = depth > o
        keys.append((key[deep] & ((1 << 8 * (o + 1)) - 1)) | (o << 56))
        counts.append(n[deep])
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    return u, np.bincount(inv, np.concatenate(counts)).astype(np.int64)


def count_grams(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all words of all rows of (lang, text)."""
    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                u, n = with_shorter(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(n)], ["lang", "gram", "n"])

        for rows, buf, off in slices(batches, "text", SLICE_BYTES):
            langs = np.array(rows.column("lang").to_pylist(), dtype=object)
            s, e, prow, pword, pn = distinct_words(buf, off)
            for lang in set(langs.tolist()):
                mine = langs[prow] == lang
                weight = np.bincount(pword[mine], pn[mine], minlength=len(s)).astype(np.int64)
                seen = np.flatnonzero(weight)
                if not len(seen):
                    continue
                data, word = spelled(buf, s[seen], e[seen])
                i, key = grams(data, word, order)
                u, inv = np.unique(key, return_inverse=True)
                held.setdefault(lang, []).append((u, np.bincount(inv, weight[seen][word[i]]).astype(np.int64)))
                size += len(u)
            if size > FLUSH_GRAMS:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    parts = train.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTree:
    """Frozen code lengths of one language, as two sorted tables: bits of a byte
    in a context where it was seen, and bits of leaving a context."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int = ORDER):
        self.order = order
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.leave: list[tuple[np.ndarray, np.ndarray]] = []
        top = gram >> 56
        body = gram & ((1 << 56) - 1)
        for o in range(order + 1):
            k = np.argsort(body[top == o])
            key, c = body[top == o][k], n[top == o][k].astype(np.float64)
            ctx, first, size = np.unique(key >> 8, return_index=True, return_counts=True)
            if not len(key):
                self.seen.append((key, c))
                self.leave.append((ctx, np.zeros(0)))
                continue
            which = np.repeat(np.arange(len(ctx)), size)
            total = np.add.reduceat(c, first)
            # bytes of this context, in the next shorter one: excluded after an escape
            shorter = 2.0 ** -self.bits(key & ((1 << 8 * o) - 1 if o else 0xFF), o - 1)
            left = 1 - np.add.reduceat(shorter, first)
            full = (size >= 256) | (left <= 1e-12)
            room = np.where(full, total, total + size)
            self.seen.append((key, -np.log2(c / room[which])))
            esc = np.where(full, 60.0, -np.log2(np.where(full, 1.0, size / room)) + np.log2(np.maximum(left, 1e-12)))
            self.leave.append((ctx, esc))

    def bits(self, key: np.ndarray, order: int) -> np.ndarray:
        """Code length of the last byte of packed (context, byte) keys."""
        out = np.zeros(len(key))
        left = np.arange(len(key))
        for o in range(order, -1, -1):
            if not len(left):
                return out
            k = key[left] & ((1 << 8 * (o + 1)) - 1)
            table, cost = self.seen[o]
            at = np.minimum(np.searchsorted(table, k), max(len(table) - 1, 0))
            hit = table[at] == k if len(table) else np.zeros(len(k), bool)
            if len(table):
                out[left[hit]] += cost[at[hit]]
            left, k = left[~hit], k[~hit] >> 8
            ctx, esc = self.leave[o]
            if len(ctx) and len(left):
                at = np.minimum(np.searchsorted(ctx, k), len(ctx) - 1)
                known = ctx[at] == k
                out[left[known]] += esc[at[known]]
        out[left] += 8.0
        return out


def word_bits(trees: list[ContextTree], data: np.ndarray, word: np.ndarray, n: int, order: int) -> np.ndarray:
    """Code length of each word of :func:`spelled` bytes under each tree. Every
    distinct (context, byte) is looked up once."""
    total = np.zeros((n, len(trees)))
    i, key = grams(data, word, order)
    u, inv = np.unique(key, return_inverse=True)
    edge = np.searchsorted(u >> 56, np.arange(order + 2))
    cost = np.zeros(len(u))
    for t, tree in enumerate(trees):
        for o in range(1, order + 1):
            part = slice(edge[o], edge[o + 1])
            cost[part] = tree.bits(u[part] & ((1 << 56) - 1), o)
        total[:, t] = np.bincount(word[i], cost[inv], minlength=n)
    return total


def train(docs: DataFrame, order: int = ORDER) -> dict[str, ContextTree]:
    """Context trees by language from all rows of (lang, text)."""
    counts = stored(count_grams(docs.filter("lang is not null and text is not null"), order))
    sizes = sorted((r["lang"], r["count"]) for r in counts.groupBy("lang").count().collect())
    model, at = {}, 0
    while at < len(sizes):  # one large or several small trees at a time
        to, n = at + 1, sizes[at][1]
        while to < len(sizes) and n + sizes[to][1] <= COLLECT_GRAMS:
            n, to = n + sizes[to][1], to + 1
        some = counts.filter(F.col("lang").isin([lang for lang, _ in sizes[at:to]])).toPandas()
        for lang, g in some.groupby("lang"):
            model[lang] = ContextTree(g["gram"].to_numpy(), g["n"].to_numpy(), order)
        at = to
    return {lang: model[lang] for lang, _ in sizes}


def predict(docs: DataFrame, model: dict[str, ContextTree]) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of every row."""
    spark = prepare(docs.sparkSession, BATCH_BYTES)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        trees = list(shared.value.items())
        names = np.array([k for k, _ in trees] + ["und"], dtype=object)
        for rows, buf, off in slices(batches, "text", SLICE_BYTES):
            n = len(off) - 1
            s, e, prow, pword, pn = distinct_words(buf, off)
            data, word = spelled(buf, s, e)
            wb = word_bits([t for _, t in trees], data, word, len(s), trees[0][1].order if trees else 0)
            bits = np.zeros((n, len(trees)))
            for j in range(len(trees)):
                bits[:, j] = np.bincount(prow, pn * wb[pword, j], minlength=n)
            size = np.maximum(np.bincount(prow, pn * (e - s + 1)[pword], minlength=n), 1)
            letters = np.array([has_letter(x.as_py() or "") for x in rows.column("text")], bool)
            ok = letters & (len(trees) > 0)
            rate = bits / size[:, None]
            if len(trees):
                best = np.argmin(rate, axis=1)
                gap = np.clip((rate - rate.min(axis=1, keepdims=True)) * np.minimum(size, EVIDENCE_BYTES)[:, None], 0, 1000)
                score = 1 / np.sum(2.0 ** -gap, axis=1)
                low = rate.min(axis=1)
            else:
                best, score, low = np.zeros(n, int), np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(names[np.where(ok, best, len(trees))], pa.string()),
                 pa.array(np.where(ok, score, 0.0)), pa.array(np.where(ok, low, 0.0))],
                ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_byte double"))


def identify(docs: DataFrame, held_out: Column | None = None, **how) -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    prepare(docs.sparkSession, BATCH_BYTES)
    rows = docs.select("doc_id", "text", "lang")
    return predict(rows, train(rows if held_out is None else rows.filter(~held_out), **how))


def op10(spark, sf_dir):
    held = slot("doc_id", 4) == 2
    return identify(table(spark, sf_dir, "documents"), held).withColumn("held_out", held)


QUERIES = {"op10_language_ppm": op10}
ORACLES: dict[str, str] = {}
