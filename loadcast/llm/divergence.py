"""Source divergence audit: how far the sources of a language differ in their terms.

Each language keeps the terms that occur in at least ``min_docs`` of its
documents. A group (language, source) gives each kept term a smoothed share in
billionths, p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two shares differ by
f = floor((p - q)^2 / (p + q)). Two reports come from it: every pair of sources
of a language with the sum of f over all kept terms, and each group's terms whose
share is furthest above that of the whole language.

Terms are counted in tasks (interned per batch, bytes compared) and aggregated
on the map side. Kept terms get ids within blocks of about ``block_terms`` terms
by hash, and a group's counts are one sorted (id, count) array a block. A pair
task co-groups the two arrays of an unordered pair of sources in one block: the
shorter array gallops through the longer, and common terms, terms of one side
only and terms of neither are priced apart, the last by their number. So a task
holds two arrays of bounded size however large the vocabulary, and work per pair
grows with the terms that its sources have. All arithmetic is on integers.

Nulls and odd input: a null lang, source or text counts as ''; groups without a
kept term take part with count 0 everywhere; a language without kept terms has
all pairs at 0 and no term rows; repeated rows count each on its own; an empty
table gives no rows. Other columns are not read, so that names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.llm import textnp
from loadcast.llm.common import prepare, stored, table
from loadcast.llm.interning import compact, intern

MIN_DOCS = 10
TOP_TERMS = 10
BLOCK_TERMS = 8192
UNIT = 1_000_000_000
# Separators: ASCII other than letters.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[0x00:0x41] = SEPARATORS[0x5B:0x61] = SEPARATORS[0x7B:0x80] = True
SLICE_BYTES = 4 << 20
HELD_ROWS = 1 << 20


def _slice_counts(batches):
    """(lang, source, term, documents, occurrences) of each slice of rows."""
    for rows, buf, off in textnp.slices(batches, "text", SLICE_BYTES):
        lang, source = (rows.column(c).dictionary_encode() for c in ("lang", "source"))
        pair = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        s, e, row = textnp.words(buf, off, SEPARATORS)
        if not len(s):
            continue
        text, s, e = compact(buf, s, e)
        owner, slot = intern(text, s, e - s)
        used = np.flatnonzero(owner >= 0)
        term = (np.cumsum(owner >= 0) - 1)[slot]
        in_doc, n = np.unique(row * len(used) + term, return_counts=True)
        key = pair[in_doc // len(used)] * len(used) + in_doc % len(used)
        key, of = np.unique(key, return_inverse=True)
        occurrences = np.zeros(len(key), np.int64)
        np.add.at(occurrences, of, n)
        raw, first = text.tobytes(), owner[used]
        names = pa.array([raw[a:b] for a, b in zip(s[first], e[first])], pa.binary()).cast(pa.string())
        group = key // len(used)
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(group // len(source.dictionary))),
             source.dictionary.take(pa.array(group % len(source.dictionary))),
             names.take(pa.array(key % len(used))), pa.array(np.bincount(of)), pa.array(occurrences)],
            names=["lang", "source", "term", "docs", "n"])


def _task_counts(batches):
    """The counts of a task's slices, added up before they are shuffled. At most
    ``HELD_ROWS`` rows are held; what many slices share is small in number."""
    held, n = [], 0

    def combined():
        t = pa.Table.from_batches(held).group_by(["lang", "source", "term"], use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
        return t.select(["lang", "source", "term", "docs_sum", "n_sum"]).rename_columns(["lang", "source", "term", "docs", "n"])

    for batch in _slice_counts(batches):
        held.append(batch)
        n += batch.num_rows
        if n > HELD_ROWS:
            yield from combined().to_batches()
            held, n = [], 0
    if held:
        yield from combined().to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n) over all documents, dealt by (lang, term)."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # added up in the tasks, so one shuffle serves this aggregate and the terms' windows
    return (read.mapInArrow(_task_counts, "lang string, source string, term string, docs long, n long")
            .repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of the kept terms: (lang, source, term, n, lang_n, first), lang_n the
    count in the whole language, first true on one row of each term of a language."""
    same = W.partitionBy("lang", "term")
    return (term_counts(docs)
            .select("lang", "source", "term", "n", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("df"),
                    (F.row_number().over(same.orderBy("source")) == 1).alias("first"))
            .filter(F.col("df") >= min_docs).drop("df"))


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, vocabulary) of every occurring group."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("v"))
    lang = W.partitionBy("lang")
    zero = F.lit(0).cast("long")
    return (groups.join(sums, ["lang", "source"], "left")
            .select("lang", "source", F.coalesce("n", zero).alias("total"),
                    F.coalesce(F.sum("n").over(lang), zero).alias("lang_total"),
                    F.coalesce(F.sum("v").over(lang), zero).alias("vocabulary")))


def share_column(count: str, total: str) -> Column:
    """p in billionths, by exact decimals."""
    return F.expr(f"1 + (cast({count} + 2 as decimal(20,0)) * {UNIT}BD) div cast({total} + 2 * vocabulary as decimal(20,0))")


def share(count: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """p in billionths: long division three digits at a time, so that no product
    leaves 64 bits while the total is below 9 * 10^15."""
    den = np.int64(total + 2 * vocabulary)
    q, r = np.zeros(len(count), np.int64), np.asarray(count, np.int64) + 2
    for _ in range(3):
        r = r * 1000
        q = q * 1000 + r // den
        r = r % den
    return q + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in ``long`` (both sorted) that is
    not below it: steps that double until they pass it, then halving steps back."""
    lo = np.full(len(short), -1, np.int64)  # long[lo] < value
    step = 1
    going = np.arange(len(short))
    hi = np.full(len(short), len(long), np.int64)
    while len(going):
        at = lo[going] + step
        inside = at < len(long)
        below = np.zeros(len(going), bool)
        below[inside] = long[at[inside]] < short[going[inside]]
        stop = going[~below]
        hi[stop] = np.minimum(lo[stop] + step, len(long))
        going = going[below]
        lo[going] += step
        step *= 2
    while True:
        wide = np.flatnonzero(hi - lo > 1)
        if not len(wide):
            return hi
        mid = (lo[wide] + hi[wide]) // 2
        below = long[mid] < short[wide]
        lo[wide[below]] = mid[below]
        hi[wide[~below]] = mid[~below]


def pair_price(a: tuple, b: tuple, terms: int, vocabulary: int) -> int:
    """Sum of f over the ``terms`` terms of a block; a and b are (sorted ids,
    counts, total of the group)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    pa_, pb_ = share(a[1], a[2], vocabulary), share(b[1], b[2], vocabulary)
    none = np.zeros(1, np.int64)
    za, zb = share(none, a[2], vocabulary), share(none, b[2], vocabulary)
    at = gallop(a[0], b[0])
    common = np.zeros(len(a[0]), bool)
    inside = at < len(b[0])
    common[inside] = b[0][at[inside]] == a[0][inside]
    other = np.ones(len(b[0]), bool)
    other[at[common]] = False
    absent = terms - len(a[0]) - len(b[0]) + int(common.sum())
    return (int(price(pa_[common], pb_[at[common]]).sum()) + int(price(pa_[~common], zb).sum())
            + int(price(za, pb_[other]).sum()) + absent * int(price(za, zb)[0]))


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    sides = []
    for t in (left, right):
        ids, counts = (t.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("ids", "counts"))
        sides.append((ids, counts, t.column("total")[0].as_py()))
    value = pair_price(*sides, left.column("terms")[0].as_py(), left.column("vocabulary")[0].as_py())
    return pa.table({"lang": [key[0].as_py()], "source": [key[1].as_py()], "item": [key[2].as_py()], "value": [value]},
                    schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def source_pairs(kept: DataFrame, totals: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, item, value): every source of a language with every other."""
    blocks = totals.select("lang", F.ceil(F.col("vocabulary") / block_terms).alias("blocks")).filter("blocks > 0").distinct()
    block = W.partitionBy("lang", "block")
    ids = (kept.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
           .select("lang", "source", "block", "n", (F.dense_rank().over(block.orderBy("term")) - 1).alias("id")))
    arrays = stored(ids.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("a"))
                    .select("lang", "source", "block", F.col("a.id").alias("ids"), F.col("a.n").alias("counts")))
    sizes = (arrays.groupBy("lang", "block").agg((F.max(F.element_at("ids", -1)) + 1).cast("long").alias("terms")))
    other = totals.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    pairs = totals.join(other, "lang").filter("source < item").select("lang", "source", "item", "total", "item_total", "vocabulary")
    tasks = pairs.join(sizes, "lang")
    key = ["lang", "source", "item", "block"]

    def side(name, total):
        """One row a task: the array of one of its sources in the block, perhaps empty."""
        mine = arrays.select("lang", F.col("source").alias(name), "block", "ids", "counts")
        return (tasks.select(*key, "terms", "vocabulary", F.col(total).alias("total")).join(mine, ["lang", name, "block"], "left")
                # named anew, as both sides have one origin
                .select(*[F.col(c).alias(c) for c in (*key, "terms", "vocabulary", "total")], F.coalesce("ids", F.array().cast("array<int>")).alias("ids"),
                        F.coalesce("counts", F.array().cast("array<long>")).alias("counts")))

    priced = (side("source", "total").groupBy(*key).cogroup(side("item", "item_total").groupBy(*key))
              .applyInArrow(_pair_task, "lang string, source string, item string, value long"))
    sums = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    one = pairs.select("lang", "source", "item").join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    both = F.array(F.struct(F.col("source").alias("x"), F.col("item").alias("y")), F.struct(F.col("item").alias("x"), F.col("source").alias("y")))
    return one.select("lang", "value", F.explode(both).alias("p")).select(
        "lang", F.col("p.x").alias("source"), F.col("p.y").alias("item"), "value")


def distinctive_terms(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each group's terms above the language's share."""
    return (kept.join(totals, ["lang", "source"])
            .withColumn("p", share_column("n", "total")).withColumn("q", share_column("lang_n", "lang_total"))
            .filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    prepare(docs.sparkSession)
    kept = stored(kept_counts(docs, min_docs))
    totals = stored(group_totals(docs, kept))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pair = source_pairs(kept, totals, block_terms).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    term = distinctive_terms(kept, totals).select("lang", "source", F.lit("term").alias("part"), "item", "value", rank)
    return pair.union(term.filter(F.col("rank") <= top_terms))


def op13(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT id, lang, source, unnest(words) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN (SELECT c.* FROM c JOIN k USING (lang, term)) c
       USING (lang, source) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (gn.total + 2 * l.v) AS p,
             1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v) AS q
      FROM gn JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
         FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""

QUERIES = {"op13_source_divergence": op13}
ORACLES = {"op13_source_divergence": ORACLE}
