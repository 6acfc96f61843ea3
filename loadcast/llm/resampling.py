"""Target-distribution importance resampling over hashed n-grams.

Every n-gram of a text falls into one of ``buckets`` buckets by its crc32. A
bucket's gain is the log ratio of its smoothed shares in the target texts and in
the documents, in thousandths; a document's weight is the sum of the gains of
its n-grams. Adding Gumbel noise seeded by the document's id and keeping the
highest scores draws documents without replacement in proportion to their
likelihood ratios.

Within a task, the n-grams of a slice of an Arrow batch are interned in an
open-addressed numpy table (``interning``: XXH64 keys, bytes compared). A slot
stores the bucket and the count of its n-gram, so that the crc32 is taken once a
distinct n-gram; the occurrences' slot ids gather the gains. Two passes read the
texts: one sums the slots' counts by bucket, one adds up gains. What reaches the
driver is two arrays of ``buckets`` counts, whatever the size of the input. Ranks
come from a range shuffle of the scored rows (not of the texts, unless the
caller keeps them): row numbers within partitions plus the partitions' offsets.

Nulls and odd input: null and empty texts have no features and weight 0; a null
doc_id hashes as '' and ranks after equal scores; rows with an equal doc_id and
score rank in any order; repeated rows are scored each on its own; empty tables
give no rows, an empty target has T = 0. Columns of the input are kept;
``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` replace input
columns of these names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm import textnp
from loadcast.llm.common import free_name, prepare, stored, table, typed
from loadcast.llm.interning import compact, intern

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
OWN = ("n_words", "n_features", "weight", "score", "rank")
# Word separators: ASCII other than digits and letters (A-Z are lower-cased).
SEPARATORS = np.zeros(256, bool)
SEPARATORS[0x00:0x30] = SEPARATORS[0x3A:0x41] = SEPARATORS[0x5B:0x61] = SEPARATORS[0x7B:0x80] = True
SLICE_BYTES = 2 << 20


def feature_slots(buf: np.ndarray, off: np.ndarray, min_n: int, max_n: int, buckets: int
                  ) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """Words per row, and for each n-gram length (row, slot) of every occurrence
    and (bucket, count) of every slot."""
    s, e, row = textnp.words(buf, off, SEPARATORS)
    text, s, e = compact(buf, s, e)
    n_words = np.bincount(row, minlength=len(off) - 1)

    def tables():
        for n in range(min_n, max_n + 1):
            first = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:]) if len(row) >= n else np.zeros(0, np.int64)
            at, size = s[first], e[first + n - 1] - s[first]
            owner, slot = intern(text, at, size)
            bucket = np.zeros(len(owner), np.int64)
            raw = text.tobytes()
            for i in np.flatnonzero(owner >= 0):
                a = at[owner[i]]
                bucket[i] = zlib.crc32(raw[a:a + size[owner[i]]]) % buckets
            yield row[first], slot, bucket, np.bincount(slot, minlength=len(owner))

    return n_words, tables()


def bucket_counts(texts: DataFrame, min_n: int = 1, max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences per bucket over all rows: one array of ``buckets`` numbers."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for _, buf, off in textnp.slices(batches, "text", SLICE_BYTES):
            for _, _, bucket, n in feature_slots(buf, off, min_n, max_n, buckets)[1]:
                np.add.at(total, bucket, n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = (texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of add-one shares), per bucket, in doubles."""
    s, t = docs.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def importance_weights(docs: DataFrame, target: DataFrame, min_n: int = 1, max_n: int = 1,
                       buckets: int = BUCKETS) -> DataFrame:
    """The documents with n_words, n_features and weight."""
    prepare(docs.sparkSession)
    docs = docs.drop(*OWN)
    gains = bucket_gains(bucket_counts(docs, min_n, max_n, buckets), bucket_counts(target, min_n, max_n, buckets))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def score(batches):
        for rows, buf, off in textnp.slices(batches, "text", SLICE_BYTES):
            n_words, tables = feature_slots(buf, off, min_n, max_n, buckets)
            n = np.zeros(len(off) - 1, np.int64)
            weight = np.zeros(len(off) - 1, np.int64)
            for row, slot, bucket, _ in tables:
                upto = np.concatenate([[0], np.cumsum(gains[bucket][slot])])
                edge = np.searchsorted(row, np.arange(len(off)))
                n += np.diff(edge)
                weight += np.diff(upto[edge])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n_words), pa.array(n), pa.array(weight)],
                                             names=[*rows.schema.names, "n_words", "n_features", "weight"])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(
        score, f"{schema}, n_words long, n_features long, weight long")


def gumbel(seed: int, doc_id: Column) -> Column:
    """Noise of a document in thousandths, from 32 bits of a sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(weighted: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """All rows with score and rank: the highest ``percent`` of the rows with at
    least ``min_words`` words are drawn and ranked from 1, the others' rank is null."""
    prepare(weighted.sparkSession)
    # stored first, as range partitioning reads its input twice
    scored = (stored(weighted.drop("score", "rank")).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id")))
              .withColumn("rank", F.col("n_words") >= min_words))
    order = [F.col("rank").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place, part_of, start = (free_name(x, scored.columns) for x in ("place", "place_part", "place_start"))
    # partition number in the upper bits, row number within the partition below
    placed = stored(scored.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(place, F.struct(F.col("rank").alias("fit"), F.monotonically_increasing_id().alias("at"))))
    fit, at = F.col(f"{place}.fit"), F.col(f"{place}.at")
    part = F.shiftright(at, 33)
    sizes = sorted((r["part"], r["n"], r["fit"]) for r in placed.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.sum(fit.cast("long")).alias("fit")).collect())  # a row a partition
    offset, rows = [], 0
    for p, n, _ in sizes:
        offset.append((p, rows))
        rows += n
    drawn = percent * sum(n for _, _, n in sizes) // 100
    offsets = placed.sparkSession.createDataFrame(offset, f"{part_of} long, {start} long")
    placed = placed.join(F.broadcast(offsets), part.cast("long") == F.col(part_of), "left")  # a row a partition
    rank = F.col(start) + at.bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("rank", F.when(fit & (rank <= drawn), rank)).drop(place, part_of, start)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED, min_n: int = 1, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The drawn documents, with all their columns, weight, score and rank."""
    return draw(importance_weights(docs, target, min_n, max_n, buckets), percent, min_words, seed).filter("rank is not null")


def op12(spark, sf_dir):
    docs = typed(table(spark, sf_dir, "documents"), "doc_id long", "text string")
    weighted = importance_weights(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return draw(weighted).select("doc_id", "n_features", "weight", "score", "rank")


# DuckDB has no crc32: the table of its 256 steps is made by the rule of the
# reflected polynomial 0xEDB88320, and each distinct word folded over it.
ORACLE = r"""
WITH step AS (SELECT list(list_reduce([b] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
                          ORDER BY b) AS s FROM range(256) r(b)),
d AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d),
f AS (SELECT side, doc_id, unnest(words) AS word FROM w),
v AS (SELECT DISTINCT word, hex(encode(word)) AS hx FROM f),
b AS (SELECT word, xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(hx) // 2),
                lambda i: ('0x' || substr(hx, 2 * i::BIGINT + 1, 2))::BIGINT),
                lambda c, y: xor(c >> 8, s[1 + xor(c & 255, y)])), 4294967295) % 10000 AS bucket FROM v, step),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE
                     / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
x AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
y AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM w LEFT JOIN x USING (doc_id) WHERE side = 0),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
             count(*) FILTER (n_features >= 20) OVER () AS fit FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * fit // 100 THEN r END AS rank FROM z
"""

QUERIES = {"op12_importance_resampling": op12}
ORACLES = {"op12_importance_resampling": ORACLE}
