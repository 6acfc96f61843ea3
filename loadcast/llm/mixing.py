"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate ``target rows / rows of the source``.
A document's copy count is the Poisson quantile, at its source's rate, of a
uniform number hashed from (seed, doc_id): the same document always gets the
same count, on any cluster and after any retry. Copies are exploded and dealt
to partitions by a hash of (seed, doc_id, copy), which shuffles the corpus
globally in one exchange without sampling it.

DataFrame functions only. The one table that is broadcast has a row per source
and is broadcast only when its row count is within ``broadcast_sources``; above
that, the join on source is salted, so that a source with a third of all rows
is spread over ``salts`` tasks.

Nulls and odd input: a null source is a source of its own; a null doc_id hashes
as ''; repeated rows are copied alike, each on its own; a source whose weight is
missing or not positive is dropped (rate 0); no rows give no rows. Columns of
the input are kept; ``copy``, ``n_copies``, ``rate`` and ``shuffle_key``
replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.llm.common import prepare, table

SEED = 17
OWN = ("copy", "n_copies", "rate", "shuffle_key")


def uniform(*parts) -> Column:
    """Number in [0, 1) from the md5 of the parts joined by ':' (52 bits)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None,
                 power: float = 0.5) -> DataFrame:
    """(source, rate): mean copies per document. ``weights`` has (source, weight);
    without it a source weighs its row count to the given power. The expected
    size of the mix is ``total`` rows, by default the size of the input."""
    n = docs.groupBy("source").agg(F.count("*").cast("double").alias("rows"))
    if weights is None:
        w = n.withColumn("weight", F.pow("rows", F.lit(float(power))))
    else:
        wt = weights.groupBy(F.col("source").alias("ws")).agg(F.sum("weight").cast("double").alias("weight"))
        w = n.join(wt, F.col("source").eqNullSafe(F.col("ws")), "left").drop("ws")
    w = w.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0))
    sums = w.agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).first()  # one row of totals
    weight = sums["weight"] or 0.0
    size = float((sums["rows"] or 0.0) if total is None else total)
    rate = F.lit(size) * F.col("weight") / F.lit(weight) / F.col("rows") if weight > 0 else F.lit(0.0)
    return w.select("source", rate.alias("rate"))


def with_cdf(rates: DataFrame) -> DataFrame:
    """(source, rate, cdf): array of P(X <= k) for k from 0 until the rest is below
    double precision; added up from log probabilities, so that large rates do not
    underflow, by running sums over a source's k."""
    top = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 24).cast("int")
    upto = W.partitionBy("source", "rate").orderBy("k")
    each = rates.withColumn("k", F.explode(F.sequence(F.lit(0), top)))
    logp = -F.col("rate") + F.coalesce(F.sum(F.when(F.col("k") > 0, F.log(F.col("rate") / F.col("k")))).over(upto), F.lit(0.0))
    cdf = F.sum(F.exp("logp")).over(upto)
    return (each.withColumn("logp", logp).select("source", "rate", cdf.alias("c"))
            .groupBy("source", "rate").agg(F.sort_array(F.collect_list("c")).alias("cdf")))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None,
                power: float = 0.5, seed: int = SEED, broadcast_sources: int = 20_000, salts: int = 64) -> DataFrame:
    """The documents replicated to the target mix and globally shuffled."""
    prepare(docs.sparkSession)
    docs = docs.drop(*OWN)
    # the row is kept as one value, so that its column names cannot clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").alias("mix_id"),
                       F.col("source").alias("mix_source"))
    rates = source_rates(docs, weights, total, power).filter("rate > 0")
    rates = with_cdf(rates).withColumnRenamed("source", "rate_source")
    same = F.col("mix_source").eqNullSafe(F.col("rate_source"))
    if rates.count() <= broadcast_sources:
        joined = rows.join(F.broadcast(rates), same)
    else:
        spread = rates.withColumn("rate_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("mix_id"), F.lit(salts)).cast("int"))
        joined = salted.join(spread, same & (F.col("salt") == F.col("rate_salt")))
    u = uniform(F.lit(seed), F.col("mix_id"))
    counted = joined.withColumn("n_copies", F.size(F.filter("cdf", lambda c: c <= u)).cast("long")).filter("n_copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("shuffle"), F.coalesce(F.col("mix_id").cast("string"), F.lit("")),
                            F.col("copy")))
    return (copies.select("row.*", F.round("rate", 9).alias("rate"), "n_copies", "copy", F.substring(key, 1, 16).alias("shuffle_key"))
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


def op6(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE = """
WITH n AS (SELECT source, count(*)::DOUBLE AS nrows FROM documents GROUP BY source),
t AS (SELECT sum(nrows) AS all_rows, sum(pow(nrows, 0.5)) AS all_weight FROM n),
r AS (SELECT source, all_rows * pow(nrows, 0.5) / all_weight / nrows AS lam FROM n, t),
logp AS (SELECT source, lam, k, -lam + coalesce(sum(CASE WHEN k > 0 THEN ln(lam / k) END)
           OVER (PARTITION BY source ORDER BY k), 0) AS lp
         FROM r, LATERAL (SELECT unnest(range(0, 1 + ceil(lam + 12 * sqrt(lam) + 24)::BIGINT)) AS k)),
cdf AS (SELECT source, lam, k, sum(exp(lp)) OVER (PARTITION BY source ORDER BY k) AS c FROM logp),
u AS (SELECT *, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
      FROM documents),
m AS (SELECT u.doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source,
             any_value(u.n_chars) AS n_chars, round(any_value(cdf.lam), 9) AS rate, count(*) AS n_copies
      FROM u JOIN cdf ON cdf.source IS NOT DISTINCT FROM u.source AND cdf.c <= u.u GROUP BY u.doc_id)
SELECT doc_id, text, lang, source, n_chars, rate, n_copies, copy,
       substr(md5('17:shuffle:' || doc_id || ':' || copy), 1, 16) AS shuffle_key
FROM m, LATERAL (SELECT unnest(range(0, n_copies)) AS copy)
"""

QUERIES = {"op6_mix_sources": op6}
ORACLES = {"op6_mix_sources": ORACLE}
