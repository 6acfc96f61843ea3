"""Spark-side helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.session import configure, shared_dir

# Arrow batches are bounded by bytes as well as by rows, so that a run of very
# long texts does not fill a Python worker.
ARROW_BATCH_BYTES = 4 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, batch_bytes: int = ARROW_BATCH_BYTES) -> SparkSession:
    """Session settings that an operator relies on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    return _ready(spark)


def _ready(spark: SparkSession) -> SparkSession:
    """Shared folder and import path of the Python workers."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    # Python workers find the package also when the driver was started elsewhere
    # (a cluster without this path gets the package by --py-files)
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in path:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, path)])
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    _ready(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder: for larger
    intermediates, as it is compressed, read by column and of known size."""
    spark = _ready(df.sparkSession)
    path = shared_path(spark, "tables", uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def typed(df: DataFrame, *columns: str) -> DataFrame:
    """The given columns ("name type"), cast only where the type differs, so that
    equal selections stay equal plans and can share a shuffle."""
    have = dict(df.dtypes)
    kinds = {"long": "bigint"}
    return df.select(*[F.col(n) if have.get(n) == kinds.get(t, t) else F.col(n).cast(t).alias(n)
                       for n, t in (c.split() for c in columns)])


def free_name(name: str, taken) -> str:
    """The name, with underscores before it until it is none of those taken."""
    while name in taken:
        name = "_" + name
    return name


def slot(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor`` (null counts as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def shared_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(shared_dir(spark), *parts)


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of an undirected graph.

    ``edges`` has long columns (a, b). Alternating large-star and small-star
    steps: each node's neighbours are re-linked to its smallest neighbour, with
    ``min`` aggregates that combine before the shuffle, so a hub with very many
    neighbours is not gathered anywhere. Ends when no edge changes. Returns
    (id, component_id) for every node that has an edge; self loops are ignored.
    """
    both = edges.filter("a is not null and b is not null and a <> b")
    cur = cut(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        # large-star: every neighbour above a node links to the node's minimum
        sym = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (sym.join(low, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
        # small-star: every neighbour below, and the node itself, link to the minimum;
        # a hub is the smaller end by now, so dealing by the larger one is even
        large = large.repartition("a")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        j = large.join(low, "a")
        small = (j.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(j.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        cur = cut(small)
        state = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == last:
            break
        last = (state["n"], state["h"])
    nodes = cur.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    roots = cur.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return nodes.union(roots)
