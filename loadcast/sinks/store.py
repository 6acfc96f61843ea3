"""Sinks: the store of panes and averages, prediction / raw documents, Kafka
records and debug dumps. The store of batch runs is in :mod:`.runs`; here is that
of a stream::

    panes/entity=E/day=D/run=R       30-second panes, by the micro-batch
    averages/entity=E/window_minutes=M/day=D/batch_id=B

Days are days of panes (UTC); a reader names the days it needs, so old days are
neither listed nor read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_BROKERS, DEFAULT_TOPIC, RAW_DOC_TYPE, SLIDE_SECONDS, Entity
from ..functions.docs import prediction_json, raw_json
from ..operators.presum import floordiv
from ..session import scratch_path

DOC_TYPE_PREFIX = "prediction_"
STORE_PARTITIONS = ("entity", "window_minutes")
STORE_COLS = ["entity", "window_minutes", "house_id", "household_id", "plug_id", "window_start",
              "window_end", "sum", "count", "event_timestamp", "avg"]
DAY_PANES = 86400 // SLIDE_SECONDS
FILES_PER_DAY = 8
FILE_FORMATS = ("json", "parquet", "orc")


def pane_dir(store: str, entity: Entity) -> str:
    return f"{store}/panes/entity={entity.name}"


def averages_dir(store: str) -> str:
    return f"{store}/averages"


def _replace(df: DataFrame, path: str, parts: list[str], fmt: str = "parquet") -> None:
    """Replace the partitions that ``df`` has rows of."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
     .partitionBy(*parts).save(path))


def write_panes(panes: DataFrame, store: str, entity: Entity, run: str) -> None:
    rows = panes.withColumn("day", floordiv("pos", DAY_PANES)).withColumn("run", F.lit(run))
    _replace(rows, pane_dir(store, entity), ["day", "run"])


def read_panes(spark: SparkSession, store: str, entity: Entity, first: int, last: int) -> DataFrame:
    """Panes ``first`` to ``last`` of all runs, one row per key and pane. Only the
    directories of these days are listed; at least one of them must exist."""
    root = pane_dir(store, entity)
    days = ",".join(str(d) for d in range(first // DAY_PANES, last // DAY_PANES + 1))
    rows = spark.read.option("basePath", root).parquet(f"{root}/day={{{days}}}")
    return (rows.where(F.col("pos").between(first, last)).groupBy(*entity.key_cols, "pos")
            .agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("t").alias("t")))


def with_day(rows: DataFrame) -> DataFrame:
    """Add the day of the window's last pane."""
    return rows.withColumn("day", floordiv(f"window_end div {SLIDE_SECONDS} - 1", DAY_PANES))


def spread_by_day(rows: DataFrame, files: int = FILES_PER_DAY) -> DataFrame:
    """Deal rows so that a day of one window length goes to ``files`` tasks."""
    slot = F.pmod(F.xxhash64("house_id", "household_id", "plug_id"), F.lit(files))
    return rows.repartition("window_minutes", "day", slot)


def replace_averages(rows: DataFrame, store: str, batch_id: int | None = None) -> None:
    """Store the averages of whole days (or of one micro-batch), in place of what
    is there for them."""
    parts = [*STORE_PARTITIONS, "day"]
    out = spread_by_day(with_day(rows.select(*STORE_COLS)))
    if batch_id is not None:
        out, parts = out.withColumn("batch_id", F.lit(batch_id)), [*parts, "batch_id"]
    _replace(out, averages_dir(store), parts)


def write_averages(averages: DataFrame, path: str, mode: str = "append",
                   sort_by_value: bool = False) -> None:
    """Averages table: Parquet partitioned by ``(entity, window_minutes)`` so
    a lookup of one entity and window length prunes to one directory.
    ``sort_by_value`` range-partitions by ``(entity, window_minutes, avg)``
    and sorts each task's rows: files of one directory then hold disjoint,
    ordered ``avg`` ranges (selective min/max statistics), and one window
    length is spread over many tasks instead of one. The averages are written
    once before, as range partitioning reads its input twice."""
    df = averages
    if sort_by_value:
        staged = scratch_path(df.sparkSession, "unsorted")
        df.write.parquet(staged)
        df = df.sparkSession.read.schema(df.schema).parquet(staged)
        df = df.repartitionByRange(*STORE_PARTITIONS, "avg").sortWithinPartitions(*STORE_PARTITIONS, "avg")
    df.write.mode(mode).partitionBy(*STORE_PARTITIONS).parquet(path)


def read_averages(spark: SparkSession, path: str, entity: str | None = None,
                  minutes: int | None = None, since: int | None = None) -> DataFrame:
    """Read an averages table; the entity / window filters prune partitions and
    the ``window_end`` bound prunes days (where the table has them) and is pushed
    into the Parquet scan."""
    df = spark.read.parquet(path)
    if entity is not None:
        df = df.where(F.col("entity") == entity)
    if minutes is not None:
        df = df.where(F.col("window_minutes") == minutes)
    if since is not None:
        df = df.where(F.col("window_end") >= since)
        if "day" in df.columns:
            df = df.where(F.col("day") >= (since // SLIDE_SECONDS - 1) // DAY_PANES)
    return df


def retain(df: DataFrame, now_s: int, extra_s: int = 5) -> DataFrame:
    """Averages still alive at ``now_s``: a window length plus ``extra_s`` after
    their window's end."""
    return df.where(F.col("window_end") >= F.lit(now_s - extra_s) - F.col("window_minutes") * 60)


def compact(spark: SparkSession, src: str | DataFrame, dst: str, now_s: int | None = None,
            keep_since: int | None = None) -> int:
    """Copy an averages table (a path, or rows) into ``dst`` with few key-ordered
    files per day and without micro-batch directories; with ``now_s`` only averages that
    :func:`retain` keeps, with ``keep_since`` only windows that end from then on.
    Returns the number of rows written."""
    if isinstance(src, str) and dst.rstrip("/") == src.rstrip("/"):
        raise ValueError("compact into a new location, then swap")
    df = spark.read.parquet(src) if isinstance(src, str) else src
    if now_s is not None:
        df = retain(df, now_s)
    if keep_since is not None:
        df = df.where(F.col("window_end") >= F.lit(keep_since))
    out = with_day(df.select(*STORE_COLS))
    (spread_by_day(out).sortWithinPartitions("house_id", "household_id", "plug_id", "window_end")
     .write.mode("overwrite").partitionBy(*STORE_PARTITIONS, "day").parquet(dst))
    return spark.read.parquet(dst).count()


# ------------------------------------------------------------------ documents

def prediction_documents(predictions: DataFrame, now_ms: int | None = None) -> DataFrame:
    """One JSON document per prediction with a deterministic id (hash of the
    unique key), so a replayed write replaces instead of duplicating."""
    doc_id = F.sha2(F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                       for c in ("entity", "window_minutes", "house_id",
                                                 "household_id", "plug_id", "window_end")]), 256)
    doc_type = F.concat(F.lit(DOC_TYPE_PREFIX), F.col("window_minutes").cast("string"), F.lit("min"))
    return with_day(predictions).select(
        *STORE_PARTITIONS, "day", doc_id.alias("doc_id"), doc_type.alias("doc_type"), prediction_json(now_ms).alias("value"))


def raw_documents(readings: DataFrame) -> DataFrame:
    """One JSON document per (pre-summed) reading, with a deterministic id."""
    key = F.concat_ws("/", F.col("timestamp"), *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                 for c in ("house_id", "household_id", "plug_id", "id")])
    return readings.select(F.sha2(key, 256).alias("doc_id"), F.lit(RAW_DOC_TYPE).alias("doc_type"), raw_json().alias("value"))


def write_documents(docs: DataFrame, path: str, fmt: str = "json", options: dict | None = None,
                    batch_id: int | None = None) -> None:
    """Documents (id, type, body) in the given format. File formats are
    partitioned by entity, window length and day where the documents have them,
    and replaced by partition; any other format on the class path (a document
    store's connector) gets the rows to add."""
    if fmt in FILE_FORMATS:
        parts = [c for c in (*STORE_PARTITIONS, "day") if c in docs.columns]
        if batch_id is not None:
            docs, parts = docs.withColumn("batch_id", F.lit(batch_id)), [*parts, "batch_id"]
        if parts:
            _replace(docs, path, parts, fmt)
        else:
            docs.write.mode("overwrite").format(fmt).save(path)
    else:
        docs.write.format(fmt).options(**(options or {})).mode("append").save(path)


# --------------------------------------------------------------------- others

def kafka_records(readings: DataFrame, key_col: str = "house_id") -> DataFrame:
    """Readings as Kafka ``(key, value)`` records (JSON value)."""
    return readings.select(F.col(key_col).cast("string").alias("key"), raw_json().alias("value"))


def write_kafka(records: DataFrame, topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS) -> None:
    (records.write.format("kafka").option("kafka.bootstrap.servers", brokers)
     .option("topic", topic).save())


def debug_dump(df: DataFrame, debug_dir: str | None, stage: str) -> None:
    """Per-stage CSV dump behind a ``debug_dir`` option."""
    if debug_dir:
        df.write.mode("overwrite").option("header", "true").csv(f"{debug_dir}/{stage}")
