"""Sensor-reading sources: schema, CSV / text / Parquet / Kafka readers,
the adapter that turns the driver's ``events`` table into readings, and the
event-time rebase of the feed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_BROKERS, DEFAULT_TOPIC, VALUE_SCALE

# Column order = CSV column order of a reading.
SENSOR_COLUMNS = ("id", "timestamp", "value", "property", "plug_id", "household_id", "house_id")
SENSOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.LongType()),        # epoch seconds
    T.StructField("value", T.DoubleType()),
    T.StructField("property", T.IntegerType()),     # 0 = work, 1 = load
    T.StructField("plug_id", T.LongType()),
    T.StructField("household_id", T.LongType()),
    T.StructField("house_id", T.LongType()),
])
SENSOR_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SENSOR.fields)


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``event_time`` (TIMESTAMP) from epoch-second ``timestamp``."""
    return df.withColumn("event_time", F.timestamp_seconds("timestamp"))


def _all_present(s: Column) -> Column:
    cond = F.lit(True)
    for c in SENSOR_COLUMNS:
        cond = cond & s[c].isNotNull()
    return cond


def complete_struct(parsed: Column) -> Column:
    """Rows of a parsed-reading struct column that have all seven fields, as a
    generator: the parser runs once per line (a plain filter on the struct's
    fields would be pushed below the projection and re-parse per field)."""
    return F.explode(F.filter(F.array(parsed), _all_present)).alias("r")


def complete(df: DataFrame) -> DataFrame:
    """Keep a reading iff all seven fields parsed (a bad number or a short line
    leaves a NULL; extra tokens are ignored)."""
    cond = F.lit(True)
    for c in SENSOR_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond).select(*SENSOR_COLUMNS)


def counted(raw: DataFrame, counts: Observation | str) -> DataFrame:
    """Complete readings of a frame of the seven columns, counted on the way in the
    same pass: ``lines``, those ``dropped`` by :func:`complete`, and of the kept
    ones those whose value is no number that the sums take (``nan``, ``infinite``,
    ``too_large``). A batch job reads an :class:`Observation` after its first
    action; a stream reports the counts of each micro-batch in its progress, under
    the name given."""
    whole = F.lit(True)
    for c in SENSOR_COLUMNS:
        whole = whole & F.col(c).isNotNull()
    v = F.col("value")
    size = F.abs(v)
    seen = raw.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(~whole).alias("dropped"), F.count_if(whole & F.isnan(v)).alias("nan"),
                       F.count_if(whole & (size == float("inf"))).alias("infinite"),
                       F.count_if(whole & (size >= 10.0 ** (38 - VALUE_SCALE)) & (size < float("inf")) & ~F.isnan(v)).alias("too_large"))
    return complete(seen)


def _csv_options(mode: str) -> dict:
    # quote disabled: a field is never unquoted, as in a plain split on ','.
    return {"header": "false", "sep": ",", "quote": "", "mode": mode,
            "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE",
             min_partitions: int | None = None, counts: Observation | None = None) -> DataFrame:
    """Batch CSV (``.gz`` decoded by extension). A single ``.gz`` file is not
    splittable and arrives as one partition: ``min_partitions`` re-spreads it.
    ``counts`` as in :func:`counted`."""
    df = spark.read.schema(SENSOR).options(**_csv_options(mode)).csv(path)
    if counts is not None:
        df = counted(df, counts)
    elif mode != "FAILFAST":
        df = complete(df)
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_csv_stream(spark: SparkSession, path: str, max_files: int | None = None, counts: str | None = None) -> DataFrame:
    r = spark.readStream.schema(SENSOR).options(**_csv_options("PERMISSIVE"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return counted(r.csv(path), counts) if counts else complete(r.csv(path))


def parse_lines(lines: DataFrame, col: str = "value", counts: Observation | str | None = None) -> DataFrame:
    """Parse a column of CSV lines into readings (same rules as the file
    reader), e.g. Kafka values or text-file lines; dropped lines are those
    with a NULL field."""
    parsed = F.from_csv(F.col(col), SENSOR_DDL, _csv_options("PERMISSIVE"))
    if counts is not None:
        # generated, so that the parser runs once per line
        return counted(lines.select(F.explode(F.array(parsed)).alias("r")).select("r.*"), counts)
    return lines.select(complete_struct(parsed)).select("r.*")


def dropped_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row (lines, kept, dropped): how many lines the parser leaves out."""
    parsed = F.from_csv(F.col(col), SENSOR_DDL, _csv_options("PERMISSIVE"))
    # generated, so that the parser runs once per line
    kept = lines.select(F.size(F.filter(F.array(parsed), _all_present)).alias("kept"))
    return kept.agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept")) \
        .withColumn("dropped", F.col("lines") - F.col("kept"))


def read_text(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of text files as a ``value`` column."""
    return (spark.readStream if streaming else spark.read).text(path)


def read_parquet(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    if streaming:
        return complete(spark.readStream.schema(SENSOR).parquet(path))
    return complete(spark.read.parquet(path))


def decode_kafka(records: DataFrame) -> DataFrame:
    """Kafka ``value`` (JSON document of a reading) -> readings."""
    v = F.col("value").cast("string")
    return records.select(complete_struct(F.from_json(v, SENSOR))).select("r.*")


def read_kafka(spark: SparkSession, topic: str = DEFAULT_TOPIC,
               brokers: str = DEFAULT_BROKERS, streaming: bool = True,
               group_id: str | None = None) -> DataFrame:
    """Kafka source, always from the earliest offset. Needs the Kafka
    connector on the class path."""
    r = (spark.readStream if streaming else spark.read).format("kafka")
    r = (r.option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
         .option("startingOffsets", "earliest"))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return decode_kafka(r.load())


def load_sensor(spark: SparkSession, source: str = "kafka", path: str | None = None,
                streaming: bool = False, **kw) -> DataFrame:
    """Source chooser: ``kafka`` (default), ``csv``, ``parquet``, ``text``."""
    if source == "kafka":
        return read_kafka(spark, streaming=streaming, **kw)
    if source == "csv":
        return read_csv_stream(spark, path, **kw) if streaming else read_csv(spark, path, **kw)
    if source == "parquet":
        return read_parquet(spark, path, streaming=streaming)
    if source == "text":
        return parse_lines(read_text(spark, path, streaming=streaming), **kw)
    raise ValueError(f"unknown source {source!r}; expected kafka, csv, parquet or text")


def rebase_event_time(df: DataFrame, reference_instant: int) -> DataFrame:
    """Shift all timestamps so that the first reading is at
    ``reference_instant`` (epoch seconds). The offset comes from one global
    ``min`` (a single row, combined map-side) and is applied per row as a
    literal: no join, no shuffle of the readings."""
    first = df.agg(F.min("timestamp")).first()[0]
    if first is None:
        return df
    return df.withColumn("timestamp", F.col("timestamp") + F.lit(int(reference_instant) - int(first)))


# ---------------------------------------------------------------------------
# Test-data adapter: the driver's ``events`` table as sensor readings.
# Time is squeezed 60:1 so that 30-second panes hold several readings.
# ---------------------------------------------------------------------------
ADAPTER_EPOCH = 1704067200          # 2024-01-01T00:00:00Z
ADAPTER_SQUEEZE = 60
ADAPTER_LOAD_TYPES = ("click", "view")


def from_events(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    secs = "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"
    return events.select(
        F.col("event_id").alias("id"),
        F.expr(f"{ADAPTER_EPOCH} + {secs} div {ADAPTER_SQUEEZE}").alias("timestamp"),
        F.col("value").cast("double").alias("value"),
        F.when(F.col("event_type").isin(*ADAPTER_LOAD_TYPES), 1).otherwise(0).cast("int").alias("property"),
        (F.expr("user_id div 20") % 5).alias("plug_id"),
        (F.expr("user_id div 10") % 2).alias("household_id"),
        (uid % 10).alias("house_id"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sensor_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(read_events(spark, sf_dir))


ADAPTER_SQL = f"""
SELECT event_id AS id,
       {ADAPTER_EPOCH} + date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) // {ADAPTER_SQUEEZE} AS timestamp,
       CAST(value AS DOUBLE) AS value,
       CAST(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS INTEGER) AS property,
       (user_id // 20) % 5 AS plug_id,
       (user_id // 10) % 2 AS household_id,
       user_id % 10 AS house_id
FROM events"""
