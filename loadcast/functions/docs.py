"""JSON documents of readings and predictions, and their parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sensor import SENSOR, SENSOR_COLUMNS


def raw_json() -> Column:
    """A reading as ``{id,timestamp,value,property,plug_id,household_id,house_id}``."""
    return F.to_json(F.struct(*[F.col(c) for c in SENSOR_COLUMNS]))


def key_json_struct(key_cols=("house_id", "household_id", "plug_id")) -> list[Column]:
    # NULL (absent) parts are dropped by to_json (ignoreNullFields).
    return [F.col(c) for c in key_cols]


def prediction_struct(now_ms: Column | int | None = None) -> Column:
    """Nested prediction document. ``now_ms`` is the wall-clock stamp; pass
    a fixed value for reproducible output (default: current time)."""
    now = F.expr("unix_millis(current_timestamp())") if now_ms is None else (
        now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("long"))
    return F.struct(
        F.struct(*key_json_struct(), F.col("sum"), F.col("count"), F.col("avg"),
                 F.col("event_timestamp").alias("eventTimestamp")).alias("averageWithKey"),
        F.struct(F.col("median_load").alias("load")).alias("medianLoad"),
        F.col("entity").alias("key"),
        F.col("sliding_window_ms").alias("slidingWindowDuration"),
        F.col("predicted_value").alias("predictedValue"),
        now.alias("timestamp"))


def prediction_json(now_ms: Column | int | None = None) -> Column:
    return F.to_json(prediction_struct(now_ms))


PREDICTION_DOC = T.StructType([
    T.StructField("averageWithKey", T.StructType([
        T.StructField("house_id", T.LongType()),
        T.StructField("household_id", T.LongType()),
        T.StructField("plug_id", T.LongType()),
        T.StructField("sum", T.DoubleType()),
        T.StructField("count", T.LongType()),
        T.StructField("avg", T.DoubleType()),
        T.StructField("eventTimestamp", T.LongType()),
    ])),
    T.StructField("medianLoad", T.StructType([T.StructField("load", T.DoubleType())])),
    T.StructField("key", T.StringType()),
    T.StructField("slidingWindowDuration", T.LongType()),
    T.StructField("predictedValue", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])


def parse_prediction(docs: DataFrame, col: str = "value") -> DataFrame:
    """Prediction documents back to flat columns."""
    d = F.from_json(F.col(col), PREDICTION_DOC)
    return docs.select(d.alias("d")).select(
        "d.averageWithKey.house_id", "d.averageWithKey.household_id", "d.averageWithKey.plug_id",
        F.col("d.averageWithKey.sum").alias("sum"), F.col("d.averageWithKey.count").alias("count"),
        F.col("d.averageWithKey.avg").alias("avg"),
        F.col("d.averageWithKey.eventTimestamp").alias("event_timestamp"),
        F.col("d.medianLoad.load").alias("median_load"), F.col("d.key").alias("entity"),
        F.col("d.slidingWindowDuration").alias("sliding_window_ms"),
        F.col("d.predictedValue").alias("predicted_value"), F.col("d.timestamp").alias("timestamp"))


def parse_raw(docs: DataFrame, col: str = "value") -> DataFrame:
    return docs.select(F.from_json(F.col(col), SENSOR).alias("r")).select("r.*")
