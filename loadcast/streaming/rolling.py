"""Rolling pre-sum on a stream (the as-executed pre-sum, option Q3).

The original streaming job summed readings with a keyed, non-windowed
running sum: every reading produced one record carrying the running total of
its (key, second) group so far, other fields taken from the group's first
reading. SQL window functions are not allowed on streams, so this is an
arbitrary stateful operator: ``transformWithStateInPandas`` keyed by
(key, 30-second pane), so that one call handles a pane's readings. The state maps
each open second to its running total and first reading's fields; an event-time
timer at the end of the pane drops it once the watermark has passed (later
readings of that pane are late and dropped by the watermark anyway). Within a
micro-batch readings are taken in ``id`` order, matching the batch operator.
"""

from __future__ import annotations

import sys
from decimal import Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import SLIDE_SECONDS, Entity, Options
from ..operators.presum import floordiv, from_units, restrict, units_type, with_units
from ..sources.sensor import SENSOR_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTPUT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("timestamp", T.LongType()),
    T.StructField("property", T.IntegerType()),
    T.StructField("plug_id", T.LongType()), T.StructField("household_id", T.LongType()),
    T.StructField("house_id", T.LongType()), T.StructField("units", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])
_KEPT = ("property", "plug_id", "household_id", "house_id")
SECOND = T.StructType([T.StructField("timestamp", T.LongType())])
# Totals are decimals, kept as text so that no digit is lost on the way.
STATE = T.StructType([T.StructField("total", T.StringType())] +
                     [T.StructField(c, OUTPUT[c].dataType) for c in _KEPT])
PANE_COL = "_pane"


class RollingPresum(StatefulProcessor):
    """Running total per (key, second), first reading's fields kept."""

    def __init__(self, key_cols: tuple[str, ...]):
        self.key_cols = key_cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getMapState("seconds", SECOND, STATE)

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("id", kind="stable")
        if not self.seconds.exists():
            end = (int(pdf["timestamp"].iloc[0]) // SLIDE_SECONDS + 1) * SLIDE_SECONDS
            self.handle.registerTimer(end * 1000)
        parts = []
        for second, own in pdf.groupby("timestamp", sort=True):
            at = (int(second),)
            if self.seconds.containsKey(at):
                st = self.seconds.getValue(at)
                total, first = Decimal(st[0]), dict(zip(_KEPT, st[1:]))
            else:
                total, first = Decimal(0), {c: own[c].iloc[0] for c in _KEPT}
            sums = []
            for u in own["units"]:
                total += Decimal(u)
                sums.append(str(total))
            out = pd.DataFrame({"id": own["id"].astype("int64"), "timestamp": own["timestamp"].astype("int64")})
            for c in _KEPT:
                out[c] = own[c].to_numpy() if c in self.key_cols else first[c]
            out["units"] = sums
            out["event_time"] = pd.to_datetime(out["timestamp"], unit="s")
            parts.append(out)
            self.seconds.updateValue(at, (str(total),) + tuple(None if pd.isna(first[c]) else int(first[c]) for c in _KEPT))
        yield pd.concat(parts, ignore_index=True)[[f.name for f in OUTPUT.fields]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seconds.clear()
        yield pd.DataFrame({f.name: pd.Series(dtype="object") for f in OUTPUT.fields})

    def close(self) -> None:
        pass


def rolling_presum(watermarked_readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    """Streaming rolling pre-sum; input must carry ``event_time`` with a
    watermark. Needs the RocksDB state store provider (set it with
    :func:`enable_state_store` before starting the query)."""
    df = with_units(restrict(watermarked_readings, options), options.value_scale)
    df = df.select(*[c for c in SENSOR_COLUMNS if c != "value"], F.col("u").cast("string").alias("units"), "event_time",
                   floordiv("timestamp", SLIDE_SECONDS).alias(PANE_COL))
    out = (df.groupBy(*entity.presum_cols, PANE_COL)
           .transformWithStateInPandas(RollingPresum(entity.key_cols), OUTPUT, "append", "EventTime",
                                       eventTimeColumnName="event_time"))
    u = F.col("units").cast(units_type(options.value_scale))
    return out.select(*[c for c in SENSOR_COLUMNS if c != "value"], from_units(u).alias("value"), u.alias("u"), "event_time")


def enable_state_store(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
