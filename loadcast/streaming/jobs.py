"""Structured Streaming versions of the feed and averaging jobs.

The averaging stream is ONE append-mode query with one watermarked aggregate:
30-second panes per key. The 10-second watermark closes panes; late rows for
closed panes are dropped (and counted in the query progress as
``numRowsDroppedByWatermark``). Everything above the panes runs in
``foreachBatch`` on the batch plan: the closed panes go into the store, and all
levels' averages, medians and predictions of the window ends that the batch has
completed are computed in one pass of the cascade over the stored panes they
reach back to (look-back of the deepest level plus retention: a bounded tail,
read from the days it lies in).

A window end is complete once a pane at or after it has closed, for any key:
panes close in order of the watermark, so all earlier panes have closed too.
How far a batch came is written beside the store under its batch id. A replayed
batch finds what its predecessor left, and overwrites its own panes, averages
and documents: results are idempotent.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import (DEFAULT_BROKERS, DEFAULT_OPTIONS, DEFAULT_TOPIC, LEVEL_MINUTES, SLIDE_SECONDS,
                      WATERMARK_DELAY, Entity, Options)
from ..operators.presum import from_units, restrict, with_units
from ..plans.pipeline import as_predictions, reach, windows_from_panes
from ..session import conf_override
from ..sinks.store import (debug_dump, prediction_documents, raw_documents, read_panes, replace_averages, write_documents,
                           write_panes)
from ..sources.sensor import SENSOR_COLUMNS, with_event_time
from .cascade import stream_windows
from .rolling import ROCKSDB

PANE = f"{SLIDE_SECONDS} seconds"


def watermarked(readings: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event time from epoch seconds plus the bounded-disorder watermark."""
    return with_event_time(readings).withWatermark("event_time", delay)


def stream_seconds(readings: DataFrame, entity: Entity, options: Options = DEFAULT_OPTIONS,
                   delay: str = WATERMARK_DELAY) -> DataFrame:
    """The pre-sum of a stream as readings, each second once it has closed (each
    reading at once where there is no final pre-sum)."""
    rows = watermarked(readings, delay)
    if options.presum == "rolling":
        from .rolling import rolling_presum
        return rolling_presum(rows, entity, options).select(*SENSOR_COLUMNS)
    rows = with_units(restrict(rows, options), options.value_scale)
    if options.presum == "final":
        by = [*entity.presum_cols, "event_time"]
        kept = [c for c in SENSOR_COLUMNS if c not in (*entity.presum_cols, "id", "timestamp", "value")]
        rows = rows.groupBy(*by).agg(from_units(F.sum("u")).alias("value"), F.min("id").alias("id"),
                                     *[F.min_by(c, "id").alias(c) for c in kept])
        rows = rows.withColumn("timestamp", F.unix_seconds("event_time"))
    return rows.select(*SENSOR_COLUMNS)


def stream_panes(readings: DataFrame, entity: Entity, options: Options = DEFAULT_OPTIONS,
                 delay: str = WATERMARK_DELAY, timed: bool = False) -> DataFrame:
    """Closed panes ``(key, pos, s, c, t)``, ``timed`` with their event time, of a stream of readings: one
    aggregate where the pre-sum key is the window key (see
    :func:`~loadcast.operators.presum.panes_of_seconds`), else pre-sum, then
    panes. The rolling pre-sum is a stateful processor (:mod:`.rolling`)."""
    rows = watermarked(readings, delay)
    window = F.window("event_time", PANE).alias("window")
    latest = F.max("timestamp").alias("t")
    if options.presum == "rolling":
        from .rolling import rolling_presum
        rows = rolling_presum(rows, entity, options)
    else:
        rows = with_units(restrict(rows, options), options.value_scale)
    if options.presum == "final" and entity.presum_cols == entity.key_cols:
        second = F.expr(f"shiftleft(1, cast(pmod(timestamp, {SLIDE_SECONDS}) as int))")
        count = F.bit_count(F.bit_or(second)).cast("long").alias("c")
    else:
        count = F.count(F.lit(1)).alias("c")
        if options.presum == "final":
            rows = (rows.groupBy(*entity.presum_cols, "event_time")
                    .agg(F.sum("u").alias("u"), F.max("timestamp").alias("timestamp"),
                         *[F.min_by(c, "id").alias(c) for c in entity.key_cols if c not in entity.presum_cols]))
        elif options.presum not in ("none", "rolling"):
            raise ValueError(f"unknown presum mode {options.presum!r}")
    panes = rows.groupBy(window, *entity.key_cols).agg(F.sum("u").alias("s"), count, latest)
    pos = F.expr(f"unix_seconds(window.start) div {SLIDE_SECONDS}")
    return panes.select(*entity.key_cols, pos.alias("pos"), "s", "c", "t", *([F.window_time("window").alias("event_time")] if timed else []))


def _progress_dir(store: str, entity: Entity, batch_id: int) -> str:
    return f"{store}/progress/entity={entity.name}/batch_id={batch_id}"


def last_complete(spark: SparkSession, store: str, entity: Entity, batch_id: int) -> int | None:
    """Last pane up to which windows were complete after a batch."""
    if batch_id < 0:
        return None
    try:
        return spark.read.schema("pos long").parquet(_progress_dir(store, entity, batch_id)).first()["pos"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def process_batch(panes: DataFrame, batch_id: int, entity: Entity, store: str, docs: str | None,
                  options: Options = DEFAULT_OPTIONS, levels: tuple[int, ...] = LEVEL_MINUTES,
                  now_ms: int | None = None, doc_format: str = "json", debug_dir: str | None = None) -> None:
    """Store a micro-batch of closed panes, then the averages and predictions of
    the windows that it completes."""
    spark = panes.sparkSession
    panes = panes.persist()
    dump = lambda df, stage: debug_dump(df, debug_dir, f"{entity.slug}/{stage}/batch_id={batch_id}")
    try:
        seen = panes.agg(F.min("pos").alias("first"), F.max("pos").alias("last")).first()
        before = last_complete(spark, store, entity, batch_id - 1)
        if seen["last"] is not None:
            write_panes(panes, store, entity, f"batch{batch_id}")
            dump(panes, "panes")
        done = max((x for x in (before, seen["last"]) if x is not None), default=None)
        (spark.range(1).select(F.lit(done).cast("long").alias("pos"))
         .write.mode("overwrite").parquet(_progress_dir(store, entity, batch_id)))
    finally:
        panes.unpersist()
    if done is None or done == before:
        return
    first = seen["first"] if before is None else before + 1
    back = reach(levels, options)[0] if options.retention else first
    rows = windows_from_panes(read_panes(spark, store, entity, max(first - back, 0), done), entity, levels, options, first, done)
    rows = as_predictions(rows, entity).persist()
    try:
        replace_averages(rows, store, batch_id)
        dump(rows.drop("median_load", "sliding_window_ms", "predicted_value"), "averages")
        dump(rows.drop("sliding_window_ms", "predicted_value"), "enriched")
        dump(rows, "predictions")
        if docs:
            write_documents(prediction_documents(rows, now_ms), docs, doc_format, batch_id=batch_id)
    finally:
        rows.unpersist()


def write_windows(rows: DataFrame, batch_id: int, entity: Entity, store: str, docs: str | None,
                  now_ms: int | None = None, doc_format: str = "json", debug_dir: str | None = None) -> None:
    """Store and publish the windows of a micro-batch, in place of what an earlier
    attempt of the batch wrote."""
    dump = lambda df, stage: debug_dump(df, debug_dir, f"{entity.slug}/{stage}/batch_id={batch_id}")
    rows = as_predictions(rows, entity).persist()
    try:
        if not rows.isEmpty():
            replace_averages(rows, store, batch_id)
            if docs:
                write_documents(prediction_documents(rows, now_ms), docs, doc_format, batch_id=batch_id)
        dump(rows.drop("median_load", "sliding_window_ms", "predicted_value"), "averages")
        dump(rows.drop("sliding_window_ms", "predicted_value"), "enriched")
        dump(rows, "predictions")
    finally:
        rows.unpersist()


def write_seconds(seconds: DataFrame, batch_id: int, entity: Entity, raw: str | None, debug_dir: str | None,
                  doc_format: str = "json") -> None:
    """Raw documents and debug dump of a micro-batch of the pre-sum, in place of
    what an earlier attempt of the batch wrote."""
    seconds = seconds.persist()
    try:
        if raw and not seconds.isEmpty():
            write_documents(raw_documents(seconds), raw, doc_format, batch_id=batch_id)
        debug_dump(seconds, debug_dir, f"{entity.slug}/presum/batch_id={batch_id}")
    finally:
        seconds.unpersist()


def start_averaging_job(spark: SparkSession, readings: DataFrame, entity: Entity, store_path: str,
                        docs_path: str | None, checkpoint: str, options: Options = DEFAULT_OPTIONS,
                        levels: tuple[int, ...] = LEVEL_MINUTES, trigger: dict | None = None,
                        now_ms: int | None = None, state_partitions: int | None = None,
                        doc_format: str = "json", raw_path: str | None = None,
                        debug_dir: str | None = None) -> list[StreamingQuery]:
    """House or plug averaging job: stream -> panes -> store -> averages, medians
    and documents of all levels. One query, which reads the source once; a second
    one where raw documents or debug dumps of the pre-sum are wanted."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, entity, store_path, docs_path, options, levels, now_ms, doc_format, debug_dir)

    def per_seconds(batch: DataFrame, batch_id: int) -> None:
        write_seconds(batch, batch_id, entity, raw_path, debug_dir, doc_format)

    def per_windows(batch: DataFrame, batch_id: int) -> None:
        write_windows(batch, batch_id, entity, store_path, docs_path, now_ms, doc_format, debug_dir)

    def per_panes(batch: DataFrame, batch_id: int) -> None:
        debug_dump(batch, debug_dir, f"{entity.slug}/panes/batch_id={batch_id}")

    if options.retention:  # all that a window or median looks back over is keyed state
        windows = stream_windows(stream_panes(readings, entity, options, timed=True), entity, levels, options)
        parts = [(windows, entity.slug, per_windows)]
        if debug_dir:
            parts.append((stream_panes(readings, entity, options), f"{entity.slug}-panes", per_panes))
    else:
        parts = [(stream_panes(readings, entity, options), entity.slug, per_batch)]
    if raw_path or debug_dir:
        parts.append((stream_seconds(readings, entity, options), f"{entity.slug}-raw", per_seconds))
    # State-store partitions of a query are fixed at its first start (and kept in
    # the checkpoint); size them to the stream, not to the batch shuffle setting,
    # when given.
    conf = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with conf_override(spark, conf | {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        return [rows.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint}/{name}")
                .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()
                for rows, name, write in parts]


class StreamCounts(StreamingQueryListener):
    """Adds up what a stream of :func:`~loadcast.sources.sensor.counted` readings
    reports: lines, dropped and unfit ones, and rows late for their pane, by query.
    Register it with ``spark.streams.addListener``."""

    def __init__(self, name: str = "readings"):
        self.name, self.by_query = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        mine = self.by_query.setdefault(str(p.id), {"late": 0})
        mine["late"] += sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
        for k, v in (p.observedMetrics.get(self.name) or Row()).asDict().items() if p.observedMetrics else ():
            mine[k] = mine.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


# --------------------------------------------------------------------- feed job
def feed(readings: DataFrame, rebase_offset_s: int | None = None) -> DataFrame:
    """Readings as Kafka records (key = house, value = JSON reading),
    optionally shifted in time by a fixed offset."""
    if rebase_offset_s:
        readings = readings.withColumn("timestamp", F.col("timestamp") + F.lit(rebase_offset_s))
    return readings.select(F.col("house_id").cast("string").alias("key"),
                           F.to_json(F.struct(*[F.col(c) for c in SENSOR_COLUMNS])).alias("value"))


def start_feed_job(readings: DataFrame, checkpoint: str, sink: str = "kafka", path: str | None = None,
                   topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS,
                   rebase_offset_s: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """CSV/Parquet stream -> JSON records -> Kafka topic, or JSON lines under
    ``path`` (``sink="text"``)."""
    recs = feed(readings, rebase_offset_s)
    if sink == "kafka":
        w = (recs.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
             .option("topic", topic))
    elif sink == "text":
        w = recs.select("value").writeStream.format("text").option("path", path)
    else:
        raise ValueError(f"unknown feed sink {sink!r}")
    return (w.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
