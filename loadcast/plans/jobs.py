"""Jobs and their command line: feed, house averaging, plug averaging; batch or
streaming.

    python -m loadcast.plans.jobs house --source csv --path data/*.csv.gz \\
        --store /shared/averages --docs /shared/predictions
    python -m loadcast.plans.jobs plug --streaming --store /shared/s --docs /shared/p --checkpoint /shared/c
    python -m loadcast.plans.jobs feed --source csv --path data.csv.gz --sink text --out /shared/feed

A batch run adds its readings' panes to the store and recomputes the averages,
medians and predictions of every day that they can change, from the panes of
all runs: the first windows of a run read the stored tail of earlier ones
(look-back of the cascade and retention of the medians), and later stored windows
that now see new data are replaced. Readings that are stored already change
nothing, whatever run brings them, and a run becomes visible as a whole
(:mod:`loadcast.sinks.runs`).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import (DEFAULT_BROKERS, DEFAULT_TOPIC, HOUSE, LEVEL_MINUTES, PLUG, PLUG_AS_WRITTEN,
                      Entity, Options)
from ..operators.presum import presum
from ..session import build_session, configure, scratch_path, shared_dir
from ..sinks.runs import Snapshot, Store, add_run, drop_partitions
from ..sinks.store import (DAY_PANES, FILE_FORMATS, debug_dump, kafka_records, prediction_documents, raw_documents, with_day,
                           write_documents, write_kafka)
from ..sources.sensor import SENSOR_COLUMNS, load_sensor, rebase_event_time
from .pipeline import as_predictions, reach, windows_from_panes


def days_to_compute(changed: tuple[int, ...], before: Snapshot, after: Snapshot, levels: tuple[int, ...],
                    options: Options) -> tuple[list[int], list[int] | None]:
    """Days whose averages a change of the panes of some days can alter, and the
    days whose panes they are computed from (None: all)."""
    back, ahead = reach(levels, options)
    if not options.retention:  # every later median sees all history
        ends = [r.last for s in (before, after) for r in s.runs.values() if r.last is not None]
        return list(range(changed[0], (max(ends) + ahead) // DAY_PANES + 1)), None
    later = sorted({x for d in changed for x in range(d, ((d + 1) * DAY_PANES - 1 + ahead) // DAY_PANES + 1)})
    return later, sorted({x for d in later for x in range((d * DAY_PANES - back) // DAY_PANES, d + 1)})


def averaging_job(spark: SparkSession, readings: DataFrame, entity: Entity, store_path: str | None,
                  docs_path: str | None, options: Options = Options(),
                  levels: tuple[int, ...] = LEVEL_MINUTES, now_ms: int | None = None,
                  debug_dir: str | None = None, run_id: str | None = None, raw_path: str | None = None,
                  doc_format: str = "json", doc_options: dict | None = None, track_ids: bool = True) -> dict[int, int]:
    """Run the averaging job on the readings; returns the number of averages per
    level that it wrote. ``run_id`` names the run in the store: a run of that name
    is replaced, any other adds to the store what it has not yet. ``track_ids`` as
    in :func:`~loadcast.sinks.runs.add_run`."""
    configure(spark)
    store = Store(spark, store_path or scratch_path(spark, "store"), entity)
    name = entity.slug
    if raw_path or debug_dir:
        seconds = presum(readings, entity, options).select(*SENSOR_COLUMNS)
        debug_dump(seconds, debug_dir, f"{name}/presum")
        if raw_path:
            write_documents(raw_documents(seconds), raw_path, doc_format, doc_options)
    added = add_run(store, readings, options, run_id, track_ids)
    if not added.changed:
        store.commit(added.base, [added.run_row])
        return {m: 0 for m in levels}
    days, needed = days_to_compute(added.changed, added.base, added.after, levels, options)
    panes = store.read_panes(options, added.after, needed)
    debug_dump(panes, debug_dir, f"{name}/panes")
    rows = windows_from_panes(panes, entity, levels, options, days[0] * DAY_PANES, (days[-1] + 1) * DAY_PANES - 1)
    rows = as_predictions(with_day(rows).where(F.col("day").isin(days)).drop("day"), entity).persist()
    try:
        written = with_day(rows).groupBy("window_minutes", "day").count().collect()  # a row per level and day
        store.write_averages(rows, added.generation)
        debug_dump(rows.drop("median_load", "sliding_window_ms", "predicted_value"), debug_dir, f"{name}/averages")
        debug_dump(rows.drop("sliding_window_ms", "predicted_value"), debug_dir, f"{name}/enriched")
        debug_dump(rows, debug_dir, f"{name}/predictions")
        if docs_path:
            write_documents(prediction_documents(rows, now_ms), docs_path, doc_format, doc_options)
            if doc_format in FILE_FORMATS:
                drop_partitions(spark, docs_path, entity, days, {(r["window_minutes"], r["day"]) for r in written})
    finally:
        rows.unpersist()
    store.commit(added.base, [added.run_row, *({"kind": "day", "day": d, "generation": added.generation,
                                                "live": any(r["day"] == d for r in written)} for d in days)])
    counts = dict.fromkeys(levels, 0)
    for r in written:
        counts[r["window_minutes"]] += r["count"]
    return counts


def feed_job(spark: SparkSession, readings: DataFrame, sink: str = "kafka", out: str | None = None,
             topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS,
             rebase_to: int | None = None, debug_dir: str | None = None) -> None:
    """Readings -> (optional rebase of event time) -> Kafka records."""
    if rebase_to is not None:
        readings = rebase_event_time(readings, rebase_to)
    debug_dump(readings, debug_dir, "feed")
    recs = kafka_records(readings)
    if sink == "kafka":
        write_kafka(recs, topic, brokers)
    elif sink == "text":
        recs.select("value").write.mode("overwrite").text(out)
    else:
        raise ValueError(f"unknown sink {sink!r}")


ENTITIES = {"house": HOUSE, "plug": PLUG}


def print_counts(counts: Observation | None) -> None:
    """What was counted while the job read its input."""
    if counts is not None:
        seen = counts.get
        print("lines dropped:", seen["dropped"])
        unfit = {k: seen[k] for k in ("nan", "infinite", "too_large") if seen[k]}
        if unfit:
            print("readings that do not fit:", unfit)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="loadcast")
    p.add_argument("job", choices=["feed", "house", "plug"])
    p.add_argument("--source", default="kafka", choices=["kafka", "csv", "parquet", "text"])
    p.add_argument("--path")
    p.add_argument("--min-partitions", type=int, help="spread unsplittable .gz files over so many tasks")
    p.add_argument("--topic", default=DEFAULT_TOPIC)
    p.add_argument("--bootstrap.servers", dest="brokers", default=DEFAULT_BROKERS)
    p.add_argument("--group.id", dest="group_id")
    p.add_argument("--streaming", action="store_true")
    p.add_argument("--checkpoint", help="checkpoint folder of a streaming job")
    p.add_argument("--once", action="store_true", help="streaming: take what is there, then end")
    p.add_argument("--store")
    p.add_argument("--docs")
    p.add_argument("--doc-format", default="json")
    p.add_argument("--raw-docs")
    p.add_argument("--run-id", help="replace the run of this name")
    p.add_argument("--distinct-runs", action="store_true", help="runs never overlap: read the readings once, track no ids")
    p.add_argument("--expire", type=int, metavar="SECONDS", help="then drop what has outlived its retention at this time")
    p.add_argument("--vacuum", action="store_true", help="then delete files that no longer count")
    p.add_argument("--sink", default="kafka", choices=["kafka", "text"])
    p.add_argument("--out")
    p.add_argument("--rebase-to", type=int)
    p.add_argument("--debug", dest="debug_dir")
    p.add_argument("--presum", default="final", choices=["final", "rolling", "none"])
    p.add_argument("--presum-key", default="intent", choices=["intent", "as_written"])
    p.add_argument("--property", type=int)
    p.add_argument("--median-mode", default="history", choices=["history", "zero"])
    p.add_argument("--median-scale", type=float, default=1.0)
    p.add_argument("--include-current", action="store_true")
    p.add_argument("--no-retention", action="store_true")
    p.add_argument("--approx-median", action="store_true")
    p.add_argument("--levels", default=",".join(map(str, LEVEL_MINUTES)))
    p.add_argument("--master")
    a = p.parse_args(argv)
    spark = build_session(a.master) if a.master else configure(SparkSession.builder.getOrCreate())
    kw = {"topic": a.topic, "brokers": a.brokers, "group_id": a.group_id} if a.source == "kafka" else {}
    if a.source == "csv" and a.min_partitions and not a.streaming:
        kw["min_partitions"] = a.min_partitions
    counts = Observation("readings") if a.source in ("csv", "text") else None
    if counts:
        kw["counts"] = "readings" if a.streaming else counts
    readings = load_sensor(spark, a.source, a.path, streaming=a.streaming, **kw)
    opts = Options(presum=a.presum, property=a.property, median_mode=a.median_mode,
                   median_scale=a.median_scale, include_current=a.include_current,
                   retention=not a.no_retention, median_exact=not a.approx_median)
    levels = tuple(int(x) for x in a.levels.split(","))
    entity = None if a.job == "feed" else (
        PLUG_AS_WRITTEN if (a.job == "plug" and a.presum_key == "as_written") else ENTITIES[a.job])
    if a.streaming:
        from ..streaming.jobs import StreamCounts, start_averaging_job, start_feed_job
        seen = StreamCounts()
        spark.streams.addListener(seen)
        trigger = {"availableNow": True} if a.once else {"processingTime": "30 seconds"}
        checkpoint = a.checkpoint or f"{shared_dir(spark)}/stream-{a.job}"
        if a.job == "feed":
            queries = [start_feed_job(readings, checkpoint, a.sink, a.out, a.topic, a.brokers, a.rebase_to, trigger)]
        else:
            queries = start_averaging_job(spark, readings, entity, a.store, a.docs, checkpoint, opts, levels, trigger,
                                          doc_format=a.doc_format, raw_path=a.raw_docs, debug_dir=a.debug_dir)
        for q in queries:
            q.awaitTermination()
        spark.streams.removeListener(seen)
        print("counted:", seen.by_query.get(str(queries[0].id), {}))
        return
    if a.job == "feed":
        feed_job(spark, readings, a.sink, a.out, a.topic, a.brokers, a.rebase_to, a.debug_dir)
        print_counts(counts)
        return
    print(averaging_job(spark, readings, entity, a.store, a.docs, opts, levels, debug_dir=a.debug_dir, run_id=a.run_id,
                        raw_path=a.raw_docs, doc_format=a.doc_format, track_ids=not a.distinct_runs))
    print_counts(counts)
    store = Store(spark, a.store, entity) if a.store else None
    if store and a.expire is not None:
        store.expire(a.expire, reach(levels, opts)[0])
    if store and a.vacuum:
        print("folders deleted:", store.vacuum())


if __name__ == "__main__":
    main()
