"""Streaming: restart, replay, late data, feed job (file source, availableNow).
That streams equal batches for all levels is checked by the stream_* queries."""

import os
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadcast.config import HOUSE, Options
from loadcast.functions.docs import parse_prediction
from loadcast.functions.text import sensor_line
from loadcast.plans.pipeline import all_levels, predictions
from loadcast.sources import read_csv, read_csv_stream, sensor_from_testdata
from loadcast.streaming.jobs import last_complete, process_batch, start_averaging_job, start_feed_job

SF = "/root/testdata/sf0.001"
LEVELS = (1, 5)
FLUSH_HOUSE = 99
COLS = ["house_id", "window_minutes", "window_start", "window_end", "sum", "count", "event_timestamp", "avg"]


def write_lines(path, lines, mtime):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


@pytest.fixture(scope="module")
def stream_input(spark, tmp_path_factory):
    """sf0.001 readings split over 3 time-ordered CSV files with increasing
    mtimes; returns them and what flushes the rest."""
    d = tmp_path_factory.mktemp("stream-in")
    r = sensor_from_testdata(spark, SF)
    rows = sorted(r.select(sensor_line().alias("l"), "timestamp").collect(), key=lambda x: x.timestamp)
    q = len(rows) // 3 + 1
    for i in range(3):
        write_lines(d / f"part{i}.csv", [x.l for x in rows[i * q:(i + 1) * q]], 1_600_000_000 + i * 10)
    return d, r, rows


def run_job(spark, src, tmp, options=Options()):
    store, docs, ck = str(tmp / "store"), str(tmp / "docs"), str(tmp / "ck")
    (q,) = start_averaging_job(spark, read_csv_stream(spark, str(src), max_files=1), HOUSE, store, docs, ck,
                               options, levels=LEVELS, now_ms=1)
    q.awaitTermination(600)
    assert q.exception() is None
    return q, store, docs


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_restarts_drops_late_rows_and_equals_batch(spark, stream_input, tmp_path):
    """A first run ends in the middle; the job goes on from its checkpoint with new
    files, one of them with a reading that is late by days."""
    src, readings, rows = stream_input
    q, store, docs = run_job(spark, src, tmp_path)
    done = spark.read.parquet(f"{store}/averages").count()
    assert done > 0
    day = 86400
    write_lines(src / "part7.csv", ["5,1704067205,1000,1,0,0,0"], 1_600_000_500)
    for i in (1, 2):
        write_lines(src / f"part{7 + i}.csv", [f"0,{rows[-1].timestamp + i * 10 * day},1.0,1,0,0,{FLUSH_HOUSE}"], 1_600_000_500 + i * 10)
    q, store, docs = run_job(spark, src, tmp_path)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    stored = spark.read.parquet(f"{store}/averages").where(F.col("house_id") != FLUSH_HOUSE)
    assert as_set(stored.select(*COLS)) == as_set(all_levels(readings, HOUSE, LEVELS).select(*COLS))
    preds = parse_prediction(spark.read.json(docs)).where(F.col("house_id") != FLUSH_HOUSE)
    cols = ["house_id", "sliding_window_ms", "event_timestamp", "avg", "median_load", "predicted_value"]
    assert as_set(preds.select(*cols)) == as_set(predictions(readings, HOUSE, LEVELS).select(*cols))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store, docs = str(tmp_path / "s"), str(tmp_path / "d")
    schema = "house_id long, pos long, s decimal(38,15), c long, t long"
    rows = lambda *x: spark.createDataFrame([(h, p, Decimal(s), c, t) for h, p, s, c, t in x], schema)
    one, two = rows((1, 100, 5, 1, 3000), (1, 103, 7, 2, 3090), (2, 101, 1, 1, 3030)), rows((1, 110, 2, 1, 3300))
    run = lambda df, i: process_batch(df, i, HOUSE, store, docs, levels=LEVELS, now_ms=1)
    run(one, 0)
    run(two, 1)
    run(one.limit(0), 2)
    assert [last_complete(spark, store, HOUSE, i) for i in (-1, 0, 1, 2, 3)] == [None, 103, 110, 110, None]
    before = as_set(spark.read.parquet(f"{store}/averages")), as_set(spark.read.json(docs))
    assert max(x.window_end for x in spark.read.parquet(f"{store}/averages").collect()) == 111 * 30
    run(two, 1)
    run(one.limit(0), 2)
    assert (as_set(spark.read.parquet(f"{store}/averages")), as_set(spark.read.json(docs))) == before


class Handle:
    """State and timer of one key."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    exists = lambda self: self.value is not None
    get = lambda self: self.value
    registerTimer = lambda self, t: self.timers.add(t)
    deleteTimer = lambda self, t: self.timers.discard(t)

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Clock:
    def __init__(self, now):
        self.getCurrentWatermarkInMs = lambda: now


@pytest.mark.parametrize("options", [Options(), Options(include_current=True, median_scale=10.0)])
def test_keyed_cascade_equals_batch(spark, options):
    """Panes with gaps of every length, in micro-batches, with timers between them:
    the windows of the batch plan, each once; at the end no state is left."""
    import random

    from loadcast.plans.pipeline import all_levels as batch
    from loadcast.streaming.cascade import RESULT, Cascade
    r = random.Random(5)
    pos, panes = 1000, []
    for _ in range(120):
        pos += r.choice((1, 1, 1, 2, 5, 30, 400, 900)) if len(panes) % 40 == 39 else r.choice((1, 1, 2, 7))
        panes.append((pos, r.randint(-10**6, 10**6), r.randint(1, 9), pos * 30 + 7))
    handle, job = Handle(), Cascade(HOUSE, (1, 5, 15), options)
    job.init(handle)

    def fire(now):
        """The key's timer, where it has come."""
        if handle.timers and min(handle.timers) <= now:
            (due,) = handle.timers
            handle.timers.clear()
            for f in job.handleExpiredTimer((0,), Clock(now), due):
                got.extend(f.itertuples(index=False))

    got, at = [], 0
    while at < len(panes):
        n = r.randint(1, 12)
        part, at = panes[at:at + n], at + n
        now = (part[-1][0] + 1) * 30_000
        frame = pd.DataFrame(part, columns=["pos", "units", "c", "t"]).sample(frac=1, random_state=at)
        got += [x for f in job.handleInputRows((0,), iter([frame]), Clock(now)) for x in f.itertuples(index=False)]
        if at < len(panes) and r.random() < 0.5:
            fire(panes[at][0] * 30_000)  # the watermark of the next pane's beginning
    end = (panes[-1][0] + 5000) * 30_000
    fire(end)
    assert handle.value is None and not handle.timers
    df = spark.createDataFrame([(0, p, u, c, t) for p, u, c, t in panes], "house_id long, pos long, u long, c long, t long")
    df = df.select("house_id", "pos", (F.col("u") * F.lit(Decimal("0.000000000000001"))).cast("decimal(38,15)").alias("s"), "c", "t")
    cols = ["house_id", *[n for n, _ in RESULT]]
    want = as_set(batch(None, HOUSE, (1, 5, 15), options, medians=True, pane_rows=df).select(*cols))
    assert sorted(tuple(x) for x in got) == want


def test_replayed_raw_documents_are_written_once(spark, tmp_path):
    """A batch that ended between its write and its commit comes again."""
    from loadcast.sources.sensor import SENSOR
    from loadcast.streaming.jobs import write_seconds
    batch = lambda *ids: spark.createDataFrame([(i, 100 + i, 1.0, 1, 0, 0, 0) for i in ids], SENSOR)
    raw = str(tmp_path / "raw")
    for ids, n in (((1, 2), 0), ((1, 2), 0), ((3,), 1), ((), 2), ((3,), 1)):
        write_seconds(batch(*ids) if ids else batch(0).limit(0), n, HOUSE, raw, None)
    got = spark.read.json(raw)
    assert got.count() == got.select("doc_id").distinct().count() == 3


def test_feed_job(spark, stream_input, tmp_path):
    src, _, _ = stream_input
    out = str(tmp_path / "feed")
    lines = read_csv(spark, str(src))
    n = lines.count()
    q = start_feed_job(read_csv_stream(spark, str(src)), str(tmp_path / "ck"), sink="text", path=out,
                       rebase_offset_s=3600)
    q.awaitTermination(300)
    recs = spark.read.json(out)
    assert recs.count() == n
    assert recs.agg(F.min("timestamp")).first()[0] == lines.agg(F.min("timestamp")).first()[0] + 3600
