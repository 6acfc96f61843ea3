"""Batch jobs: the store that grows, sinks, command line."""

import json

import pytest
from pyspark.sql import functions as F

from loadcast.config import HOUSE, PLUG, Options
from loadcast.functions.docs import parse_prediction
from loadcast.operators.presum import presum
from loadcast.plans.jobs import averaging_job, feed_job, main
from loadcast.plans.pipeline import predictions, reach
from loadcast.sinks.runs import Store, add_run
from loadcast.sinks.store import compact, write_documents
from loadcast.sources import sensor_from_testdata
from loadcast.sources.sensor import SENSOR, load_sensor
from tests.conftest import T0

SF = "/root/testdata/sf0.001"
LEVELS = (1, 5)
COLS = ["window_minutes", "house_id", "window_end", "sum", "count", "avg"]


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_runs_add_up_and_repeat_without_change(spark, tmp_path):
    """Two halves of the readings, split within a pane, in one store: averages and
    medians of one run over all. Repeating a half changes nothing."""
    r = sensor_from_testdata(spark, SF)
    store, docs = str(tmp_path / "store"), str(tmp_path / "docs")
    middle = sorted(x.timestamp for x in r.select("timestamp").collect())[400] // 30 * 30 + 10
    early, late = r.where(F.col("timestamp") < middle), r.where(F.col("timestamp") >= middle)
    exp = predictions(r, HOUSE, LEVELS)
    want = as_set(exp.select(*COLS))

    def state():
        back = parse_prediction(spark.read.json(docs).select("value"))
        return (as_set(Store(spark, store, HOUSE).averages().select(*COLS)),
                as_set(back.select("house_id", "event_timestamp", "sliding_window_ms", "predicted_value", "median_load")))

    counts = averaging_job(spark, late, HOUSE, store, docs, levels=LEVELS, now_ms=5)
    assert counts.keys() == {1, 5} and state()[0] != want
    averaging_job(spark, early, HOUSE, store, docs, levels=LEVELS, now_ms=5)
    first = state()
    assert first[0] == want
    assert first[1] == as_set(exp.select("house_id", "event_timestamp", "sliding_window_ms", "predicted_value", "median_load"))
    averaging_job(spark, late, HOUSE, store, docs, levels=LEVELS, now_ms=5)
    assert state() == first
    # compaction with the retention cut
    n = compact(spark, Store(spark, store, HOUSE).averages(), str(tmp_path / "all"))
    assert n == len(want)
    now = max(x[2] for x in want)
    kept = compact(spark, Store(spark, store, HOUSE).averages(), str(tmp_path / "alive"), now_s=now)
    assert kept == sum(x[2] >= now - 5 - x[0] * 60 for x in want) < n


def test_plug_job_sinks(spark, tmp_path):
    """Documents keep id and type, raw documents and every debug stage are written."""
    r = sensor_from_testdata(spark, SF)
    counts = averaging_job(spark, r, PLUG, str(tmp_path / "s"), str(tmp_path / "d"), Options(retention=False), levels=LEVELS,
                           debug_dir=str(tmp_path / "debug"), raw_path=str(tmp_path / "raw"))
    exp = predictions(r, PLUG, LEVELS, Options(retention=False))
    assert sum(counts.values()) == exp.count()
    docs = spark.read.json(str(tmp_path / "d"))
    assert docs.select("doc_id").distinct().count() == docs.count() == exp.count()
    assert {x.doc_type for x in docs.select("doc_type").distinct().collect()} == {"prediction_1min", "prediction_5min"}
    raw = spark.read.json(str(tmp_path / "raw"))
    assert {x.doc_type for x in raw.collect()} == {"raw"}
    total = sum(json.loads(x.value)["value"] for x in raw.collect())
    assert total == pytest.approx(r.agg(F.sum("value")).first()[0])
    stages = {p.name for p in (tmp_path / "debug" / "plug").iterdir()}
    assert stages == {"presum", "panes", "averages", "enriched", "predictions"}
    # any other format on the class path gets the rows as they are
    write_documents(docs.select("doc_id", "doc_type", "value"), str(tmp_path / "orc"), "orc")
    assert spark.read.orc(str(tmp_path / "orc")).count() == docs.count()


def test_feed_and_cli(spark, tmp_path, capsys):
    r = sensor_from_testdata(spark, SF)
    out = str(tmp_path / "feed")
    feed_job(spark, r, sink="text", out=out, rebase_to=1_800_000_000)
    recs = spark.read.json(out)
    assert recs.count() == r.count()
    assert recs.agg(F.min("timestamp")).first()[0] == 1_800_000_000
    csv = str(tmp_path / "in")
    r.write.csv(csv, compression="gzip")
    spark.createDataFrame([("1,2,3",)], "v string").write.mode("append").text(csv)
    main(["house", "--source", "csv", "--path", csv, "--store", str(tmp_path / "cli-store"), "--min-partitions", "4", "--levels", "1,5"])
    assert "lines dropped: 1" in capsys.readouterr().out
    got = Store(spark, str(tmp_path / "cli-store"), HOUSE).averages()
    assert got.select("window_minutes").distinct().count() == 2
    main(["house", "--source", "csv", "--path", csv, "--streaming", "--once", "--store", str(tmp_path / "stream-store"),
          "--docs", str(tmp_path / "stream-docs"), "--raw-docs", str(tmp_path / "stream-raw"), "--debug", str(tmp_path / "stream-debug"),
          "--checkpoint", str(tmp_path / "ck"), "--levels", "1"])
    assert spark.read.json(str(tmp_path / "stream-docs")).count() > 0
    said = capsys.readouterr().out
    assert f"'lines': {r.count() + 1}" in said and "'dropped': 1" in said and "'late': 0" in said
    # every output of the streaming command: raw documents of the closed seconds, and each stage
    raw = [json.loads(x.value) for x in spark.read.json(str(tmp_path / "stream-raw")).collect()]
    seconds = {(x.house_id, x.timestamp): x.value for x in presum(r, HOUSE, Options()).collect()}
    assert raw and all(seconds[x["house_id"], x["timestamp"]] == x["value"] for x in raw)
    assert len(raw) > 0.9 * len(seconds) and len({(x["house_id"], x["timestamp"]) for x in raw}) == len(raw)
    stages = {p.name for p in (tmp_path / "stream-debug" / "house").iterdir()}
    assert stages == {"presum", "panes", "averages", "enriched", "predictions"}


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown source"):
        load_sensor(spark, "carrier pigeon")


def test_empty_run(spark, tmp_path):
    r = sensor_from_testdata(spark, SF).limit(0)
    assert averaging_job(spark, r, HOUSE, str(tmp_path / "s"), None, levels=LEVELS) == {1: 0, 5: 0}


# ------------------------------------------------------------------ store of runs

DAY = 86400


def small(spark, rows):
    return spark.createDataFrame(rows, SENSOR)


def readings_of(n_days, plugs=(0, 1), first=T0, ids=0):
    """A reading per plug every 90 minutes; the plugs share their seconds."""
    return [(ids + 1000 * p + i, first + i * 5400, 10.0 * (p + 1), 1, p, 0, 0) for p in plugs for i in range(n_days * 16)]


def averages_of(spark, store):
    return as_set(Store(spark, store, HOUSE).averages().select(*COLS))


def one_run(spark, rows, options=Options()):
    return as_set(predictions(small(spark, rows), HOUSE, LEVELS, options).select(*COLS))


def test_runs_that_share_seconds_and_readings(spark, tmp_path):
    """Two runs split by plug; a run and then a larger one that holds it; parts and all."""
    rows = readings_of(2)
    a, b = [r for r in rows if r[4] == 0], [r for r in rows if r[4] == 1]
    want = one_run(spark, rows)
    for k, runs in enumerate(([a, b], [a, rows], [b, a[:10], rows])):
        store = str(tmp_path / f"s{k}")
        for run in runs:
            averaging_job(spark, small(spark, run), HOUSE, store, None, levels=LEVELS)
        assert averages_of(spark, store) == want, k


def test_run_replaced_by_fewer_days(spark, tmp_path):
    """Nothing of the replaced days stays, in averages or documents."""
    store, docs = str(tmp_path / "s"), str(tmp_path / "d")
    long, short = readings_of(4), readings_of(1)
    job = lambda rows, name: averaging_job(spark, small(spark, rows), HOUSE, store, docs, levels=LEVELS, run_id=name, now_ms=5)
    job(readings_of(1, (7,), T0 + 2 * DAY, 50_000), "other")
    job(long, "x")
    job(short, "x")
    want = one_run(spark, short + readings_of(1, (7,), T0 + 2 * DAY, 50_000))
    assert averages_of(spark, store) == want
    assert spark.read.json(docs).count() == len(want)
    # back in time as well, before 1970
    early = [(9000 + i, -DAY + i * 5400, 5.0, 1, 0, 0, 0) for i in range(16)]
    job(early, "early")
    assert averages_of(spark, store) == sorted(want + one_run(spark, early))
    assert Store(spark, store, HOUSE).vacuum() > 0
    assert averages_of(spark, store) == sorted(want + one_run(spark, early))


def test_uncommitted_run_is_invisible(spark, tmp_path):
    store = str(tmp_path / "s")
    a, b = readings_of(1), readings_of(2, (3,), T0, 70_000)
    averaging_job(spark, small(spark, a), HOUSE, store, None, levels=LEVELS)
    before = averages_of(spark, store)
    s = Store(spark, store, HOUSE)
    added = add_run(s, small(spark, b), Options(), "b")       # panes and ids are written, then the run ends
    s.write_averages(s.averages(), added.generation)           # even some averages
    assert averages_of(spark, store) == before and set(s.snapshot().runs) == {"run-1"}
    averaging_job(spark, small(spark, b), HOUSE, store, None, levels=LEVELS, run_id="b")
    assert averages_of(spark, store) == one_run(spark, a + b)
    assert as_set(s.averages(version=1).select(*COLS)) == before   # an earlier snapshot is still there
    assert as_set(s.averages(minutes=5, since=T0 + DAY).select(*COLS)) == [r for r in one_run(spark, a + b) if r[0] == 5 and r[2] >= T0 + DAY]


def test_run_that_others_rely_on(spark, tmp_path):
    store = str(tmp_path / "s")
    a = readings_of(1)
    job = lambda rows, name: averaging_job(spark, small(spark, rows), HOUSE, store, None, levels=LEVELS, run_id=name)
    job(a[:8], "first")
    job(a, "all")
    with pytest.raises(ValueError, match="'first' would lose 3 ids"):
        job(a[:5], "first")
    job(a[:9], "first")          # one more, which "all" holds: left out
    assert averages_of(spark, store) == one_run(spark, a)


def test_no_retention_updates_every_later_day(spark, tmp_path):
    """A change 500 days before the last stored day reaches its median."""
    store = str(tmp_path / "s")
    options = Options(retention=False)
    late, early = readings_of(1, (0,), T0 + 500 * DAY, 5000), readings_of(1, (1,))
    for rows in (late, early):
        averaging_job(spark, small(spark, rows), HOUSE, store, str(tmp_path / "d"), options, levels=(1,), now_ms=5)
    got = parse_prediction(spark.read.json(str(tmp_path / "d")).select("value"))
    want = predictions(small(spark, late + early), HOUSE, (1,), options)
    cols = ("house_id", "event_timestamp", "avg", "median_load")
    assert as_set(got.select(*cols)) == as_set(want.select(*cols))


def test_expiry(spark, tmp_path):
    """Averages past their retention go, and so do panes that nothing looks back to;
    a run after it continues as if they were there."""
    store = str(tmp_path / "s")
    rows, more = readings_of(3), readings_of(1, (0, 1), T0 + 3 * DAY, 30_000)
    averaging_job(spark, small(spark, rows), HOUSE, store, None, levels=LEVELS)
    now = T0 + 3 * DAY
    s = Store(spark, store, HOUSE)
    s.expire(now, reach(LEVELS, Options())[0])
    assert averages_of(spark, store) == [r for r in one_run(spark, rows) if r[2] >= now - 5 - r[0] * 60]
    assert s.vacuum() > 0
    averaging_job(spark, small(spark, more), HOUSE, store, None, levels=LEVELS)
    got = [r for r in averages_of(spark, store) if r[2] > now]
    assert got == [r for r in one_run(spark, rows + more) if r[2] > now]
