"""Properties of the cascade and medians on the driver's sf0.001 data."""

import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadcast.config import HOUSE, PLUG, Options
from loadcast.operators.median import running_median, with_median_all_history
from loadcast.operators.presum import presum
from loadcast.plans.pipeline import all_levels, level_averages, level_frames, predictions
from loadcast.sources import sensor_from_testdata

SF = "/root/testdata/sf0.001"


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def readings(spark):
    return sensor_from_testdata(spark, SF).cache()


def test_conservation(readings):
    """Each row entering the cascade is counted 2 * 10 * 30 * 120 * 240 times."""
    n_presum = presum(readings, HOUSE, Options()).count()
    total = {r["window_minutes"]: r["sum(count)"] for r in
             all_levels(readings, HOUSE).groupBy("window_minutes").agg({"count": "sum"}).collect()}
    assert total == {1: 2 * n_presum, 5: 20 * n_presum, 15: 600 * n_presum, 60: 72_000 * n_presum, 120: 17_280_000 * n_presum}


@pytest.mark.parametrize("chunk", [7, 50, 400, 5000])
def test_chunking_does_not_change_results(readings, chunk):
    """Halo logic: any chunk size gives the same windows and medians."""
    ref = level_frames(readings, HOUSE, (1, 5, 15), Options(), medians=True)
    got = level_frames(readings, HOUSE, (1, 5, 15), Options(chunk_panes=chunk), medians=True)
    for m in (1, 5, 15):
        assert as_set(got[m]) == as_set(ref[m]), (chunk, m)


def test_plug_chunking(readings):
    ref = level_averages(readings, PLUG, 5)
    assert as_set(level_averages(readings, PLUG, 5, Options(chunk_panes=13))) == as_set(ref)


def test_prediction_formula(readings):
    rows = predictions(readings, HOUSE, (5,)).collect()
    assert all(r.avg == r.sum / r["count"] and r.predicted_value == (r.avg + r.median_load) / 2 for r in rows)
    assert any(r.median_load != 0 for r in rows)


def made(spark, values, timestamps=None):
    from loadcast.sources import SENSOR
    return spark.createDataFrame([(i, t, float(v), 1, 0, 0, 0) for i, (v, t) in
                                  enumerate(zip(values, timestamps or [1704067200 + i for i in range(len(values))]))], SENSOR)


def test_small_values_are_not_rounded(spark):
    (r,) = presum(made(spark, [0.0004, 0.0004], [1704067200] * 2), HOUSE, Options()).collect()
    assert r.value == 0.0008
    rows = level_averages(made(spark, [1e-11, 3.0]), HOUSE, 1).collect()
    assert {x.sum for x in rows} == {3.00000000001}


def test_unfit_readings_are_counted_and_left_out(spark):
    from loadcast.operators.presum import unfit_counts
    df = made(spark, [float("nan"), float("inf"), -float("inf"), 1e30, 0.1 + 1e-16, 2.5])
    assert {r.reason: r["count"] for r in unfit_counts(df).collect()} == {"nan": 1, "infinite": 2, "too_large": 1, "too_fine": 1}
    assert {x.sum for x in level_averages(df, HOUSE, 1).collect()} == {2.6}
    assert {x["count"] for x in level_averages(df, HOUSE, 1).collect()} == {2}


@pytest.mark.parametrize("chunk", [2880 * 7, 500])
def test_heavy_key_over_an_aligned_week_does_not_overflow(spark, chunk):
    """3e10 per pane, every pane of a week that one time chunk holds."""
    from pyspark.sql import functions as F
    start = 1704067200 // (2880 * 7 * 30) * (2880 * 7 * 30)
    week = spark.range(2880 * 7).select(F.lit(0).cast("long").alias("house_id"), (F.col("id") + start // 30).alias("pos"),
                                        F.lit(3 * 10**10).cast("decimal(38,15)").alias("s"), F.lit(1).cast("long").alias("c"),
                                        (start + F.col("id") * 30).alias("t"))
    rows = all_levels(None, HOUSE, (1, 120), Options(chunk_panes=chunk), pane_rows=week)
    top = rows.groupBy("window_minutes").agg(F.max("sum").alias("s"), F.max("count").alias("c"), F.count("*").alias("n")).collect()
    got = {r.window_minutes: (r.s, r.c) for r in top}
    assert got == {1: (6e10, 2), 120: (3e10 * 17_280_000, 17_280_000)}


def test_one_pane_aggregate_equals_two(readings):
    """Counting a pane's seconds by their bits gives the panes of the pre-sum."""
    from loadcast.operators.presum import panes
    from loadcast.plans.pipeline import entity_panes
    for entity in (HOUSE, PLUG):
        two = panes(presum(readings, entity, Options()), entity.key_cols)
        assert as_set(entity_panes(readings, entity, Options())) == as_set(two)
    plan = entity_panes(readings, HOUSE, Options())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_presum_is_order_independent(spark, readings):
    rows = readings.collect()
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, readings.schema).repartition(5)
    a = level_averages(readings, HOUSE, 15)
    b = level_averages(shuffled, HOUSE, 15)
    assert as_set(a) == as_set(b)


def brute_median(vals, i, include):
    hist = vals[:i + 1] if include else vals[:i]
    if not hist:
        return 0.0
    s = sorted(hist)
    n = len(s)
    return s[n // 2] if n % 2 else 0.5 * s[n // 2 - 1] + 0.5 * s[n // 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), max_size=60), st.booleans())
def test_running_median_matches_brute_force(vals, include):
    got = running_median(np.array(vals, dtype="float64"), include)
    assert list(got) == [brute_median(vals, i, include) for i in range(len(vals))]


@pytest.mark.parametrize("bucket", [1, 3, 1 << 16])
def test_running_total_buckets(spark, readings, bucket):
    """Two-level running total (id buckets) = one window per group."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from loadcast.operators.presum import running_total
    df = readings.withColumn("u", F.col("value").cast("decimal(38,15)"))
    group = ["house_id", "plug_id"]       # coarse groups: many rows, many buckets
    w = Window.partitionBy(*group).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("u").over(w).alias("u"), F.first("property").over(w).alias("property"))
    got = running_total(df, group, "id", "u", ["property"], bucket=bucket).select("id", "u", "property")
    assert as_set(got) == as_set(exp)


def test_custom_entity(readings):
    """Users add entities without code: a household-level cascade."""
    from loadcast.config import Entity
    household = Entity("Household", ("house_id", "household_id"), ("house_id", "household_id"))
    out = level_averages(readings, household, 5)
    n_presum = presum(readings, household, Options()).count()
    assert out.agg({"count": "sum"}).first()[0] == 20 * n_presum
    assert set(out.columns) >= {"house_id", "household_id", "avg"}


def test_as_written_options_differ(spark, readings):
    """Q3 rolling pre-sum, Q4 plug pre-sum key and Q5 key string each change
    results on the driver data (they are options, not the default)."""
    from pyspark.sql import functions as F

    from loadcast.config import PLUG_AS_WRITTEN
    from loadcast.functions.keys import key_string
    base = as_set(level_averages(readings, HOUSE, 1))
    assert as_set(level_averages(readings, HOUSE, 1, Options(presum="rolling"))) != base
    from loadcast.sources import SENSOR
    # same house, same second, same plug number in two households
    two = spark.createDataFrame([(1, 1704067200, 1.0, 1, 3, 0, 7), (2, 1704067200, 2.0, 1, 3, 1, 7)], SENSOR)
    assert len(as_set(presum(two, PLUG, Options()))) == 2
    merged = presum(two, PLUG_AS_WRITTEN, Options()).collect()
    assert [(r.value, r.household_id) for r in merged] == [(3.0, 0)]
    keys = level_averages(readings, PLUG, 1).select(key_string().alias("a"),
                                                    key_string(mode="as_written").alias("b"))
    assert keys.where(F.col("a") != F.col("b")).count() > 0


def test_hot_key_is_split_over_tasks(readings):
    """One key holding every reading is still spread over several tasks by the
    (key, time chunk) partitioning, and results do not depend on the split."""
    from pyspark.sql import functions as F

    from loadcast.operators.windows import spread
    from loadcast.plans.pipeline import entity_panes
    hot = readings.withColumn("house_id", F.lit(0).cast("long"))
    panes = entity_panes(hot, HOUSE, Options())
    spread_rows = spread(panes, 100, 39, ("house_id",), partitions=8)
    sizes = [r["n"] for r in spread_rows.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)
    small = level_averages(hot, HOUSE, 15, Options(chunk_panes=100, cascade_partitions=8))
    assert as_set(small) == as_set(level_averages(hot, HOUSE, 15))


# ------------------------------------------------------ median over all history

@pytest.mark.parametrize("include", [False, True])
def test_all_history_median_in_chunks(spark, include):
    """A key's history over many chunks, with ties, gaps and trends, equals the
    running median of the whole; more chunks than one hold the key."""
    r = random.Random(8)
    rows = [(1, p, float(r.choice((0, 0, 5, r.random(), p / 50)))) for p in range(900) if p % 7]
    rows += [(2, 31 * p, 1.0) for p in range(60)] + [(3, p, float(-p)) for p in range(200)] + [(4, 5000, 2.5)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "house_id long, pos long, avg double")
    opts = Options(retention=False, include_current=include, median_scale=1000.0)
    want = {}
    for house in (1, 2, 3, 4):
        own = sorted((p, v) for h, p, v in rows if h == house)
        for (p, _), m in zip(own, running_median(np.array([v for _, v in own]), include)):
            want[house, p] = m / 1000.0
    for chunk, buckets in ((64, 16), (300, 4), (1 << 17, 256)):
        got = with_median_all_history(df, ["house_id"], opts, chunk=chunk, buckets=buckets)
        assert {(x.house_id, x.pos): x.median_load for x in got.collect()} == want, chunk


def test_hot_key_history_is_spread(spark, readings):
    """One key with all readings: its history is worked on in several groups, none
    longer than a chunk."""
    path = with_median_all_history(
        spark.range(2000).select(F.lit(1).alias("house_id"), F.col("id").alias("pos"), F.rand(1).alias("avg")),
        ["house_id"], Options(retention=False), chunk=128, buckets=16)
    plan = path._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "FlatMapGroupsInPandas" not in plan
    assert path.count() == 2000


def test_small_value_beside_a_large_total(spark):
    """No level of the cascade loses a place: every row counts both readings alike."""
    rows = all_levels(made(spark, [1e-15, 3.0]), HOUSE).collect()
    want = {(x.window_minutes, x["count"]): float(Decimal("3.000000000000001") * (x["count"] // 2)) for x in rows}
    assert {m for m, _ in want} == {1, 5, 15, 60, 120} and max(n for _, n in want) > 100_000
    assert {(x.window_minutes, x["count"], x.sum) for x in rows} == {(*k, v) for k, v in want.items()}


def test_head_room_of_the_sums():
    """The longest running sum that config states stays within its digits."""
    from loadcast.config import VALUE_SCALE
    from loadcast.operators.windows import lookback, panes_per_window
    rows = Options().chunk_panes + lookback([panes_per_window(m) for m in (1, 5, 15, 60, 120)])[-1] + 241
    assert 3 * 10**10 * (2 * 10 * 30 * 120 * 240) * rows < 10 ** (38 - VALUE_SCALE)
