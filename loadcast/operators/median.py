"""Median of an entity's earlier averages (the enrichment lookup) and the
load prediction."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import cloudpickle

from ..config import SLIDE_SECONDS, Options, retention_seconds
from ..session import scratch_path
from .presum import floordiv

# The grouped-map function below is shipped by value, so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Relative accuracy of the approximate median (``median_exact=False``).
APPROX_ACCURACY = 10000


def history_frame(minutes: int, include_current: bool) -> tuple[int, int]:
    """Frame, in panes relative to the current window end, of the averages a
    lookup sees: ends in ``[end - retention, end - 1]`` seconds (or up to
    ``end`` when the current average is included)."""
    return retention_seconds(minutes) // SLIDE_SECONDS, 0 if include_current else -1


def _median(col: Column, exact: bool) -> Column:
    return F.percentile(col, F.lit(0.5)) if exact else F.percentile_approx(col, 0.5, APPROX_ACCURACY)


def sorted_median(values: Column) -> Column:
    """Exact median of a sorted array: the middle element, or ``0.5*lo +
    0.5*hi`` for an even count (the same arithmetic as ``percentile``);
    NULL for an empty array."""
    n = F.size(values)
    mid = lambda k: F.element_at(values, k.cast("int"))
    return (F.when(n == 0, F.lit(None).cast("double"))
            .when(n % 2 == 1, mid((n + 1) / 2))
            .otherwise(F.lit(0.5) * mid(n / 2) + F.lit(0.5) * mid(n / 2 + 1)))


def _finish(m: Column, options: Options) -> Column:
    m = F.coalesce(m, F.lit(0.0))
    if options.median_scale != 1.0:
        m = m / F.lit(float(options.median_scale))
    return m


def add_medians(df: DataFrame, targets: dict[str, tuple[Column, int]], part: list[str],
                options: Options, order: str = "pos") -> DataFrame:
    """Add median columns ``{name: (avg column, window minutes)}``, each the
    median of the same key's earlier averages in its retention frame (or in
    the whole earlier history with ``retention=False``). Empty history = 0.0.

    The bounded exact case collects the frame's values and sorts them once
    per row (a column of its own, so the sort is not repeated per branch of
    the median expression): ~3.5x cheaper than re-aggregating ``percentile``'s
    boxed buffer per row, with bit-identical results."""
    if options.median_mode == "zero":
        return df.select("*", *[F.lit(0.0).alias(k) for k in targets])
    if options.median_mode != "history":
        raise ValueError(f"unknown median mode {options.median_mode!r}")
    windows = {}
    for name, (_, minutes) in targets.items():
        lo, hi = history_frame(minutes, options.include_current)
        w = Window.partitionBy(*part).orderBy(order)
        windows[name] = w.rangeBetween(-lo, hi) if options.retention else \
            w.rangeBetween(Window.unboundedPreceding, hi)
    if options.retention:  # at most 2 * minutes + 1 values: always exact
        tmp = {k: f"_hist_{k}" for k in targets}
        df = df.select("*", *[F.sort_array(F.collect_list(avg).over(windows[k])).alias(tmp[k])
                              for k, (avg, _) in targets.items()])
        df = df.select("*", *[_finish(sorted_median(F.col(tmp[k])), options).alias(k) for k in targets])
        return df.drop(*tmp.values())
    return df.select("*", *[_finish(_median(avg, options.median_exact).over(windows[k]), options).alias(k)
                            for k, (avg, _) in targets.items()])


def with_median(df: DataFrame, part: list[str], minutes: int, options: Options,
                order: str = "pos") -> DataFrame:
    """Add ``median_load`` to level rows that carry an ``avg`` column.

    With retention (the default) the frame is bounded -- at most
    ``2 * minutes + 1`` earlier averages -- and is evaluated inside the
    ``(key, chunk)`` partitions of the cascade (their halo covers it).
    Without retention the whole history of the key is the frame, which
    needs ``part`` = the key alone.
    """
    return add_medians(df, {"median_load": (F.col("avg"), minutes)}, part, options, order)


def running_median(values: np.ndarray, include_current: bool, band: np.ndarray | None = None,
                   weights: np.ndarray | None = None, below: int = 0, before: int = 0) -> np.ndarray:
    """Median of all earlier values (optionally including the current one) for
    each position. ``before`` values came before the first: ``below`` of them are
    smaller than the values in ``band`` (distinct, with their ``weights``), the
    rest larger; the band must hold every value that a median can fall on. Even
    counts interpolate as ``0.5*lo + 0.5*hi``; no earlier value gives 0.0.

    Counts by value are kept in a binary indexed tree: O(log n) a value."""
    band = np.zeros(0) if band is None else band
    scale, at = np.unique(np.concatenate([band, values]), return_inverse=True)
    start = np.zeros(len(scale) + 1, np.int64)
    start[at[:len(band)] + 1] = 0 if weights is None else weights
    upto = np.cumsum(start)
    i = np.arange(1, len(scale) + 1)
    tree = [0, *(upto[i] - upto[i & (i - 1)]).tolist()]
    size, top = len(scale), 1 << max(len(scale).bit_length() - 1, 0)
    places, numbers = (at[len(band):] + 1).tolist(), scale.tolist()
    out = np.empty(len(values), dtype="float64")

    def ranked(k: int) -> float:
        """The value of rank k, from 0, above those that are below the band."""
        node, step = 0, top
        while step:
            if node + step <= size and tree[node + step] <= k:
                node += step
                k -= tree[node]
            step >>= 1
        return numbers[node]

    n = before
    for row, place in enumerate(places):
        if not include_current:
            out[row] = _middle(ranked, n, below)
        j = place
        while j <= size:
            tree[j] += 1
            j += j & -j
        n += 1
        if include_current:
            out[row] = _middle(ranked, n, below)
    return out


def _middle(ranked, n: int, below: int) -> float:
    if n == 0:
        return 0.0
    if n % 2:
        return ranked(n // 2 - below)
    return 0.5 * ranked(n // 2 - 1 - below) + 0.5 * ranked(n // 2 - below)


# Time chunk, in panes, and value buckets (a square) of the all-history median.
HISTORY_CHUNK = 1 << 17
HISTORY_BUCKETS = 256


def value_bucket(value: Column, bounds: Column, buckets: int) -> Column:
    """Number of bounds below a value, found in two steps."""
    side = math.isqrt(buckets)
    below = lambda xs: F.size(F.filter(xs, lambda b: b < value))
    coarse = below(F.filter(bounds, lambda b, i: i % side == side - 1))
    return coarse * side + below(F.slice(bounds, coarse * side + 1, F.lit(side - 1)))


def with_median_all_history(df: DataFrame, key_cols: list[str], options: Options, order: str = "pos",
                            chunk: int = HISTORY_CHUNK, buckets: int = HISTORY_BUCKETS) -> DataFrame:
    """``median_load`` over the whole earlier history of each key (no retention),
    spread over time chunks of the key.

    While a chunk of m rows passes, the median of all that came before moves by
    at most m ranks. So a chunk needs, of all earlier rows, only the band of values
    within m ranks of the median at its start, and how many are below. Which values
    these are comes from counts by (value bucket, time chunk), prefix-summed over
    chunks and then over buckets; the bounds of a key's buckets are approximate
    quantiles of its values, which only sets how even they are. Rows are exact:
    the running median of a chunk ranks its rows within the band. A task holds one
    chunk and its band, whose values are distinct (a value that repeats has a
    weight): about 2 m and two buckets' worth.

    The averages are written once to the shared folder, as four steps read them."""
    spark, k = df.sparkSession, list(key_cols)
    span = chunk if order == "pos" else chunk * SLIDE_SECONDS
    path = scratch_path(spark, "history")
    df.withColumn("_chunk", floordiv(order, span)).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    include, scale = options.include_current, float(options.median_scale)
    schema = T.StructType(df.schema.fields + [T.StructField("median_load", T.DoubleType())])

    def one_chunk(key, own: pa.Table, near_median: pa.Table | None = None) -> pa.Table:
        own = own.sort_by(order)
        before = {}
        if near_median is not None and near_median.num_rows:
            before = dict(zip(("band", "weights"), (near_median.column(c).to_numpy() for c in ("avg", "_w"))),
                          below=near_median.column("_below").to_numpy().min(), before=near_median.column("_n")[0].as_py())
        got = running_median(own.column("avg").to_numpy(), include, **before)
        return own.drop_columns(["_chunk"]).append_column("median_load", pa.array(got / scale if scale != 1.0 else got))

    own = rows.groupBy(*k, "_chunk")
    if rows.groupBy(*k).agg(F.max("_chunk").alias("b"), F.min("_chunk").alias("a")).where("a < b").isEmpty():
        # no key has a second chunk, so nothing comes before any
        return own.applyInArrow(lambda key, t: one_chunk(key, t), schema)
    quantiles = F.percentile_approx("avg", [i / buckets for i in range(1, buckets)], 8 * buckets)
    bounds = rows.groupBy(*k).agg(quantiles.alias("_bounds"))
    chunks = rows.groupBy(*k, "_chunk").agg(F.count(F.lit(1)).alias("_m"))
    cells = (rows.groupBy(*k, "_chunk", "avg").agg(F.count(F.lit(1)).alias("_w"))
             .join(chunks.join(bounds, k).drop("_m"), [*k, "_chunk"])
             .withColumn("_bucket", value_bucket(F.col("avg"), F.col("_bounds"), buckets)).drop("_bounds"))
    cells.write.parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    grid = (chunks.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
            .join(cells.groupBy(*k, "_chunk", "_bucket").agg(F.sum("_w").alias("_w")), [*k, "_chunk", "_bucket"], "left"))
    until = Window.partitionBy(*k, "_bucket").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("_had", F.coalesce(F.sum("_w").over(until), F.lit(0)))
    start = Window.partitionBy(*k, "_chunk")
    grid = (grid.withColumn("_upto", F.sum("_had").over(start.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_n", F.sum("_had").over(start)))
    near = (F.col("_had") > 0) & (F.col("_upto") >= (F.col("_n") - 1) / 2 - F.col("_m")) & (
        F.col("_upto") - F.col("_had") <= F.col("_n") / 2 + F.col("_m"))
    need = grid.where(near).select(*k, "_bucket", F.col("_chunk").alias("_at"), "_n", (F.col("_upto") - F.col("_had")).alias("_below"))
    band = (cells.join(need, [*k, "_bucket"]).where("_chunk < _at")
            .groupBy(*k, "_at", "avg").agg(F.sum("_w").alias("_w"), F.min("_below").alias("_below"), F.min("_n").alias("_n"))
            .withColumnRenamed("_at", "_chunk"))
    return own.cogroup(band.groupBy(*k, "_chunk")).applyInArrow(one_chunk, schema)


def median_of_store(store: DataFrame, key_cols: tuple[str, ...], minutes: int,
                    options: Options) -> DataFrame:
    """Median lookup against a stored averages table (one entity, one window
    length): for every stored average, the median of the same key's stored
    averages whose window ended within the retention before it. Partitioned
    by key and by day of ``window_end`` with a halo, like the cascade."""
    lo, hi = history_frame(minutes, options.include_current)
    day = 2880
    df = (store.withColumn("pos", F.expr(f"window_end div {SLIDE_SECONDS} - 1"))
          .withColumn("_home", F.expr(f"pos div {day}"))
          .withColumn("_chunk", F.explode(F.sequence(F.col("_home"), F.expr(f"(pos + {lo}) div {day}")))))
    part = list(key_cols) + ["_chunk"]
    if options.retention:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *part)
    if not options.retention:
        part = list(key_cols)
        df = df.where(F.col("_home") == F.col("_chunk"))
    out = with_median(df, part, minutes, options)
    return out.where(F.col("_home") == F.col("_chunk")).drop("pos", "_home", "_chunk")
