"""Sliding-window averages over 30-second panes (batch).

A sliding window of ``n`` panes ending at pane ``e`` covers panes
``e-n+1 .. e``; it exists when at least one of those panes has data, also
when its own last pane is empty. Each level of the cascade is computed as

1. a *spine* of window ends: every input row at ``pos`` emits the ends
   ``pos .. min(next_pos - 1, pos + n - 1)`` (``lead`` + ``explode``), so
   each end is generated exactly once;
2. prefix sums over the spine: ``sum(last n panes) = S(<= e) - S(<= e-n)``,
   two running range frames, O(1) per row. Sums are decimals, so the
   difference is exact; the latest timestamp is a running ``max`` because it
   grows with the pane.

Partitioning: rows are spread over ``(key, time chunk)`` partitions. A row is
also copied into the following chunks whose look-back (``halo`` panes)
reaches it, so every window ending inside a chunk is computed from data of
that partition alone. A hot key is therefore split over its chunks instead
of landing in one task, and the whole cascade (and the trailing medians)
runs after a single exchange: every later level keeps the same
partitioning and only re-sorts locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SLIDE_SECONDS
from .presum import floordiv, from_units

CHUNK = "_chunk"


def panes_per_window(minutes: int) -> int:
    return minutes * 60 // SLIDE_SECONDS


def lookback(level_panes: list[int]) -> list[int]:
    """Panes before ``e`` that level i at ``e`` depends on, cumulatively."""
    out, acc = [], 0
    for n in level_panes:
        acc += n - 1
        out.append(acc)
    return out


def spread(pane_rows: DataFrame, chunk: int, halo: int, key_cols: tuple[str, ...] = (),
           partitions: int | None = None) -> DataFrame:
    """Copy each pane row into its home chunk and the later chunks that
    reach back to it (at most two when ``chunk >= halo``), then hash-partition
    by (key, chunk).

    The exchange is an explicit ``repartition`` to ``partitions`` (default:
    the session's ``spark.sql.shuffle.partitions``): adaptive execution sizes
    post-shuffle partitions by bytes and would merge these small-but-heavy
    groups (every level's windows and medians run on them) into a few tasks.
    The result satisfies the windows' distribution, so no other exchange is
    added."""
    if chunk < 1:
        raise ValueError("chunk must be >= 1 pane")
    first = floordiv("pos", chunk)
    last = floordiv(f"pos + {int(halo)}", chunk)
    out = pane_rows.withColumn(CHUNK, F.explode(F.sequence(first, last)))
    if key_cols:
        n = partitions or int(pane_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition(n, *key_cols, CHUNK)
    return out


def _with_next(df: DataFrame, part: list[str]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy("pos")
    return df.withColumn("nxt", F.lead("pos").over(w))


def slide(df: DataFrame, part: list[str], n: int, chunk: int,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """One sliding level of ``n`` panes over rows ``(part, pos, s, c, t, nxt)``.

    Returns rows of the same shape, one per window end (ends beyond the
    chunk are left to the next chunk). ``carry`` columns are passed through
    on the end that equals the input row's own position (NULL on added
    ends): every end of a level is also an end of the next level, so the
    earlier levels' values ride along a single chain."""
    last_in_chunk = (F.col(CHUNK) + 1) * chunk - 1
    stop = F.least(F.coalesce(F.col("nxt") - 1, F.col("pos") + (n - 1)),
                   F.col("pos") + (n - 1), last_in_chunk)
    spine = df.select(*part, "pos", "s", "c", "t", *carry,
                      F.explode(F.sequence(F.col("pos"), stop)).alias("e"))
    here = F.col("e") == F.col("pos")
    spine = spine.select(*part, F.col("e").alias("pos"),
                         *[F.when(here, F.col(x)).alias(x) for x in ("s", "c", "t", *carry)])
    w = Window.partitionBy(*part).orderBy("pos")
    upto = w.rangeBetween(Window.unboundedPreceding, 0)
    before = w.rangeBetween(Window.unboundedPreceding, -n)
    zero = F.lit(0)
    return spine.select(
        *part, "pos",
        (F.sum("s").over(upto) - F.coalesce(F.sum("s").over(before), zero)).alias("s"),
        (F.sum("c").over(upto) - F.coalesce(F.sum("c").over(before), zero)).alias("c"),
        F.max("t").over(upto).alias("t"),
        F.lead("pos").over(w).alias("nxt"),
        *carry)


def cascade(pane_rows: DataFrame, key_cols: tuple[str, ...], level_panes: list[int],
            chunk: int, halo: int | None = None, partitions: int | None = None) -> list[DataFrame]:
    """Chain of sliding levels; level i+1 slides over the window ends of
    level i. Returns the per-level frames *before* the home-chunk filter
    (callers add medians first, then call :func:`home`). ``halo`` defaults
    to the look-back of the last level; medians need more."""
    halo = lookback(level_panes)[-1] if halo is None else halo
    part = list(key_cols) + [CHUNK]
    df = _with_next(spread(pane_rows, chunk, halo, key_cols, partitions), part)
    out = []
    for n in level_panes:
        df = slide(df, part, n, chunk)
        out.append(df)
    return out


def cascade_wide(pane_rows: DataFrame, key_cols: tuple[str, ...], level_panes: list[int],
                 chunk: int, halo: int | None = None, partitions: int | None = None) -> DataFrame:
    """The whole chain in one pass: one row per end of the last level,
    carrying ``s{i}, c{i}, t{i}`` of every level ``i`` (NULL where level
    ``i`` has no window ending there). Callers add medians, then
    :func:`home`."""
    halo = lookback(level_panes)[-1] if halo is None else halo
    part = list(key_cols) + [CHUNK]
    df = _with_next(spread(pane_rows, chunk, halo, key_cols, partitions), part)
    carry: tuple[str, ...] = ()
    last = len(level_panes) - 1
    for i, n in enumerate(level_panes):
        df = slide(df, part, n, chunk, carry)
        if i < last:
            df = (df.withColumn(f"s{i}", F.col("s")).withColumn(f"c{i}", F.col("c"))
                  .withColumn(f"t{i}", F.col("t")))
            carry = carry + (f"s{i}", f"c{i}", f"t{i}")
    return (df.withColumnRenamed("s", f"s{last}").withColumnRenamed("c", f"c{last}")
            .withColumnRenamed("t", f"t{last}"))


def level_struct(i: int, n: int, extra: dict | None = None) -> Column:
    """Averages of level ``i`` of a wide row as a struct (NULL fields where
    the level has no window ending at this row)."""
    total = from_units(F.col(f"s{i}"))
    fields = [((F.col("pos") - (n - 1)) * SLIDE_SECONDS).alias("window_start"),
              ((F.col("pos") + 1) * SLIDE_SECONDS).alias("window_end"),
              total.alias("sum"), F.col(f"c{i}").alias("count"),
              F.col(f"t{i}").alias("event_timestamp"), (total / F.col(f"c{i}")).alias("avg")]
    fields += [v.alias(k) for k, v in (extra or {}).items()]
    return F.struct(*fields)


def home(df: DataFrame, chunk: int) -> DataFrame:
    """Keep each window end only in the chunk that owns it."""
    return df.where(floordiv("pos", chunk) == F.col(CHUNK))


def averages(df: DataFrame, key_cols: tuple[str, ...], n: int,
             extra: tuple[str, ...] = ()) -> DataFrame:
    """Level rows -> averages columns (window bounds in epoch seconds)."""
    total = from_units(F.col("s"))
    return df.select(
        *key_cols,
        ((F.col("pos") - (n - 1)) * SLIDE_SECONDS).alias("window_start"),
        ((F.col("pos") + 1) * SLIDE_SECONDS).alias("window_end"),
        total.alias("sum"),
        F.col("c").alias("count"),
        F.col("t").alias("event_timestamp"),
        (total / F.col("c")).alias("avg"),
        *extra)
