"""Batch plans: readings -> pre-sum -> panes -> cascade -> medians ->
predictions, for any entity and option set.

Shuffles of the whole plan, independent of the number of levels:
1. pre-sum and panes in one aggregate on (key, pane), combined map-side first
   (two aggregates, on (key, second) and (key, pane), only where the pre-sum key
   is not the window key or the pre-sum is the rolling one);
2. one exchange on (key, time chunk) that serves every cascade level and the
   trailing median windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_OPTIONS, FULL_KEY, LEVEL_MINUTES, SLIDE_SECONDS, Entity, Options
from ..operators.median import (add_medians, history_frame, with_median,
                                with_median_all_history)
from ..operators.presum import (count_bits, from_units, panes, panes_of_seconds, presum, restrict, rolled_up,
                                second_bits, with_units)
from ..operators.windows import (CHUNK, averages, cascade, cascade_wide, home, level_struct, lookback,
                                 panes_per_window)


def _chain_for(levels: tuple[int, ...]) -> list[int]:
    """Cascade levels from 1 minute up to the deepest requested level."""
    deepest = max(LEVEL_MINUTES.index(m) for m in levels)
    return list(LEVEL_MINUTES[:deepest + 1])


def entity_panes(readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    if options.presum == "final" and entity.presum_cols == entity.key_cols:
        return panes_of_seconds(readings, entity, options)
    return panes(presum(readings, entity, options), entity.key_cols)


def _halo(chain: list[int], levels: tuple[int, ...], options: Options, medians: bool) -> int:
    look = lookback([panes_per_window(m) for m in chain])
    halo = look[-1]
    if medians and options.retention and options.median_mode == "history":
        halo = max([halo] + [look[i] + history_frame(m, options.include_current)[0]
                             for i, m in enumerate(chain) if m in levels])
    return halo


def all_levels(readings: DataFrame | None, entity: Entity, levels: tuple[int, ...] = LEVEL_MINUTES,
               options: Options = DEFAULT_OPTIONS, medians: bool = False,
               pane_rows: DataFrame | None = None) -> DataFrame:
    """Averages (and ``median_load``) of several levels in long format with
    ``window_minutes``, from ONE pass of the cascade: one exchange, every
    level's windows computed once, all medians in the same partitions, one
    ``explode`` to long format (no union of per-level branches)."""
    chain = _chain_for(levels)
    n = [panes_per_window(m) for m in chain]
    if pane_rows is None:
        pane_rows = entity_panes(readings, entity, options)
    chunk = options.chunk_panes
    wide = cascade_wide(pane_rows, entity.key_cols, n, chunk, _halo(chain, levels, options, medians),
                        options.cascade_partitions)
    part = list(entity.key_cols) + [CHUNK]
    idx = {m: i for i, m in enumerate(chain) if m in levels}
    with_med = medians and options.retention
    if with_med:
        wide = add_medians(wide, {f"med{i}": (from_units(F.col(f"s{i}")) / F.col(f"c{i}"), m)
                                  for m, i in idx.items()}, part, options)
    per_level = [F.struct(F.lit(m).alias("window_minutes"),
                          level_struct(i, n[i], {"median_load": F.col(f"med{i}")} if with_med else None).alias("v"))
                 for m, i in idx.items()]
    keys = list(entity.key_cols)
    long = (home(wide.select(*part, "pos", F.array(*per_level).alias("levels")), chunk)
            .select(*keys, F.explode("levels").alias("x"))
            .where(F.col("x.v.count").isNotNull())
            .select(*keys, "x.window_minutes", "x.v.*"))
    if medians and not options.retention:
        if options.median_mode == "history" and options.median_exact:
            long = with_median_all_history(long, keys + ["window_minutes"], options, order="window_end")
        else:
            long = add_medians(long, {"median_load": (F.col("avg"), 0)}, keys + ["window_minutes"],
                               options, order="window_end")
    return long


def level_frames(readings: DataFrame, entity: Entity, levels: tuple[int, ...],
                 options: Options = DEFAULT_OPTIONS, medians: bool = False,
                 pane_rows: DataFrame | None = None) -> dict[int, DataFrame]:
    """Averages (and optionally ``median_load``) for each requested cascade
    level, as ``{minutes: DataFrame}``. All levels share one plan prefix."""
    chain = _chain_for(levels)
    n = [panes_per_window(m) for m in chain]
    halo = _halo(chain, levels, options, medians)
    if pane_rows is None:
        pane_rows = entity_panes(readings, entity, options)
    frames = cascade(pane_rows, entity.key_cols, n, options.chunk_panes, halo=halo,
                     partitions=options.cascade_partitions)
    part = list(entity.key_cols) + [CHUNK]
    out = {}
    for i, m in enumerate(chain):
        if m not in levels:
            continue
        df = averages(frames[i], entity.key_cols, n[i], extra=(CHUNK, "pos"))
        if medians and options.retention:
            df = with_median(df, part, m, options)
            df = home(df, options.chunk_panes)
        else:
            df = home(df, options.chunk_panes)
            if medians and options.median_mode == "history" and options.median_exact:
                df = with_median_all_history(df.drop(CHUNK), list(entity.key_cols), options)
            elif medians:
                df = with_median(df, list(entity.key_cols), m, options)
        out[m] = df.drop(CHUNK, "pos") if CHUNK in df.columns else df.drop("pos")
    return out


def level_averages(readings: DataFrame, entity: Entity, minutes: int,
                   options: Options = DEFAULT_OPTIONS) -> DataFrame:
    return level_frames(readings, entity, (minutes,), options)[minutes]


def predictions(readings: DataFrame, entity: Entity, levels: tuple[int, ...] = LEVEL_MINUTES,
                options: Options = DEFAULT_OPTIONS) -> DataFrame:
    """Predictions of all requested levels (one cascade pass)."""
    return as_predictions(all_levels(readings, entity, levels, options, medians=True), entity)


def reach(levels: tuple[int, ...], options: Options) -> tuple[int, int]:
    """Panes that the windows and medians of the levels look back over, and so
    also how far ahead a pane is still seen."""
    back = _halo(_chain_for(levels), levels, options, medians=True)
    return back, back


def windows_from_panes(pane_rows: DataFrame, entity: Entity, levels: tuple[int, ...], options: Options,
                       first: int, last: int) -> DataFrame:
    """Averages with medians of all levels whose window's last pane is in
    ``first .. last``, from panes that reach back far enough."""
    rows = all_levels(None, entity, levels, options, medians=True, pane_rows=pane_rows)
    return rows.where(F.col("window_end").between((first + 1) * SLIDE_SECONDS, (last + 1) * SLIDE_SECONDS))


def as_predictions(df: DataFrame, entity: Entity) -> DataFrame:
    """Enriched averages with entity, full key and predicted value."""
    df = (df.withColumn("entity", F.lit(entity.name))
          .withColumn("sliding_window_ms", (F.col("window_minutes") * 60000).cast("long"))
          .withColumn("predicted_value", (F.col("avg") + F.col("median_load")) / F.lit(2.0)))
    return with_full_key(df, entity)


def with_full_key(df: DataFrame, entity: Entity) -> DataFrame:
    """Add the absent parts of the (house, household, plug) key as NULL."""
    for c in FULL_KEY:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("long"))
    return df


def tables_of(readings: DataFrame, fine: Entity, coarse: Entity, levels: tuple[int, ...] = LEVEL_MINUTES,
              options: Options = DEFAULT_OPTIONS) -> DataFrame:
    """Averages of two entities, the coarser one's panes rolled up from the finer
    one's, so that the readings are aggregated and shuffled once."""
    bits = second_bits(readings, fine, options)
    return (averages_table(None, fine, levels, options, count_bits(bits))
            .unionByName(averages_table(None, coarse, levels, options, rolled_up(bits, coarse))))


def averages_table(readings: DataFrame | None, entity: Entity, levels: tuple[int, ...] = LEVEL_MINUTES,
                   options: Options = DEFAULT_OPTIONS, pane_rows: DataFrame | None = None) -> DataFrame:
    """Rows of the averages store: ``entity, window_minutes`` + full key +
    window bounds + sum/count/event_timestamp/avg (one cascade pass)."""
    cols = ["entity", "window_minutes", *FULL_KEY, "window_start", "window_end",
            "sum", "count", "event_timestamp", "avg"]
    df = all_levels(readings, entity, levels, options, pane_rows=pane_rows).withColumn("entity", F.lit(entity.name))
    return with_full_key(df, entity).select(*cols)


def direct_averages(readings: DataFrame, key_cols: tuple[str, ...], minutes: int,
                    options: Options = DEFAULT_OPTIONS, with_timestamp: bool = False) -> DataFrame:
    """True N-minute sliding averages straight from the readings (no
    pre-sum, no cascade): sum and count of the readings in each window."""
    df = with_units(restrict(readings, options), options.value_scale)
    pane_rows = panes(df, key_cols)
    n = panes_per_window(minutes)
    frames = cascade(pane_rows, key_cols, [n], options.chunk_panes, halo=n - 1,
                     partitions=options.cascade_partitions)
    extra = (CHUNK, "pos")
    out = home(averages(frames[0], key_cols, n, extra=extra), options.chunk_panes)
    out = out.drop(*extra)
    return out if with_timestamp else out.drop("event_timestamp")
