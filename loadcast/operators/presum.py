"""Per-second pre-sum of readings and the 30-second pane aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SLIDE_SECONDS, Entity, Options
from ..sources.sensor import SENSOR_COLUMNS


def units_type(scale: int) -> str:
    return f"decimal(38,{scale})"


def to_units(value: Column, scale: int) -> Column:
    """Value as an exact decimal; NULL where it is no number that fits (NaN,
    infinite, too large)."""
    return value.try_cast(units_type(scale))


def from_units(units: Column) -> Column:
    """Nearest double of an exact decimal."""
    return units.cast("double")


def with_units(readings: DataFrame, scale: int) -> DataFrame:
    """Readings with ``u``, their value as an exact decimal; readings whose value
    does not fit are left out (:func:`unfit_counts` counts them)."""
    return readings.withColumn("u", to_units(F.col("value"), scale)).where(F.col("u").isNotNull())


def unfit_counts(readings: DataFrame, options: Options = Options()) -> DataFrame:
    """(reason, count) of the readings that the sums leave out ("nan",
    "infinite", "too_large") or take rounded to the scale ("too_fine")."""
    v = F.col("value")
    u = to_units(v, options.value_scale)
    reason = (F.when(v.isNull(), "null").when(F.isnan(v), "nan").when(F.abs(v) == float("inf"), "infinite")
              .when(u.isNull(), "too_large").when(from_units(u) != v, "too_fine"))
    return (restrict(readings, options).select(reason.alias("reason")).where("reason is not null")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("count")))


def floordiv(expr: str, n: int) -> Column:
    """Exact integer floor division of a SQL expression by a positive constant."""
    return F.expr(f"(({expr}) - pmod(({expr}), {n})) div {n}")


def restrict(readings: DataFrame, options: Options) -> DataFrame:
    """Optional property filter (absent from the live jobs, see Options)."""
    if options.property is None:
        return readings
    return readings.where(F.col("property") == options.property)


def presum(readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    """Total the readings of one entity per second.

    Output: the seven reading columns (``value`` = the total) plus ``u``, the
    total as an exact decimal. Fields outside the pre-sum key keep the values of
    the group's first reading (lowest ``id``).

    * ``final``   one row per (key, second): a partial/final hash aggregate,
      so a hot key is combined map-side before the shuffle.
    * ``rolling`` one row per reading carrying the running total of its
      (key, second) group in id order, as the streaming job emitted it.
    * ``none``    the readings unchanged.
    """
    df = with_units(restrict(readings, options), options.value_scale)
    by = list(entity.presum_cols) + ["timestamp"]
    kept = [c for c in SENSOR_COLUMNS if c not in by and c not in ("value", "id")]
    if options.presum == "none":
        return df.select(*SENSOR_COLUMNS, "u")
    if options.presum == "final":
        agg = df.groupBy(*by).agg(
            F.sum("u").alias("u"),
            F.min("id").alias("id"),
            *[F.min_by(c, "id").alias(c) for c in kept])
        return agg.select(*[c if c != "value" else from_units(F.col("u")).alias("value")
                            for c in SENSOR_COLUMNS], "u")
    if options.presum == "rolling":
        out = running_total(df, by, "id", "u", kept)
        return out.select(*[c if c != "value" else from_units(F.col("u")).alias("value")
                            for c in SENSOR_COLUMNS], "u")
    raise ValueError(f"unknown presum mode {options.presum!r}")


# Rows per id bucket of the two-level running total (bounds one window task).
RUNNING_BUCKET = 1 << 16


def running_total(df: DataFrame, group: list[str], order: str, value: str,
                  first_of: list[str] = (), bucket: int = RUNNING_BUCKET) -> DataFrame:
    """Running ``sum(value)`` per ``group`` in ``order`` (unique), plus the
    group's first row's ``first_of`` fields, without ever putting a whole
    group into one task:

    1. split each group into buckets of ``bucket`` consecutive order values;
       a window per (group, bucket) gives the running sum inside the bucket;
    2. per (group, bucket): bucket total and first row (a map-side combined
       aggregate); a window over the buckets of a group (``1/bucket`` of the
       rows) turns totals into offsets and finds the group's first row;
    3. equi-join back on (group, bucket) -- fine-grained keys -- and add.
    """
    b = floordiv(order, bucket)
    df = df.withColumn("_b", b)
    w_in = (Window.partitionBy(*group, "_b").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn("_run", F.sum(value).over(w_in))
    firsts = [F.min_by(F.col(c), F.col(order)).alias(f"_f_{c}") for c in first_of]
    per_bucket = df.groupBy(*group, "_b").agg(F.sum(value).alias("_tot"),
                                              F.min(order).alias("_first_id"), *firsts)
    w_b = Window.partitionBy(*group).orderBy("_b")
    before = w_b.rowsBetween(Window.unboundedPreceding, -1)
    whole = w_b.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_bucket.select(
        *group, "_b",
        F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"),
        *[F.first(f"_f_{c}").over(whole).alias(f"_g_{c}") for c in first_of])
    out = df.drop(*first_of).join(offsets, [*group, "_b"])
    out = out.withColumn(value, F.col("_run") + F.col("_off"))
    for c in first_of:
        out = out.withColumnRenamed(f"_g_{c}", c)
    return out.drop("_b", "_run", "_off")


def panes(presummed: DataFrame, key_cols: tuple[str, ...]) -> DataFrame:
    """One row per (key, 30-s pane): exact sum ``s``, row count ``c``, latest
    timestamp ``t``; ``pos`` is the pane index (epoch seconds div 30)."""
    return (presummed
            .withColumn("pos", floordiv("timestamp", SLIDE_SECONDS))
            .groupBy(*key_cols, "pos")
            .agg(F.sum("u").alias("s"), F.count(F.lit(1)).alias("c"),
                 F.max("timestamp").alias("t")))


def second_bits(readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    """Panes with ``bits``, a bit per second of the pane that has a reading."""
    second = F.expr(f"shiftleft(1, cast(pmod(timestamp, {SLIDE_SECONDS}) as int))")
    return (with_units(restrict(readings, options), options.value_scale)
            .withColumn("pos", floordiv("timestamp", SLIDE_SECONDS))
            .groupBy(*entity.key_cols, "pos")
            .agg(F.sum("u").alias("s"), F.bit_or(second).alias("bits"), F.max("timestamp").alias("t")))


def count_bits(panes_with_bits: DataFrame) -> DataFrame:
    return (panes_with_bits.withColumn("c", F.bit_count("bits").cast("long"))
            .select(*[c for c in panes_with_bits.columns if c not in ("s", "bits", "t")], "s", "c", "t"))


def panes_of_seconds(readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    """The panes of the ``final`` pre-sum in one aggregate, for entities whose
    pre-sum key is their window key: a pane's sum needs no second totals, and the
    number of its distinct seconds is the number of bits set by them."""
    return count_bits(second_bits(readings, entity, options))


def rolled_up(panes_with_bits: DataFrame, entity: Entity) -> DataFrame:
    """Panes of a coarser entity from those of a finer one."""
    return count_bits(panes_with_bits.groupBy(*entity.key_cols, "pos")
                      .agg(F.sum("s").alias("s"), F.bit_or("bits").alias("bits"), F.max("t").alias("t")))
