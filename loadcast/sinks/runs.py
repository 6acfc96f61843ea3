"""A store that runs are added to: panes and reading ids of every run, averages
by commit, and a log that says which of them count.

Layout::

    panes/entity=E/day=D/generation=G               panes of one attempt of a run
    ids/entity=E/generation=Go, Gh                  ids of the readings it was offered, and of those it
                                                    held where others had some, as bitmaps
    averages/entity=E/window_minutes=M/day=D/generation=G
    log/entity=E                                    one file a commit

An attempt writes under a generation name of its own and becomes visible by its
commit: one Parquet file with a row per run and day that changes. Readers see the
snapshot of the last commit, so what an attempt wrote before it broke off is never
read, and a run replaced by one with fewer days leaves nothing behind.

A pane keeps the bits of its seconds, so the panes of runs merge by ``bit_or``: a
second that two runs share counts once. A reading counts once by its id: a run
leaves out the readings that another run has stored. Bitmaps of 32,768 ids are
compared by bucket first; the readings themselves are only joined where a bucket
is stored twice. A run that others left readings to can be replaced only by one
that still has all its ids.

One writer per store and entity at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SLIDE_SECONDS, Entity, Options
from ..operators.presum import panes, presum, restrict, second_bits
from .store import DAY_PANES, STORE_COLS, STORE_PARTITIONS, retain, spread_by_day, with_day

LOG_SCHEMA = ("version long, kind string, run string, generation string, day long, live boolean, first long, last long, "
              "ids string, left_to array<string>")
STORE_SCHEMA = ("entity string, window_minutes int, house_id long, household_id long, plug_id long, window_start long, "
                "window_end long, sum double, count long, event_timestamp long, avg double")


def new_generation() -> str:
    return f"g{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Run:
    """A live run: its generation, first and last pane, where the ids are that it
    holds, and the runs that hold readings which this one left out."""
    generation: str
    first: int | None
    last: int | None
    ids: str | None = None
    left_to: tuple[str, ...] = ()


@dataclass
class Snapshot:
    version: int = 0
    runs: dict[str, Run] = field(default_factory=dict)
    days: dict[int, str] = field(default_factory=dict)   # day -> generation of its averages
    floor: int | None = None                             # panes before this one have expired


class Store:
    """One entity's part of a store."""

    def __init__(self, spark: SparkSession, path: str, entity: Entity):
        self.spark, self.path, self.entity = spark, path.rstrip("/"), entity

    def dir(self, what: str) -> str:
        return f"{self.path}/{what}/entity={self.entity.name}"

    def _read(self, what: str, schema: str, sub: str = "") -> DataFrame:
        """A part of the store, empty where there is none yet."""
        root = self.dir(what)
        try:
            return self.spark.read.schema(schema).option("basePath", root).parquet(root + sub)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------------- log
    def snapshot(self, version: int | None = None) -> Snapshot:
        """State after the last commit, or after an earlier one."""
        rows = self._read("log", LOG_SCHEMA)
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        out = Snapshot()
        for r in sorted(rows.collect(), key=lambda r: r["version"]):  # a row per run and day of a commit
            out.version = r["version"]
            if r["kind"] == "run":
                out.runs.pop(r["run"], None)
                if r["live"]:
                    out.runs[r["run"]] = Run(r["generation"], r["first"], r["last"], r["ids"], tuple(r["left_to"] or ()))
            elif r["kind"] == "day":
                out.days.pop(r["day"], None)
                if r["live"]:
                    out.days[r["day"]] = r["generation"]
            else:
                out.floor = r["first"]
        return out

    def commit(self, base: Snapshot, rows: list[dict]) -> None:
        """Make the rows visible, all at once: one file."""
        names = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
        data = [tuple({"version": base.version + 1, **r}.get(n) for n in names) for r in rows]
        self.spark.createDataFrame(data, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.dir("log"))

    # ------------------------------------------------------------------- ids
    def _ids(self, generations: list[str]) -> DataFrame:
        return (self._read("ids", "bucket long, bits binary, generation string")
                .where(F.col("generation").isin(generations)))

    def write_ids(self, readings: DataFrame, generation: str) -> None:
        (readings.where("id is not null").groupBy(F.bitmap_bucket_number("id").alias("bucket"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
         .write.parquet(f"{self.dir('ids')}/generation={generation}"))

    def shared_buckets(self, generation: str, others: list[str]) -> DataFrame:
        """Ids of one set that others have too: (bucket, bits, owners)."""
        mine = self._ids([generation]).select("bucket", F.col("bits").alias("own"))
        common = (self._ids(others).join(mine, "bucket")
                  .select("bucket", "generation", F.explode(F.array("bits", "own")).alias("x"))
                  .groupBy("bucket", "generation").agg(F.bitmap_and_agg("x").alias("bits")))
        return (common.where(F.bitmap_count("bits") > 0).groupBy("bucket")
                .agg(F.bitmap_or_agg("bits").alias("bits"), F.collect_set("generation").alias("owners")))

    def unseen(self, readings: DataFrame, shared: DataFrame) -> DataFrame:
        """Readings whose id is in none of the shared buckets' bitmaps."""
        at = F.bitmap_bit_position("id")
        byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        stored = shared.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
        return (readings.join(stored, F.bitmap_bucket_number("id") == F.col("_bucket"), "left")
                .where(F.col("_bits").isNull() | (F.getbit(byte, (at % 8).cast("int")) == 0)).drop("_bucket", "_bits"))

    def lost_ids(self, old: str, new: str) -> int:
        """Number of ids of one set that another does not have."""
        n = lambda g: F.coalesce(F.sum(F.when(F.col("generation") == g, F.bitmap_count("bits"))), F.lit(0))
        rows = self._ids([old, new])
        had = rows.agg(n(new).alias("new")).first()["new"]
        union = rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).agg(F.sum(F.bitmap_count("bits")).alias("n")).first()["n"]
        return (union or 0) - had

    # ----------------------------------------------------------------- panes
    @property
    def pane_schema(self) -> str:
        return ", ".join(f"{c} long" for c in self.entity.key_cols) + (
            ", pos long, s {units}, bits int, c long, t long, day long, generation string")

    def write_panes(self, rows: DataFrame, generation: str) -> None:
        day = F.expr(f"(pos - pmod(pos, {DAY_PANES})) div {DAY_PANES}")
        (rows.withColumn("day", day).withColumn("generation", F.lit(generation))
         .write.mode("append").partitionBy("day", "generation").parquet(self.dir("panes")))

    def _panes(self, options: Options, days: list[int] | None, generations: list[str]) -> DataFrame:
        sub = "" if days is None else f"/day={{{','.join(map(str, days))}}}"
        schema = self.pane_schema.replace("{units}", f"decimal(38,{options.value_scale})")
        return self._read("panes", schema, sub).where(F.col("generation").isin(generations))

    def pane_days(self, generation: str, first: int, last: int, options: Options) -> list[int]:
        rows = self._panes(options, list(range(first // DAY_PANES, last // DAY_PANES + 1)), [generation])
        return sorted(r["day"] for r in rows.select("day").distinct().collect())

    def read_panes(self, options: Options, snapshot: Snapshot, days: list[int] | None = None) -> DataFrame:
        """Panes of all live runs on the given days, one row per key and pane."""
        live = [r.generation for r in snapshot.runs.values()
                if r.first is not None and (days is None or (r.first // DAY_PANES <= days[-1] and r.last // DAY_PANES >= days[0]))]
        rows = self._panes(options, days, live)
        if snapshot.floor is not None:
            rows = rows.where(F.col("pos") >= snapshot.floor)
        return (rows.groupBy(*self.entity.key_cols, "pos")
                .agg(F.sum("s").alias("s"), F.coalesce(F.bit_count(F.bit_or("bits")).cast("long"), F.sum("c")).alias("c"),
                     F.max("t").alias("t")))

    # -------------------------------------------------------------- averages
    def write_averages(self, rows: DataFrame, generation: str) -> None:
        """Averages of whole days under a generation; the commit names the days."""
        out = spread_by_day(with_day(rows.select(*STORE_COLS))).withColumn("generation", F.lit(generation))
        out.write.mode("append").partitionBy(*STORE_PARTITIONS, "day", "generation").parquet(f"{self.path}/averages")

    def averages(self, minutes: int | None = None, since: int | None = None, version: int | None = None) -> DataFrame:
        """Averages of a snapshot (by default the last). Window length and day
        prune directories; ``since`` bounds the windows' ends from below."""
        live = list(self.snapshot(version).days.items())
        if since is not None:
            live = [(d, g) for d, g in live if d >= (since // SLIDE_SECONDS - 1) // DAY_PANES]
        schema = STORE_SCHEMA + ", day long, generation string"
        root = f"{self.path}/averages"
        try:
            rows = self.spark.read.schema(schema).option("basePath", root).parquet(f"{root}/entity={self.entity.name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        named = self.spark.createDataFrame(live, "day long, generation string")  # a row a day
        rows = rows.join(F.broadcast(named), ["day", "generation"], "left_semi")
        if minutes is not None:
            rows = rows.where(F.col("window_minutes") == minutes)
        if since is not None:
            rows = rows.where(F.col("window_end") >= since)
        return rows.select(*STORE_COLS)

    # ------------------------------------------------------------- retention
    def expire(self, now_s: int, back: int, extra_s: int = 5) -> None:
        """Commit a state without averages that have outlived their window length
        plus ``extra_s`` at ``now_s``, and without panes that no window or median
        ending from then on looks back to (``back`` panes)."""
        base = self.snapshot()
        generation = new_generation()
        alive = retain(self.averages(), now_s, extra_s)
        self.write_averages(alive, generation)
        kept = {r["day"] for r in with_day(alive).select("day").distinct().collect()}
        floor = now_s // SLIDE_SECONDS - back
        rows = [{"kind": "day", "day": d, "live": d in kept, "generation": generation} for d in base.days]
        rows += [{"kind": "run", "run": n, "live": False} for n, r in base.runs.items() if r.last is not None and r.last < floor]
        self.commit(base, [*rows, {"kind": "floor", "first": floor}])

    def vacuum(self) -> int:
        """Delete the generations that the last snapshot does not name; returns the
        number of folders deleted. Not while a run or a reader is at work."""
        now = self.snapshot()
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = 0
        live, ids = ({getattr(r, x) for r in now.runs.values()} for x in ("generation", "ids"))
        for what, depth, keep in (("panes", "day=*/", live), ("ids", "", ids), ("averages", "window_minutes=*/day=*/", set(now.days.values()))):
            pattern = fs_path(f"{self.dir(what)}/{depth}generation=*")
            fs = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.globStatus(pattern) or ():
                path = status.getPath()
                name = path.getName().split("=", 1)[1]
                day = path.getParent().getName().split("=")[-1]
                stale = what == "averages" and name in keep and now.days.get(int(day)) != name
                old = what == "panes" and now.floor is not None and (int(day) + 1) * DAY_PANES <= now.floor
                if name not in keep or stale or old:
                    gone += bool(fs.delete(path, True))
        return gone


def run_panes(readings: DataFrame, entity: Entity, options: Options) -> DataFrame:
    """Panes as they are stored: with the bits of their seconds where the pre-sum is
    of the window key, else with a count (such panes add up over runs)."""
    if options.presum == "final" and entity.presum_cols == entity.key_cols:
        return second_bits(readings, entity, options).withColumn("c", F.lit(None).cast("long")).select(
            *entity.key_cols, "pos", "s", "bits", "c", "t")
    return panes(presum(readings, entity, options), entity.key_cols).select(
        *entity.key_cols, "pos", "s", F.lit(None).cast("int").alias("bits"), "c", "t")


@dataclass(frozen=True)
class Added:
    """An attempt that is written but not committed."""
    base: Snapshot
    after: Snapshot
    generation: str
    run_row: dict
    changed: tuple[int, ...]   # days whose panes differ


def add_run(store: Store, readings: DataFrame, options: Options, run: str | None = None, track_ids: bool = True) -> Added:
    """Write the panes (and ids) of a run as a new generation. Readings that other
    runs have stored are left out, by id, unless ``track_ids`` is false: then runs
    must not overlap, and the readings are read once."""
    base = store.snapshot()
    name, generation = run or f"run-{base.version + 1}", new_generation()
    others = {n: r for n, r in base.runs.items() if n != name}
    readings = restrict(readings, options)
    left_to: tuple[str, ...] = ()
    ids = None
    if track_ids:
        ids = f"{generation}o"
        store.write_ids(readings, ids)
        replaced = base.runs.get(name)
        dependants = sorted(n for n, r in others.items() if name in r.left_to)
        if replaced and replaced.ids and dependants and (lost := store.lost_ids(replaced.ids, ids)):
            raise ValueError(f"run {name!r} would lose {lost} ids; {dependants} left readings to it: replace these first")
        shared = store.shared_buckets(ids, [r.ids for r in others.values() if r.ids]).persist()
        try:
            owners = {r["g"] for r in shared.select(F.explode("owners").alias("g")).distinct().collect()}  # runs
            left_to = tuple(sorted(n for n, r in others.items() if r.ids in owners))
            if owners:
                readings, ids = store.unseen(readings, shared), f"{generation}h"
                store.write_ids(readings, ids)
            store.write_panes(run_panes(readings, store.entity, options), generation)
        finally:
            shared.unpersist()
    else:
        store.write_panes(run_panes(readings, store.entity, options), generation)
    seen = (store._panes(options, None, [generation]).agg(F.min("pos").alias("first"), F.max("pos").alias("last"),
                                                          F.collect_set("day").alias("days")).first())
    days = set(seen["days"])
    old = base.runs.get(name)
    if old and old.first is not None:
        days |= set(store.pane_days(old.generation, old.first, old.last, options))
    row = {"kind": "run", "run": name, "generation": generation, "live": True, "first": seen["first"], "last": seen["last"],
           "ids": ids, "left_to": list(left_to)}
    after = Snapshot(base.version + 1, {**others, name: Run(generation, seen["first"], seen["last"], ids, left_to)}, base.days, base.floor)
    return Added(base, after, generation, row, tuple(sorted(days)))


def drop_partitions(spark: SparkSession, path: str, entity: Entity, days: list[int], keep: set[tuple[int, int]]) -> None:
    """Delete the document folders of an entity's days, but for the (window length,
    day) ones in ``keep``."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    wanted = ",".join(map(str, days))
    pattern = fs_path(f"{path}/entity={entity.name}/window_minutes=*/day={{{wanted}}}")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in (fs.globStatus(pattern) or ()) if days else ():
        p = status.getPath()
        key = (int(p.getParent().getName().split("=")[1]), int(p.getName().split("=")[1]))
        if key not in keep:
            fs.delete(p, True)
