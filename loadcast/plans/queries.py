"""Registered queries: one per operator of the inventory, each a Spark plan
over the driver's test tables plus the matching oracle SQL.

Every query reads the whole ``events`` table (through the sensor adapter) and
nothing else. Where a text/CSV path is exercised, the lines are derived from
all readings; a few are made malformed *by rule* (``id % 20`` picks which
defect a line gets) -- every reading still yields one line.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HOUSE, HOUSE_NAME, PLUG, PLUG_AS_WRITTEN, PLUG_NAME, PLUG_ONLY, Options
from ..functions.docs import parse_prediction, parse_raw, prediction_json, raw_json
from ..functions.keys import key_parse, key_string, scaled_avg, value_parse
from ..functions.text import cleanse, tokenize_ws
from ..operators.median import median_of_store
from ..operators.presum import presum, unfit_counts
from ..session import scratch_path
from ..sinks.store import compact, kafka_records, read_averages, write_averages
from ..sources.sensor import (ADAPTER_SQL, SENSOR_COLUMNS, decode_kafka, dropped_lines, load_sensor, parse_lines, read_text,
                              rebase_event_time, sensor_from_testdata)
from . import oracle as O
from .pipeline import (all_levels, averages_table, direct_averages, level_averages, level_frames,
                       predictions, tables_of, with_full_key)

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
ORACLE: dict[str, str] = {}

REBASE_INSTANT = 1735689600          # 2025-01-01T00:00:00Z
PREDICTION_NOW_MS = 1735689600000    # fixed wall clock for documents
HOUSE_KEY = HOUSE.key_cols
PLUG_KEY = PLUG.key_cols
AVG = ["window_start", "window_end", "sum", "count", "event_timestamp", "avg"]


def register(name: str, sql: str | None = None):
    def deco(fn: Q) -> Q:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_from_testdata(spark, sf)


# ----------------------------------------------------------------- sources
register("scan_sensor", O.with_(O.READINGS) + "SELECT * FROM readings")(readings)


@register("rebase_event_time", O.with_(O.READINGS) + (
    f"SELECT id, timestamp + ({REBASE_INSTANT} - (SELECT min(timestamp) FROM readings)) AS timestamp, "
    "value, property, plug_id, household_id, house_id FROM readings"))
def _rebase(spark, sf):
    return rebase_event_time(readings(spark, sf), REBASE_INSTANT)


# ----------------------------------------------------------------- pre-sum
_KEPT = ("property", "plug_id", "household_id")


def _presum_sql(group, kept, rolling=False):
    u_sum = f"sum({O.U})"
    if rolling:
        w = f"OVER (PARTITION BY {', '.join(group)}, timestamp ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        cols = ", ".join(f"first_value({c}) {w} AS {c}" for c in kept)
        return O.with_(O.READINGS) + (
            f"SELECT id, timestamp, {O.dbl(u_sum + ' ' + w)} AS value, {cols}, {', '.join(group)} FROM readings")
    cols = ", ".join(f"arg_min({c}, id) AS {c}" for c in kept)
    return O.with_(O.READINGS) + (
        f"SELECT min(id) AS id, timestamp, {O.dbl(u_sum)} AS value, {cols}, {', '.join(group)} "
        f"FROM readings GROUP BY {', '.join(group)}, timestamp")


def _presum_q(entity, mode):
    def q(spark, sf):
        return presum(readings(spark, sf), entity, Options(presum=mode)).select(*SENSOR_COLUMNS)
    return q


register("house_presum", _presum_sql(["house_id"], _KEPT))(_presum_q(HOUSE, "final"))
register("house_presum_rolling", _presum_sql(["house_id"], _KEPT, rolling=True))(_presum_q(HOUSE, "rolling"))
register("plug_presum", _presum_sql(list(PLUG_KEY), ("property",)))(_presum_q(PLUG, "final"))
register("plug_presum_as_written", _presum_sql(["house_id", "plug_id"], ("property", "household_id")))(
    _presum_q(PLUG_AS_WRITTEN, "final"))


# ----------------------------------------------------------------- windows
def _level_q(entity, minutes, opts=Options()):
    def q(spark, sf):
        return level_averages(readings(spark, sf), entity, minutes, opts)
    return q


register("avg_1min_house", O.level_sql(HOUSE_KEY, 1))(_level_q(HOUSE, 1))
register("avg_1min_plug", O.level_sql(PLUG_KEY, 1))(_level_q(PLUG, 1))
register("house_load_only", O.level_sql(HOUSE_KEY, 1, prop=1))(_level_q(HOUSE, 1, Options(property=1)))
for _m in (5, 15, 60, 120):
    register(f"cascade_{_m}min_house", O.level_sql(HOUSE_KEY, _m))(_level_q(HOUSE, _m))
for _m in (5, 15, 60, 120):
    register(f"cascade_{_m}min_plug", O.level_sql(PLUG_KEY, _m))(_level_q(PLUG, _m))


def _cascade_q(entity, opts=Options()):
    """All five levels in long format."""
    def q(spark, sf):
        return averages_table(readings(spark, sf), entity, _ALL, opts)
    return q


_ALL = (1, 5, 15, 60, 120)
register("cascade_house_nopresum", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, mode="none"))(
    _cascade_q(HOUSE, Options(presum="none")))
register("cascade_house_rolling", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, mode="rolling"))(
    _cascade_q(HOUSE, Options(presum="rolling")))
register("cascade_plug_as_written", O.multi_level_sql(PLUG_KEY, _ALL, PLUG_NAME, as_written=True))(
    _cascade_q(PLUG_AS_WRITTEN))


@register("cascade_plug_only", "SELECT * EXCLUDE (event_timestamp) FROM ("
          + O.multi_level_sql(("plug_id",), _ALL, PLUG_ONLY.name, mode="none") + ")")
def _plug_only(spark, sf):
    return _cascade_q(PLUG_ONLY, Options(presum="none"))(spark, sf).drop("event_timestamp")


def _direct_q(minutes):
    def q(spark, sf):
        return direct_averages(readings(spark, sf), HOUSE_KEY, minutes)
    return q


for _m in (1, 5, 15, 60, 120):
    register(f"direct_avg_{_m}min_house", O.direct_sql(HOUSE_KEY, _m))(_direct_q(_m))


# ----------------------------------------------------------------- medians, predictions
def _enriched_q(entity, minutes, opts=Options()):
    def q(spark, sf):
        return level_frames(readings(spark, sf), entity, (minutes,), opts, medians=True)[minutes]
    return q


register("median_history_house", O.level_sql(HOUSE_KEY, 1, median={}))(_enriched_q(HOUSE, 1))
register("median_history_plug", O.level_sql(PLUG_KEY, 1, median={}))(_enriched_q(PLUG, 1))
register("median_all_history_house", O.level_sql(HOUSE_KEY, 1, median={"retention": False}))(
    _enriched_q(HOUSE, 1, Options(retention=False)))
register("median_history_5min_house_current", O.level_sql(HOUSE_KEY, 5, median={"include_current": True}))(
    _enriched_q(HOUSE, 5, Options(include_current=True)))
register("median_history_1min_house_scaled", O.level_sql(HOUSE_KEY, 1, median={"scale": 1000.0}))(
    _enriched_q(HOUSE, 1, Options(median_scale=1000.0)))


@register("enrich_house", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, median={}))
def _enrich(spark, sf):
    df = all_levels(readings(spark, sf), HOUSE, _ALL, Options(), medians=True)
    return with_full_key(df, HOUSE).withColumn("entity", F.lit(HOUSE_NAME))


register("predict_house", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, median={}, predict=True))(
    lambda spark, sf: predictions(readings(spark, sf), HOUSE, _ALL))
register("predict_plug", O.multi_level_sql(PLUG_KEY, _ALL, PLUG_NAME, median={}, predict=True))(
    lambda spark, sf: predictions(readings(spark, sf), PLUG, _ALL))
register("predict_house_zero_median",
         O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, median={}, predict=True)
         .replace("coalesce(median(avg)", "0.0 * coalesce(median(avg)"))(
    lambda spark, sf: predictions(readings(spark, sf), HOUSE, _ALL, Options(median_mode="zero")))


# ----------------------------------------------------------------- store
def _table_sql():
    h = O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME)
    p = O.multi_level_sql(PLUG_KEY, _ALL, PLUG_NAME)
    return f"SELECT * FROM ({h}) UNION ALL SELECT * FROM ({p})"


@register("averages_table", _table_sql())
def _averages_table(spark, sf):
    return tables_of(readings(spark, sf), PLUG, HOUSE, _ALL)


_STORE_COLS = ["entity", "window_minutes", "house_id", "household_id", "plug_id",
               "window_start", "window_end", "sum", "count", "event_timestamp", "avg"]


@register("averages_sorted", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME))
def _averages_sorted(spark, sf):
    path = scratch_path(spark, "averages-sorted")
    write_averages(averages_table(readings(spark, sf), HOUSE, _ALL), path, mode="overwrite",
                   sort_by_value=True)
    return read_averages(spark, path).select(*_STORE_COLS)


@register("median_store", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, median={}))
def _median_store(spark, sf):
    path = scratch_path(spark, "averages")
    write_averages(averages_table(readings(spark, sf), HOUSE, _ALL), path, mode="overwrite")
    per_level = [median_of_store(read_averages(spark, path, entity=HOUSE_NAME, minutes=m).select(*_STORE_COLS), HOUSE_KEY, m, Options())
                 for m in _ALL]
    return reduce(DataFrame.unionByName, per_level)


_DOC_COLS = ("house_id, household_id, plug_id, \"sum\", \"count\", avg, event_timestamp, median_load, entity, "
             f"sliding_window_ms, predicted_value, CAST({PREDICTION_NOW_MS} AS BIGINT) AS timestamp")


def _docs_sql(keys, name, mode="final"):
    return f"SELECT {_DOC_COLS} FROM ({O.multi_level_sql(keys, _ALL, name, mode=mode, median={}, predict=True)})"


@register("store_two_runs", _docs_sql(HOUSE_KEY, HOUSE_NAME))
def _store_two_runs(spark, sf):
    """The batch job on the earlier half of the readings, then on the later half,
    then on the earlier half again, into one store: the documents are those of
    one run over all readings."""
    from .jobs import averaging_job
    r = readings(spark, sf)
    ends = r.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    middle = ((ends["a"] or 0) + (ends["b"] or 0)) // 2
    root = scratch_path(spark, "two-runs")
    early, late = r.where(F.col("timestamp") < middle), r.where(F.col("timestamp") >= middle)
    for part in (early, late, early):
        averaging_job(spark, part, HOUSE, f"{root}/store", f"{root}/docs", now_ms=PREDICTION_NOW_MS)
    return parse_prediction(spark.read.json(f"{root}/docs"))


@register("store_split_runs", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME))
def _store_split_runs(spark, sf):
    """Runs that share seconds and readings: a run three days off, replaced under its
    name by the plugs of even numbers; those of odd numbers; all plugs. The store is
    that of one run over all readings, counts of distinct seconds included."""
    from ..sinks.runs import Store
    from .jobs import averaging_job
    r = readings(spark, sf)
    root = scratch_path(spark, "split-runs")
    even = F.col("plug_id") % 2 == 0
    off = r.withColumn("timestamp", F.col("timestamp") + F.when(F.col("id") % 2 == 0, 3 * 86400).otherwise(0))
    for part, name in ((off.where(even), "evens"), (r.where(even), "evens"), (r.where(~even), None), (r, None)):
        averaging_job(spark, part, HOUSE, root, None, run_id=name)
    return Store(spark, root, HOUSE).averages().select(*_STORE_COLS)


@register("debug_stages", O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME, median={}, predict=True))
def _debug_stages(spark, sf):
    """The prediction stage of the house job, read back from its debug dump."""
    from .jobs import averaging_job
    root = scratch_path(spark, "debug")
    r = readings(spark, sf)
    averaging_job(spark, r, HOUSE, f"{root}/store", None, debug_dir=f"{root}/dump", track_ids=False)
    plan = predictions(r, HOUSE, _ALL)
    schema = {f.name: f.dataType for f in plan.schema.fields}
    dump = spark.read.option("header", "true").csv(f"{root}/dump/house/predictions")
    return dump.select(*[F.col(c).cast(schema[c]).alias(c) for c in plan.columns])


def _alive_sql():
    h = O.multi_level_sql(HOUSE_KEY, _ALL, HOUSE_NAME)
    return (f"SELECT * FROM ({h}) WHERE window_end >= (SELECT max(timestamp) FROM ({ADAPTER_SQL})) - 5 - window_minutes * 60")


@register("store_retention", _alive_sql())
def _store_retention(spark, sf):
    """Averages still alive at the last reading, after compaction."""
    r = readings(spark, sf)
    root = scratch_path(spark, "retention")
    write_averages(averages_table(r, HOUSE, _ALL), f"{root}/all", mode="overwrite")
    compact(spark, f"{root}/all", f"{root}/alive", now_s=r.agg(F.max("timestamp")).first()[0])
    return spark.read.parquet(f"{root}/alive").select(*_STORE_COLS)


# ----------------------------------------------------------------- scalar functions
def _level1_both(spark, sf):
    r = readings(spark, sf)
    h = with_full_key(level_averages(r, HOUSE, 1), HOUSE)
    p = level_averages(r, PLUG, 1)
    return h.unionByName(p)


def _level1_both_sql(cols):
    h = O.level_sql(HOUSE_KEY, 1)
    p = O.level_sql(PLUG_KEY, 1)
    return (f"SELECT {cols} FROM (SELECT house_id, CAST(NULL AS BIGINT) AS household_id, "
            f"CAST(NULL AS BIGINT) AS plug_id, window_end, avg FROM ({h}) "
            f"UNION ALL SELECT house_id, household_id, plug_id, window_end, avg FROM ({p}))")


_KS_SQL = "concat_ws('|', house_id, household_id, plug_id)"
_KS_AW_SQL = ("concat(coalesce(CAST(house_id AS VARCHAR), ''), "
              "CASE WHEN household_id IS NOT NULL THEN '|' ELSE '' END, CAST(coalesce(household_id, -1) AS VARCHAR), "
              "CASE WHEN plug_id IS NOT NULL THEN '|' ELSE '' END, CAST(coalesce(household_id, -1) AS VARCHAR))")


@register("key_string", _level1_both_sql(
    f"house_id, household_id, plug_id, window_end, {_KS_SQL} AS key, {_KS_AW_SQL} AS key_as_written"))
def _key_string(spark, sf):
    return _level1_both(spark, sf).select(
        "house_id", "household_id", "plug_id", "window_end",
        key_string().alias("key"), key_string(mode="as_written").alias("key_as_written"))


@register("key_parse", _level1_both_sql(
    f"window_end, {_KS_SQL} AS key, TRY_CAST(string_split({_KS_SQL}, '|')[1] AS BIGINT) AS house_id, "
    f"TRY_CAST(string_split({_KS_SQL}, '|')[2] AS BIGINT) AS household_id, "
    f"TRY_CAST(string_split({_KS_SQL}, '|')[3] AS BIGINT) AS plug_id"))
def _key_parse(spark, sf):
    ks = _level1_both(spark, sf).select("window_end", key_string().alias("key"))
    return ks.select("window_end", "key", key_parse(F.col("key")).alias("k")).select("window_end", "key", "k.*")


def _cell_spark(r: DataFrame) -> Column:
    return F.when(F.col("property") == 1, F.col("value").cast("decimal(18,2)").cast("string")) \
        .otherwise(F.concat_ws("|", F.col("house_id"), F.col("plug_id")))


_CELL_SQL = ("CASE WHEN property = 1 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) "
             "ELSE concat_ws('|', house_id, plug_id) END")


@register("value_parse", O.with_(O.READINGS) + (
    f"SELECT id, {_CELL_SQL} AS cell, coalesce(TRY_CAST({_CELL_SQL} AS DOUBLE), 0.0) AS \"sum\", "
    "CAST(1 AS BIGINT) AS \"count\", CAST(NULL AS BIGINT) AS event_timestamp FROM readings"))
def _value_parse(spark, sf):
    r = readings(spark, sf)
    return r.select("id", _cell_spark(r).alias("cell")) \
        .select("id", "cell", value_parse(F.col("cell")).alias("v")).select("id", "cell", "v.*")


@register("scaled_avg", f"SELECT house_id, window_end, avg, CAST(trunc(avg * 1000.0) AS BIGINT) AS scaled "
                        f"FROM ({O.level_sql(HOUSE_KEY, 1)})")
def _scaled(spark, sf):
    return level_averages(readings(spark, sf), HOUSE, 1).select(
        "house_id", "window_end", "avg", scaled_avg(F.col("avg")).alias("scaled"))


# ----------------------------------------------------------------- text / CSV path
def fixture_tokens(r: DataFrame) -> Column:
    """Tokens of one line per reading; by rule on ``id % 20`` a line gets a
    bad timestamp (3), loses its last two fields (5), gains a ninth field
    (7) or an out-of-range property (11)."""
    m = F.col("id") % 20
    s = lambda c: F.col(c).cast("string")
    toks = F.array(s("id"), F.when(m == 3, F.lit("xx")).otherwise(s("timestamp")),
                   F.col("value").cast("decimal(18,2)").cast("string"),
                   F.when(m == 11, F.lit("7")).otherwise(s("property")),
                   s("plug_id"), s("household_id"), s("house_id"))
    return (F.when(m == 5, F.slice(toks, 1, 5))
            .when(m == 7, F.concat(toks, F.array(F.lit("99"))))
            .otherwise(toks))


_TOKENS_SQL = (
    "CASE WHEN id % 20 = 5 THEN list_slice(tk, 1, 5) WHEN id % 20 = 7 THEN list_concat(tk, ['99']) ELSE tk END")
_TK_SQL = ("[CAST(id AS VARCHAR), CASE WHEN id % 20 = 3 THEN 'xx' ELSE CAST(timestamp AS VARCHAR) END, "
           "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), CASE WHEN id % 20 = 11 THEN '7' ELSE CAST(property AS VARCHAR) END, "
           "CAST(plug_id AS VARCHAR), CAST(household_id AS VARCHAR), CAST(house_id AS VARCHAR)]")
_LINES_SQL = O.with_(O.READINGS, f"t0 AS (SELECT id, {_TK_SQL} AS tk FROM readings)",
                     f"t1 AS (SELECT id, {_TOKENS_SQL} AS toks FROM t0)")
_WS_SEP = " \t "


def csv_lines(spark, sf) -> DataFrame:
    r = readings(spark, sf)
    return r.select("id", F.concat_ws(",", fixture_tokens(r)).alias("value"))


def ws_lines(spark, sf) -> DataFrame:
    r = readings(spark, sf)
    lead = F.when(F.col("id") % 4 == 0, F.lit(" ")).otherwise(F.lit(""))
    trail = F.when(F.col("id") % 5 == 0, F.lit("  ")).otherwise(F.lit(""))
    return r.select("id", F.concat(lead, F.concat_ws(_WS_SEP, fixture_tokens(r)), trail).alias("line"))


_WS_LINE_SQL = ("concat(CASE WHEN id % 4 = 0 THEN ' ' ELSE '' END, array_to_string(toks, ' \t '), "
                "CASE WHEN id % 5 = 0 THEN '  ' ELSE '' END)")
_SPLIT_SQL = "string_split_regex(regexp_replace(line, '\\s+$', ''), '\\s+')"


@register("tokenize_ws", _LINES_SQL + (
    f"SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, '|') AS tokens FROM "
    f"(SELECT id, {_SPLIT_SQL} AS tokens FROM (SELECT id, {_WS_LINE_SQL} AS line FROM t1))"))
def _tokenize(spark, sf):
    t = ws_lines(spark, sf).select("id", tokenize_ws(F.col("line")).alias("tokens"))
    return t.select("id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens"))


@register("cleanse", _LINES_SQL + (
    f"SELECT id, array_to_string(tokens, '|') AS tokens FROM "
    f"(SELECT id, {_SPLIT_SQL} AS tokens FROM (SELECT id, {_WS_LINE_SQL} AS line FROM t1)) "
    "WHERE len(tokens) = 7 AND TRY_CAST(tokens[4] AS INTEGER) IN (0, 1)"))
def _cleanse(spark, sf):
    t = ws_lines(spark, sf).select("id", tokenize_ws(F.col("line")).alias("tokens"))
    return cleanse(t).select("id", F.array_join("tokens", "|").alias("tokens"))


_PARSE_SQL = _LINES_SQL + (
    "SELECT * FROM (SELECT TRY_CAST(toks[1] AS BIGINT) AS id, TRY_CAST(toks[2] AS BIGINT) AS timestamp, "
    "TRY_CAST(toks[3] AS DOUBLE) AS value, TRY_CAST(toks[4] AS INTEGER) AS property, "
    "TRY_CAST(toks[5] AS BIGINT) AS plug_id, TRY_CAST(toks[6] AS BIGINT) AS household_id, "
    "TRY_CAST(toks[7] AS BIGINT) AS house_id FROM t1) "
    "WHERE id IS NOT NULL AND timestamp IS NOT NULL AND value IS NOT NULL AND property IS NOT NULL "
    "AND plug_id IS NOT NULL AND household_id IS NOT NULL AND house_id IS NOT NULL")


@register("parse_sensor_csv", _PARSE_SQL)
def _parse_csv(spark, sf):
    return parse_lines(csv_lines(spark, sf))


@register("scan_text", _LINES_SQL + "SELECT array_to_string(toks, ',') AS value FROM t1")
def _scan_text(spark, sf):
    path = scratch_path(spark, "sensor-lines")
    csv_lines(spark, sf).select("value").write.mode("overwrite").text(path)
    return read_text(spark, path)


@register("scan_csv_file", _PARSE_SQL)
def _scan_csv_file(spark, sf):
    path = scratch_path(spark, "sensor-csv")
    csv_lines(spark, sf).select("value").write.mode("overwrite").text(path)
    return load_sensor(spark, "csv", path)


@register("scan_csv_gz", _PARSE_SQL)
def _scan_csv_gz(spark, sf):
    path = scratch_path(spark, "sensor-gz")
    csv_lines(spark, sf).select("value").write.mode("overwrite").option("compression", "gzip").text(path)
    return load_sensor(spark, "csv", path, min_partitions=4)


@register("parse_dropped", f"SELECT (SELECT count(*) FROM readings_all) AS lines, count(*) AS kept, "
          f"(SELECT count(*) FROM readings_all) - count(*) AS dropped FROM ({_PARSE_SQL}), (SELECT 1)"
          .replace("readings_all", f"({ADAPTER_SQL})"))
def _parse_dropped(spark, sf):
    return dropped_lines(csv_lines(spark, sf))


@register("presum_unfit", f"SELECT reason, count(*) AS count FROM (SELECT CASE WHEN isnan(v) THEN 'nan' "
          f"WHEN isinf(v) THEN 'infinite' WHEN abs(v) >= 1e23 THEN 'too_large' END AS reason FROM (SELECT "
          f"CASE id % 50 WHEN 1 THEN CAST('nan' AS DOUBLE) WHEN 2 THEN CAST('inf' AS DOUBLE) WHEN 3 THEN 1e30 ELSE value END AS v "
          f"FROM ({ADAPTER_SQL}))) WHERE reason IS NOT NULL GROUP BY reason")
def _presum_unfit(spark, sf):
    """Readings made unfit by rule are counted; the sums leave them out."""
    m = F.col("id") % 50
    value = F.when(m == 1, float("nan")).when(m == 2, float("inf")).when(m == 3, 1e30).otherwise(F.col("value"))
    return unfit_counts(readings(spark, sf).withColumn("value", value))


# ----------------------------------------------------------------- documents / kafka
_RAW_SQL = O.with_(O.READINGS) + "SELECT CAST(house_id AS VARCHAR) AS key, * FROM readings"


@register("kafka_encode", _RAW_SQL)
def _kafka_encode(spark, sf):
    rec = kafka_records(readings(spark, sf))
    return rec.select("key", F.from_json("value", ", ".join(
        f"{c} {t}" for c, t in zip(SENSOR_COLUMNS, ("bigint", "bigint", "double", "int", "bigint", "bigint", "bigint")))
    ).alias("r")).select("key", "r.*")


@register("kafka_decode", O.with_(O.READINGS) + "SELECT * FROM readings")
def _kafka_decode(spark, sf):
    return decode_kafka(kafka_records(readings(spark, sf)))


@register("raw_json", _presum_sql(["house_id"], _KEPT))
def _raw_json(spark, sf):
    pre = presum(readings(spark, sf), HOUSE, Options()).select(*SENSOR_COLUMNS)
    return parse_raw(pre.select(raw_json().alias("value")))


@register("prediction_json", _docs_sql(HOUSE_KEY, HOUSE_NAME))
def _prediction_json(spark, sf):
    p = predictions(readings(spark, sf), HOUSE, _ALL)
    return parse_prediction(p.select(prediction_json(PREDICTION_NOW_MS).alias("value")))


# ----------------------------------------------------------------- streaming = batch
FLUSH_HOUSE = 99          # far-future readings that close every window; removed from results
FLUSH_AFTER_S = 10 * 86400
STREAM_BATCHES = 3
STREAM_FILES = 4          # files of a micro-batch


def stream_input(spark: SparkSession, sf: str, late: bool = False) -> str:
    """All readings as CSV files under the shared directory, in time order: some
    files per micro-batch, then two files with a flush reading each (the second
    closes the pane of the first). With ``late``, files before the flushes repeat
    every reading of the first half, all of them late by then."""
    from ..functions.text import sensor_line
    r = readings(spark, sf)
    ends = r.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    a, b = ends["a"] or 0, ends["b"] or 0
    edges = [a + (b - a) * i // STREAM_BATCHES for i in range(STREAM_BATCHES)] + [b + 1]
    flush = lambda n: spark.range(1).select(
        F.lit(0).cast("long").alias("id"), F.lit(b + n * FLUSH_AFTER_S).cast("long").alias("timestamp"), F.lit(1.0).alias("value"),
        F.lit(1).alias("property"), F.lit(0).cast("long").alias("plug_id"),
        F.lit(0).cast("long").alias("household_id"), F.lit(FLUSH_HOUSE).cast("long").alias("house_id"))
    parts = [r.where(F.col("timestamp").between(x, y - 1)) for x, y in zip(edges, edges[1:])]
    if late:
        parts.append(r.where(F.col("timestamp") < (a + b) // 2))
    parts += [flush(1), flush(2)]
    path = scratch_path(spark, "stream-in")
    for part in parts:  # the file source takes files in the order of their times
        part.select(*SENSOR_COLUMNS).select(sensor_line().alias("value")).repartition(STREAM_FILES).write.mode("append").text(path)
    return path


def _run_stream(spark: SparkSession, sf: str, entity, options: Options, late: bool = False) -> DataFrame:
    from ..sources.sensor import read_csv_stream
    from ..streaming.jobs import start_averaging_job
    src = stream_input(spark, sf, late)
    root = scratch_path(spark, "stream-out")
    queries = start_averaging_job(spark, read_csv_stream(spark, src, max_files=STREAM_FILES), entity, f"{root}/store",
                                  f"{root}/docs", f"{root}/checkpoint", options, _ALL,
                                  now_ms=PREDICTION_NOW_MS,
                                  state_partitions=spark.sparkContext.defaultParallelism)
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    docs = parse_prediction(spark.read.json(f"{root}/docs"))
    return docs.where(F.col("house_id") != FLUSH_HOUSE)


@register("stream_predict_house", _docs_sql(HOUSE_KEY, HOUSE_NAME))
def _stream_predict_house(spark, sf):
    """The streaming house job (panes, store, all levels, medians, documents) run
    to completion over all readings in several micro-batches."""
    return _run_stream(spark, sf, HOUSE, Options())


@register("stream_predict_house_rolling", _docs_sql(HOUSE_KEY, HOUSE_NAME, mode="rolling"))
def _stream_predict_house_rolling(spark, sf):
    """As-executed rolling pre-sum on the stream (stateful processor)."""
    from ..session import conf_override
    from ..streaming.rolling import ROCKSDB
    with conf_override(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        return _run_stream(spark, sf, HOUSE, Options(presum="rolling"))


@register("stream_predict_plug", _docs_sql(PLUG_KEY, PLUG_NAME))
def _stream_predict_plug(spark, sf):
    """The streaming plug job (full key) run to completion over all readings."""
    return _run_stream(spark, sf, PLUG, Options())


@register("stream_late_dropped", _docs_sql(HOUSE_KEY, HOUSE_NAME))
def _stream_late(spark, sf):
    """Readings that come again long after their panes closed change nothing."""
    return _run_stream(spark, sf, HOUSE, Options(), late=True)
