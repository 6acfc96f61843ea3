"""Independent DuckDB SQL for the batch queries (the correctness oracle).

Deliberately written the naive way: every sliding window is materialised by
a cross join with ``range(0, n)`` and a GROUP BY on the window end, level by
level -- nothing of the pane/prefix-sum plan is shared with the Spark side.
Values are summed unrounded: as DECIMALs read from the shortest text of each
double, and totals go back to the nearest double by way of their text.
"""

from __future__ import annotations

from ..config import LEVEL_MINUTES, SLIDE_SECONDS, VALUE_SCALE, retention_seconds
from ..sources.sensor import ADAPTER_SQL

U = f"CAST(CAST(value AS VARCHAR) AS DECIMAL(38, {VALUE_SCALE}))"
READINGS = f"readings AS ({ADAPTER_SQL})"


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def keys_sql(keys) -> str:
    return ", ".join(keys)


def presum_cte(keys, mode="final", prop=None, as_written=False) -> str:
    where = f" WHERE property = {prop}" if prop is not None else ""
    k = keys_sql(keys)
    if mode == "final" and as_written:
        return (f"presum AS (SELECT house_id, arg_min(household_id, id) AS household_id, plug_id, "
                f"timestamp, sum({U}) AS u FROM readings{where} GROUP BY house_id, plug_id, timestamp)")
    if mode == "final":
        return f"presum AS (SELECT {k}, timestamp, sum({U}) AS u FROM readings{where} GROUP BY {k}, timestamp)"
    if mode == "rolling":
        return (f"presum AS (SELECT {k}, timestamp, sum({U}) OVER (PARTITION BY {k}, timestamp ORDER BY id "
                f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u FROM readings{where})")
    return f"presum AS (SELECT {k}, timestamp, {U} AS u FROM readings{where})"


def level_ctes(keys, chain_minutes) -> list[str]:
    k = keys_sql(keys)
    ctes = [f"l0 AS (SELECT {k}, timestamp // {SLIDE_SECONDS} AS pos, sum(u) AS s, count(*) AS c, "
            f"max(timestamp) AS t FROM presum GROUP BY ALL)"]
    for i, m in enumerate(chain_minutes, 1):
        n = m * 60 // SLIDE_SECONDS
        ctes.append(f"l{i} AS (SELECT {k}, pos + r.i AS pos, sum(s) AS s, sum(c) AS c, max(t) AS t "
                    f"FROM l{i - 1} CROSS JOIN range(0, {n}) AS r(i) GROUP BY ALL)")
    return ctes


def avg_cols(keys, n, ts=True) -> str:
    k = keys_sql(keys)
    return (f"{k}, pos, (pos - {n - 1}) * {SLIDE_SECONDS} AS window_start, (pos + 1) * {SLIDE_SECONDS} AS window_end, "
            f"{dbl('s')} AS \"sum\", CAST(c AS BIGINT) AS \"count\", "
            + ("t AS event_timestamp, " if ts else "")
            + f"{dbl('s')} / CAST(c AS DOUBLE) AS avg")


def median_expr(keys, minutes, include_current=False, retention=True, scale=1.0) -> str:
    hi = "CURRENT ROW" if include_current else "1 PRECEDING"
    lo = f"{retention_seconds(minutes) // SLIDE_SECONDS} PRECEDING" if retention else "UNBOUNDED PRECEDING"
    e = (f"coalesce(median(avg) OVER (PARTITION BY {keys_sql(keys)} ORDER BY pos "
         f"RANGE BETWEEN {lo} AND {hi}), 0.0)")
    return e if scale == 1.0 else f"({e} / {float(scale)})"


def chain_to(minutes: int) -> list[int]:
    return list(LEVEL_MINUTES[:LEVEL_MINUTES.index(minutes) + 1])


def with_(*ctes) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def level_sql(keys, minutes, mode="final", prop=None, as_written=False, ts=True,
              median=None, chain=None) -> str:
    """Averages of one level (optionally with ``median_load``)."""
    chain = chain or chain_to(minutes)
    n = minutes * 60 // SLIDE_SECONDS
    ctes = [READINGS, presum_cte(keys, mode, prop, as_written), *level_ctes(keys, chain),
            f"a AS (SELECT {avg_cols(keys, n, ts)} FROM l{len(chain)})"]
    cols = f"{keys_sql(keys)}, window_start, window_end, \"sum\", \"count\", " + \
        ("event_timestamp, " if ts else "") + "avg"
    if median is not None:
        cols += f", {median_expr(keys, minutes, **median)} AS median_load"
    return with_(*ctes) + f"SELECT {cols} FROM a"


FULL = ("house_id", "household_id", "plug_id")


def multi_level_sql(keys, levels, entity_name, mode="final", as_written=False,
                    median=None, predict=False, store_cols=False) -> str:
    """Union of several levels of one entity with ``window_minutes``."""
    chain = chain_to(max(levels, key=LEVEL_MINUTES.index))
    ctes = [READINGS, presum_cte(keys, mode, None, as_written), *level_ctes(keys, chain)]
    selects = []
    for m in levels:
        i = chain.index(m) + 1
        n = m * 60 // SLIDE_SECONDS
        ctes.append(f"a{i} AS (SELECT {avg_cols(keys, n)} FROM l{i})")
        full = ", ".join(c if c in keys else f"CAST(NULL AS BIGINT) AS {c}" for c in FULL)
        cols = (f"'{entity_name}' AS entity, {m} AS window_minutes, {full}, window_start, window_end, "
                f"\"sum\", \"count\", event_timestamp, avg")
        if median is not None:
            med = median_expr(keys, m, **median)
            cols += f", {med} AS median_load"
            if predict:
                cols += (f", CAST({m * 60000} AS BIGINT) AS sliding_window_ms, "
                         f"(avg + {med}) / 2.0 AS predicted_value")
        selects.append(f"SELECT {cols} FROM a{i}")
    return with_(*ctes) + "\nUNION ALL\n".join(selects)


def direct_sql(keys, minutes) -> str:
    """True N-minute sliding averages from the readings."""
    n = minutes * 60 // SLIDE_SECONDS
    k = keys_sql(keys)
    return with_(READINGS) + (
        f"SELECT {k}, ws AS window_start, ws + {minutes * 60} AS window_end, {dbl('sum(u)')} AS \"sum\", "
        f"count(*) AS \"count\", {dbl('sum(u)')} / CAST(count(*) AS DOUBLE) AS avg FROM ("
        f"SELECT {k}, {U} AS u, (timestamp // {SLIDE_SECONDS} - r.i) * {SLIDE_SECONDS} AS ws "
        f"FROM readings CROSS JOIN range(0, {n}) AS r(i)) GROUP BY ALL")
