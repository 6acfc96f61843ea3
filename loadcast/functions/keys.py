"""Key string, value parsing and integer scaling (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import KEY_DELIMITER


def key_string(house: str = "house_id", household: str = "household_id",
               plug: str = "plug_id", mode: str = "intent") -> Column:
    """Column name of an entity in the store: present key parts joined by
    ``|`` (absent = NULL parts are skipped).

    ``mode="as_written"`` reproduces the original builder, whose delimiter
    is conditional but whose value is not, and which writes the household
    where the plug belongs: a house key gives ``"5-1-1"``, a plug key
    ``"h|hh|hh"``."""
    if mode == "intent":
        return F.concat_ws(KEY_DELIMITER, F.col(house), F.col(household), F.col(plug))
    if mode != "as_written":
        raise ValueError(f"unknown key mode {mode!r}")
    hh = F.coalesce(F.col(household), F.lit(-1)).cast("string")
    sep_if = lambda c: F.when(F.col(c).isNotNull(), F.lit(KEY_DELIMITER)).otherwise(F.lit(""))
    return F.concat(F.coalesce(F.col(house).cast("string"), F.lit("")),
                    sep_if(household), hh, sep_if(plug), hh)


def key_parse(s: Column) -> Column:
    """Inverse of :func:`key_string`: a struct of three nullable longs
    (1, 2 or 3 parts; a part that is not a number gives NULL)."""
    parts = F.split(s, r"\|")
    return F.struct(*[F.try_element_at(parts, F.lit(i)).try_cast("bigint").alias(n)
                      for i, n in ((1, "house_id"), (2, "household_id"), (3, "plug_id"))])


def value_parse(v: Column) -> Column:
    """Stored cell -> (sum, count, event_timestamp): an unparsable value is
    sum 0.0, count is always 1, the event timestamp is absent."""
    return F.struct(F.coalesce(v.try_cast("double"), F.lit(0.0)).alias("sum"),
                    F.lit(1).cast("long").alias("count"),
                    F.lit(None).cast("long").alias("event_timestamp"))


def scaled_avg(avg: Column) -> Column:
    """Average as a long of thousandths, truncated toward zero."""
    return (avg * F.lit(1000.0)).cast("long")
