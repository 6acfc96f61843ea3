"""Line tokenising and cleansing (the text path of the feed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sensor import SENSOR_COLUMNS


def tokenize_ws(line: Column) -> Column:
    """Split on runs of whitespace. Trailing empty tokens are dropped and a
    leading one is kept (the JVM ``String.split`` contract), hence the
    right-trim before splitting."""
    return F.split(F.regexp_replace(line, r"\s+$", ""), r"\s+")


def cleanse(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """Keep token lists of exactly seven fields whose property field is 0 or 1.
    (``try_*``: filters are not evaluated in order, so a short list must not
    raise on the index.)"""
    prop = F.try_element_at(F.col(col), F.lit(4)).try_cast("int")
    return tokens.where((F.size(col) == len(SENSOR_COLUMNS)) & prop.isin(0, 1))


def sensor_line(sep: str = ",") -> Column:
    """A reading as a CSV line in column order."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in SENSOR_COLUMNS])
