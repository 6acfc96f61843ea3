"""Constants, entity definitions and pipeline options.

Every transformation in the package is a ``DataFrame -> DataFrame`` function
parameterised by an :class:`Entity` (which columns form the key) and a
:class:`Options` record (which variant of each operator to run).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the original job's for identical results.
# Sliding interval of every window, in seconds: 30
# Window lengths of the five cascade levels, in minutes: 1, 5, 15, 60, 120
# Retention of a stored average: window length + 5 seconds
#   (65, 305, 905, 3605, 7205 seconds)
# Allowed out-of-orderness of the event-time watermark: 10 seconds
# Entity names used in predictions: "House", "Plug"
# Key-string delimiter: "|"
# Document types: "prediction_<N>min" (sinks.store) and "raw"
# Feed defaults: topic "sensor_raw", brokers "localhost:9092"
# ---------------------------------------------------------------------------
SLIDE_SECONDS = 30
LEVEL_MINUTES = (1, 5, 15, 60, 120)
RETENTION_EXTRA_SECONDS = 5
WATERMARK_DELAY = "10 seconds"
HOUSE_NAME = "House"
PLUG_NAME = "Plug"
KEY_DELIMITER = "|"
RAW_DOC_TYPE = "raw"
DEFAULT_TOPIC = "sensor_raw"
DEFAULT_BROKERS = "localhost:9092"

# Values are summed as DECIMAL(38, VALUE_SCALE): exact for every reading of up to
# 15 fractional digits, and independent of partitioning and summation order, so
# retries and different cluster sizes give bit-identical averages. 23 digits are
# left before the point; the largest running sum (a week of one key, counted
# 2*10*30*120*240 times on the way up the cascade, at 3e10 in 30 seconds) takes
# 1.1e22.
VALUE_SCALE = 15


def retention_seconds(minutes: int) -> int:
    return minutes * 60 + RETENTION_EXTRA_SECONDS


@dataclass(frozen=True)
class Entity:
    """What one average is keyed by.

    ``key_cols`` are the grouping columns of the windows; ``presum_cols`` the
    grouping columns of the per-second pre-sum (without the time column).
    Columns of the full (house, household, plug) key that are not part of
    ``key_cols`` are emitted as NULL ("absent") in the averages table.
    """

    name: str
    key_cols: tuple[str, ...]
    presum_cols: tuple[str, ...]

    @property
    def slug(self) -> str:
        return self.name.lower()


HOUSE = Entity(HOUSE_NAME, ("house_id",), ("house_id",))
PLUG = Entity(PLUG_NAME, ("house_id", "household_id", "plug_id"),
              ("house_id", "household_id", "plug_id"))
# Pre-sum key as the plug job wrote it: household is left out of the pre-sum key
# and inherited from the first reading of each group.
PLUG_AS_WRITTEN = Entity(PLUG_NAME, ("house_id", "household_id", "plug_id"),
                         ("house_id", "plug_id"))
# Keyed by plug number only (the superseded plug job).
PLUG_ONLY = Entity("PlugOnly", ("plug_id",), ("plug_id",))

FULL_KEY = ("house_id", "household_id", "plug_id")


@dataclass(frozen=True)
class Options:
    """Variants of the pipeline. Defaults follow the stated intent of the
    original job; each option reproduces one as-executed behaviour."""

    presum: str = "final"            # "final" | "rolling" | "none"
    property: int | None = None      # keep only readings with this property
    median_mode: str = "history"     # "history" | "zero"
    median_scale: float = 1.0        # divide the median by this (1000 = as executed)
    include_current: bool = False    # current average inside its own median
    retention: bool = True           # False = keep all history (no TTL)
    median_exact: bool = True        # False = percentile_approx, only without retention
    value_scale: int = VALUE_SCALE
    chunk_panes: int = 2880 * 7      # time chunk of the (key, chunk) partitioning
    cascade_partitions: int | None = None   # (key, chunk) partitions; None = shuffle setting

    def with_(self, **kw) -> "Options":
        return replace(self, **kw)


DEFAULT_OPTIONS = Options()
