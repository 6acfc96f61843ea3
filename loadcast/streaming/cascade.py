"""The cascade and its medians as keyed state of a stream.

Closed panes of a key arrive in order (see :mod:`.jobs`). For each 30-second end,
every level adds its newest input and takes its oldest one out of a ring, so a new
pane costs one step per level, whatever the look-back; the averages that a median
looks back over are kept in the order of their ends and sorted, and leave by event
time. Sums are integers (a value's units of 10^-``VALUE_SCALE``), so they are those
of the batch plan to the last bit. An end without a pane has windows too: a timer
per key follows the watermark until the last pane has left the deepest level, and
then once more to drop the state. Nothing is read from the store.
"""

from __future__ import annotations

import pickle
import sys
from bisect import bisect_left, insort
from collections import deque

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import LEVEL_MINUTES, SLIDE_SECONDS, VALUE_SCALE, Entity, Options
from ..operators.median import history_frame
from ..operators.windows import lookback, panes_per_window

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNITS = 10**VALUE_SCALE
PANE_MS = SLIDE_SECONDS * 1000
RESULT = [("window_minutes", T.IntegerType()), ("window_start", T.LongType()), ("window_end", T.LongType()), ("sum", T.DoubleType()),
          ("count", T.LongType()), ("event_timestamp", T.LongType()), ("avg", T.DoubleType()), ("median_load", T.DoubleType())]
STATE = T.StructType([T.StructField("blob", T.BinaryType())])


class Level:
    """A sliding window of ``n`` ends over the level below, and the averages that
    its medians look back over."""

    def __init__(self, n: int, ring=None, ends=()):
        self.ring = deque(ring or [None] * n, maxlen=n)
        inside = [x for x in self.ring if x is not None]
        self.sum, self.count, self.held = sum(x[0] for x in inside), sum(x[1] for x in inside), len(inside)
        self.latest = inside[-1][2] if inside else 0
        self.ends = deque(ends)                          # (end, average), oldest first
        self.ordered = sorted(a for _, a in self.ends)

    def push(self, x):
        """Slide by one end; the window's (sum, count, latest second), or None."""
        old = self.ring[0]
        self.ring.append(x)
        if old is not None:
            self.sum, self.count, self.held = self.sum - old[0], self.count - old[1], self.held - 1
        if x is not None:
            self.sum, self.count, self.held, self.latest = self.sum + x[0], self.count + x[1], self.held + 1, x[2]
        return (self.sum, self.count, self.latest) if self.held else None

    def median(self, end: int, average: float, reach: int, include_current: bool) -> float:
        while self.ends and self.ends[0][0] < end - reach:
            del self.ordered[bisect_left(self.ordered, self.ends.popleft()[1])]
        if include_current:
            self.remember(end, average)
        v, n = self.ordered, len(self.ordered)
        m = 0.0 if n == 0 else v[n // 2] if n % 2 else 0.5 * v[n // 2 - 1] + 0.5 * v[n // 2]
        if not include_current:
            self.remember(end, average)
        return m

    def remember(self, end: int, average: float) -> None:
        self.ends.append((end, average))
        insort(self.ordered, average)


class KeyState:
    """All levels of a key, the last end that was computed and the last pane."""

    def __init__(self, sizes: list[int], blob: bytes | None = None):
        self.end = self.pane = self.timer = None
        parts = [()] * len(sizes)
        if blob is not None:
            self.end, self.pane, self.timer, parts = pickle.loads(blob)
        self.levels = [Level(n, *p) for n, p in zip(sizes, parts)]

    def blob(self) -> bytes:
        return pickle.dumps((self.end, self.pane, self.timer, [(list(x.ring), list(x.ends)) for x in self.levels]), protocol=5)


class Cascade(StatefulProcessor):
    def __init__(self, entity: Entity, levels: tuple[int, ...], options: Options):
        self.keys = entity.key_cols
        self.chain = list(LEVEL_MINUTES[:max(LEVEL_MINUTES.index(m) for m in levels) + 1])
        self.sizes = [panes_per_window(m) for m in self.chain]
        self.wanted = [m in levels for m in self.chain]
        self.reach = [history_frame(m, options.include_current)[0] for m in self.chain]
        self.look = lookback(self.sizes)[-1]
        self.keep = self.look + max(self.reach) + 1
        self.zero, self.include, self.scale = options.median_mode == "zero", options.include_current, float(options.median_scale)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cascade", STATE)

    # ------------------------------------------------------------------ windows
    def step(self, s: KeyState, end: int, pane, out: list) -> None:
        x = pane
        for level, minutes, n, wanted, reach in zip(s.levels, self.chain, self.sizes, self.wanted, self.reach):
            x = level.push(x)
            if x is None or not wanted:
                continue
            total = x[0] / UNITS  # the nearest double
            average = total / x[1]
            m = 0.0 if self.zero else level.median(end, average, reach, self.include) / self.scale
            out.append((minutes, (end - n + 1) * SLIDE_SECONDS, (end + 1) * SLIDE_SECONDS, total, x[1], x[2], average, m))
        s.end = end

    def advance(self, s: KeyState, upto: int, out: list) -> None:
        """Ends without a pane, as long as the last pane is within the deepest level."""
        if s.pane is not None:
            for end in range(s.end + 1, min(upto, s.pane + self.look) + 1):
                self.step(s, end, None, out)

    # ------------------------------------------------------------------- stream
    def load(self) -> KeyState:
        return KeyState(self.sizes, self.state.get()[0] if self.state.exists() else None)

    def result(self, key, out: list) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=[n for n, _ in RESULT])
        for name, value in zip(self.keys, key):
            frame[name] = value
        return frame[[*self.keys, *[n for n, _ in RESULT]]]

    def finish(self, s: KeyState, watermark_ms: int) -> None:
        """Keep the state and set the key's one timer, or drop both."""
        if s.timer is not None:
            self.handle.deleteTimer(s.timer)
        if watermark_ms // PANE_MS > s.pane + self.keep:
            self.state.clear()
            return
        follows = s.end + 2 if s.end < s.pane + self.look else s.pane + self.keep + 1
        s.timer = max(follows * PANE_MS, watermark_ms + 1)
        self.handle.registerTimer(s.timer)
        self.state.update((s.blob(),))

    def handleInputRows(self, key, rows, timerValues):
        s, out, closed = self.load(), [], pd.concat(list(rows))
        for pos, units, count, latest in sorted(zip(*(closed[c].tolist() for c in ("pos", "units", "c", "t")))):
            if s.pane is not None:
                self.advance(s, pos - 1, out)
                if s.end < pos - 1:  # silence: the rings have run empty
                    s.end = pos - 1
            self.step(s, pos, (int(units), count, latest), out)
            s.pane = pos
        watermark = timerValues.getCurrentWatermarkInMs()
        self.advance(s, watermark // PANE_MS - 1, out)
        self.finish(s, watermark)
        yield self.result(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        s, out = self.load(), []
        if s.pane is not None:
            s.timer = None
            watermark = timerValues.getCurrentWatermarkInMs()
            self.advance(s, watermark // PANE_MS - 1, out)
            self.finish(s, watermark)
        yield self.result(key, out)

    def close(self) -> None:
        pass


def stream_windows(panes: DataFrame, entity: Entity, levels: tuple[int, ...], options: Options) -> DataFrame:
    """Averages with medians of all levels, from a stream of closed panes with the
    watermarked column ``event_time``. Needs the RocksDB state store."""
    schema = T.StructType([panes.schema[c] for c in entity.key_cols] + [T.StructField(n, t) for n, t in RESULT])
    units = F.regexp_replace(F.col("s").cast("string"), "[.]", "")  # all places are written
    rows = panes.select(*entity.key_cols, "pos", units.alias("units"), "c", "t", "event_time")
    return (rows.groupBy(*entity.key_cols)
            .transformWithStateInPandas(Cascade(entity, levels, options), schema, "append", "EventTime"))
