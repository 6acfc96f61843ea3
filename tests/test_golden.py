"""Hand-computed golden rows (FIXTURES.md §4)."""

import pytest

from conftest import T0
from loadcast.config import HOUSE, Options
from loadcast.operators.presum import presum
from loadcast.plans.pipeline import level_averages, level_frames, predictions


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_presum_final(golden):
    out = presum(golden, HOUSE, Options())
    assert rows(out, "timestamp", "value") == [(T0, 30.0), (T0 + 10, 30.0), (T0 + 35, 40.0)]


def test_presum_rolling(golden):
    out = presum(golden, HOUSE, Options(presum="rolling"))
    assert rows(out, "timestamp", "value") == [(T0, 10.0), (T0, 30.0), (T0 + 10, 30.0), (T0 + 35, 40.0)]


@pytest.mark.parametrize("mode,expected", [
    ("final", [(-30, 60.0, 2, 10), (0, 100.0, 3, 35), (30, 40.0, 1, 35)]),
    ("rolling", [(-30, 70.0, 3, 10), (0, 110.0, 4, 35), (30, 40.0, 1, 35)]),
])
def test_one_minute(golden, mode, expected):
    out = level_averages(golden, HOUSE, 1, Options(presum=mode))
    got = [(r.window_start - T0, r.sum, r["count"], r.event_timestamp - T0) for r in
           out.orderBy("window_start").collect()]
    assert got == expected
    for r in out.collect():
        assert r.window_end - r.window_start == 60
        assert r.avg == pytest.approx(r.sum / r["count"])


def test_five_minute_cascade_rolling(golden):
    out = level_averages(golden, HOUSE, 5, Options(presum="rolling"))
    got = [(r.window_start - T0, r.sum, r["count"], r.event_timestamp - T0)
           for r in out.orderBy("window_start").collect()]
    expected = [(-270, 70.0, 3, 10), (-240, 180.0, 7, 35)]
    expected += [(s, 220.0, 8, 35) for s in range(-210, 1, 30)]
    expected += [(30, 150.0, 5, 35), (60, 40.0, 1, 35)]
    assert got == expected


def test_median_history_and_predictions(golden):
    df = level_frames(golden, HOUSE, (1,), Options(), medians=True)[1].orderBy("window_start")
    assert [r.median_load for r in df.collect()] == pytest.approx([0.0, 30.0, 31.666666666666667])
    p = predictions(golden, HOUSE, (1,)).orderBy("window_start").collect()
    assert [r.predicted_value for r in p] == pytest.approx([15.0, 31.6666667, 35.8333333])
    assert {r.entity for r in p} == {"House"} and {r.sliding_window_ms for r in p} == {60000}
    z = predictions(golden, HOUSE, (1,), Options(median_mode="zero")).orderBy("window_start").collect()
    assert [r.predicted_value for r in z] == pytest.approx([15.0, 16.6666667, 20.0])


def test_median_options_differ(golden):
    base = [r.median_load for r in level_frames(golden, HOUSE, (1,), Options(), medians=True)[1]
            .orderBy("window_start").collect()]
    cur = [r.median_load for r in level_frames(golden, HOUSE, (1,), Options(include_current=True),
                                               medians=True)[1].orderBy("window_start").collect()]
    scaled = [r.median_load for r in level_frames(golden, HOUSE, (1,), Options(median_scale=1000.0),
                                                  medians=True)[1].orderBy("window_start").collect()]
    allh = [r.median_load for r in level_frames(golden, HOUSE, (1,), Options(retention=False),
                                                medians=True)[1].orderBy("window_start").collect()]
    assert cur == pytest.approx([30.0, 31.666666666666667, 33.333333333333336])
    assert scaled == pytest.approx([b / 1000 for b in base])
    assert allh == pytest.approx(base)   # history shorter than the retention here


def test_approximate_median(golden):
    """median_exact=False (percentile_approx, for histories without retention)
    picks an element of the history instead of interpolating; a bounded history
    is always taken exactly."""
    bounded = level_frames(golden, HOUSE, (1,), Options(median_exact=False), medians=True)[1]
    exact = level_frames(golden, HOUSE, (1,), Options(), medians=True)[1]
    assert sorted(map(tuple, bounded.collect())) == sorted(map(tuple, exact.collect()))
    df = level_frames(golden, HOUSE, (1,), Options(median_exact=False, retention=False), medians=True)[1]
    assert [r.median_load for r in df.orderBy("window_start").collect()] == pytest.approx([0.0, 30.0, 30.0])
    allh = level_frames(golden, HOUSE, (1,), Options(median_exact=False, retention=False), medians=True)[1]
    assert [r.median_load for r in allh.orderBy("window_start").collect()] == pytest.approx([0.0, 30.0, 30.0])
