"""Day-partitioned ordered windows must see across midnight."""

import datetime as dt

from movelake.operators.windows import stall_gaps, throughput_collapse


def _ins(spark, times):
    return spark.createDataFrame([(t,) for t in times], "ingested_at timestamp")


def test_gap_across_midnight(spark):
    d = dt.datetime(2026, 4, 19, 23, 58, tzinfo=dt.timezone.utc)
    df = _ins(spark, [d - dt.timedelta(minutes=10), d, d + dt.timedelta(minutes=7)])
    got = sorted(r.gap_seconds for r in stall_gaps({"t": df}, min_gap_s=120).collect())
    assert got == [420, 600]


def test_trailing_window_halo_across_midnight(spark):
    d0 = dt.datetime(2026, 4, 19, 23, 50, tzinfo=dt.timezone.utc)
    times = [d0, d0 + dt.timedelta(minutes=8), d0 + dt.timedelta(minutes=12),   # 23:50, 23:58, 00:02
             d0 + dt.timedelta(minutes=12, seconds=240)]                        # 00:06 (23:58 + 480 s)
    rows = {r.second.replace(tzinfo=None): r.rows_in_window
            for r in throughput_collapse({"t": _ins(spark, times)}, window_s=300, min_rows=1000).collect()}
    # 00:02 sees 23:58 (240 s back) through the previous day's halo, and itself
    assert rows[dt.datetime(2026, 4, 20, 0, 2)] == 2
    # 00:06 sees 00:02 (240 s back) but not 23:58 (480 s back)
    assert rows[dt.datetime(2026, 4, 20, 0, 6)] == 2
    # 23:58 is 480 s after the table started, so it is reported; 23:50 is outside its window
    assert rows[dt.datetime(2026, 4, 19, 23, 58)] == 1


def test_trailing_window_boundary_is_inclusive(spark):
    d0 = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)
    times = [d0, d0 + dt.timedelta(seconds=400), d0 + dt.timedelta(seconds=700)]
    rows = {r.second.replace(tzinfo=None): r.rows_in_window
            for r in throughput_collapse({"t": _ins(spark, times)}, window_s=300, min_rows=1000).collect()}
    # exactly 300 s back is still inside the window
    assert rows[dt.datetime(2026, 4, 19, 12, 11, 40)] == 2
    # the first second is within 300 s of the start, so not reported
    assert dt.datetime(2026, 4, 19, 12, 0) not in rows
