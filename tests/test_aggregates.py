"""Freshness and throughput report on hand-computable inputs."""

import datetime as dt

from movelake.operators.aggregates import freshness, throughput_report

T0 = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)


def _t(spark, secs):
    rows = [(T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(seconds=s, milliseconds=5)) for s in secs]
    return spark.createDataFrame(rows, "timestamp timestamp, ingested_at timestamp")


def test_freshness_stale_flag(spark):
    as_of = T0 + dt.timedelta(minutes=20)
    t = {"a": _t(spark, [0, 540]), "b": _t(spark, [1140])}   # newest 12:09 and 12:19
    got = {r.table: (r.age_seconds, r.stale) for r in freshness(t, as_of=as_of).collect()}
    assert got == {"a": (660.0, True), "b": (60.0, False)}


def test_throughput_report_peaks(spark):
    secs = [0, 10, 20, 30, 70, 3600 + 5, 3600 + 6]   # minute 0: 4 rows; hour 0: 5 rows
    r = throughput_report({"t": _t(spark, secs)}).first()
    assert (r.rows, r.peak_hour_rows, r.peak_minute_rows) == (7, 5, 4)
    assert r.span_seconds == 3606.0 and abs(r.avg_rows_per_s - 7 / 3606.0) < 1e-6
