"""Rollups of streams: late rows, replays and compaction; drop counts of jobs."""

import datetime as dt

from pyspark.sql import functions as F

from movelake import jobs
from movelake.operators import ledger
from movelake.session import scratch_path
from movelake.sources import landed
from movelake.streaming import rollups

T0 = dt.datetime(2026, 4, 19, 23, 58, tzinfo=dt.timezone.utc)


def rows(spark, seconds, table="a"):
    return spark.createDataFrame([(table, T0 + dt.timedelta(seconds=s)) for s in seconds], "table string, ts timestamp")


def run(spark, land, out, ck, window="1 second"):
    src = spark.readStream.schema("table string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
    rollups.stream_rollup(src, out, ck, ["table"], window, "ts", "availableNow").awaitTermination()


def found(spark, out):
    return {(r.table, r.gap_seconds) for r in rollups.gaps(rollups.read_rollup(spark, out, "table string")).collect()}


def test_a_late_insert_closes_a_gap(spark):
    land, out, ck = (scratch_path(spark, n) for n in ("r_land", "r_out", "r_ck"))
    rows(spark, [0, 10, 400, 900]).coalesce(1).write.parquet(f"{land}/1")  # 900 is on the next day
    rows(spark, [0, 5], "b").coalesce(1).write.parquet(f"{land}/2")
    run(spark, land, out, ck)
    assert found(spark, out) == {("a", 390), ("a", 500)}
    rows(spark, [120, 10, 230, 340]).coalesce(1).write.parquet(f"{land}/3")  # hours late, as far as the stream knows
    run(spark, land, out, ck)
    assert found(spark, out) == {("a", 500)}
    counts = {(r.table, r.window_start): r.rows for r in rollups.read_rollup(spark, out, "table string").collect()}
    assert sum(counts.values()) == 10 and max(counts.values()) == 2
    assert len(rollups.compact_rollup(spark, out, "table string")) == 2 and rollups.compact_rollup(spark, out, "table string") == []
    assert {(r.table, r.window_start): r.rows for r in rollups.read_rollup(spark, out, "table string").collect()} == counts
    rows(spark, [1300], "b").coalesce(1).write.parquet(f"{land}/4")
    run(spark, land, out, ck)  # goes on after the compaction
    assert found(spark, out) == {("a", 500), ("b", 1295)}
    assert len(ledger.entries(spark, out).collect()) == 4


def test_collapsed_windows_and_latency_buckets(spark):
    r = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), n) for m, n in ((0, 2), (1, 1), (9, 5))], "window_start timestamp, rows long")
    got = {int((x.window_start.replace(tzinfo=dt.timezone.utc) - T0).total_seconds() // 60): x.rows for x in
           rollups.collapsed(r, min_rows=4).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert got == {-4: 2, -3: 3, -2: 3, -1: 3, 0: 3, 1: 1}
    us = [0, 1, 2, 999, 1000, 123_456, 1_990_000, 2_010_000, 7_777_777_777, -5_000]
    d = spark.createDataFrame([(T0 + dt.timedelta(microseconds=u), T0, u / 1000) for u in us], "ingested_at timestamp, timestamp timestamp, ms double")
    one = d.select("ms", rollups.latency_bucket().alias("bucket"), F.lit(1).cast("long").alias("rows"), F.monotonically_increasing_id().alias("window_start"))
    for x in rollups.latency_percentile(one).join(one.select("window_start", "ms"), "window_start").collect():
        assert abs(x.p_ms - x.ms) <= abs(x.ms) * 0.00196 + 1e-12 and x.alarm == (x.ms > 2000)


def test_a_job_counts_what_it_leaves_out(spark):
    sf = "/root/testdata/sf0.001"
    docs = landed.land_adsb(spark, sf, "adsb_types")
    dead = scratch_path(spark, "dead")
    got = jobs.ingest(spark, "adsb_types", docs, scratch_path(spark, "t"), dead_letter_path=dead, run="2024-01-31T00")
    counts = {(r.level, r.reason): r.rows for r in jobs.left_out("adsb_types", docs).collect()}
    assert got["dropped"] == {k: n for (level, k), n in counts.items() if level == "record"} and set(got["dropped"]) == {"no_position", "no_id"}
    assert got["rejected"] == sum(n for (level, _), n in counts.items() if level == "document") == spark.read.json(dead).count()
