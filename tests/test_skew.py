"""A group holding most rows must be split across tasks, not land in one."""

import datetime as dt

from pyspark.sql import functions as F

from movelake.operators.layout import compact
from movelake.operators.quantiles import exact_percentiles, interval
from movelake.operators.windows import mover_track


def _skewed(spark, n=20000):
    # 90% of rows in group "hot", with many distinct values
    return spark.range(n).select(
        F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
         .alias("g"),
        (F.col("id") * 7919 % 100003).cast("double").alias("x"))


def test_percentile_splits_hot_group(spark):
    # no interval, so no task, holds more than a small share of the hot group
    hot = _skewed(spark).where(F.col("g") == "hot")
    most = hot.groupBy(interval(F.col("x")).alias("i")).count().agg(F.max("count")).first()[0]
    assert most < 0.02 * hot.count()
    got = exact_percentiles(_skewed(spark), ["g"], "x", [0.5])
    ref = _skewed(spark).groupBy("g").agg(F.percentile("x", 0.5).alias("r"))
    assert {(r.g, r.p0) for r in got.collect()} == {(r.g, r.r) for r in ref.collect()}


def test_compaction_splits_hot_segment(spark):
    t0 = dt.datetime(2026, 4, 19, tzinfo=dt.timezone.utc)
    rows = [(t0 + dt.timedelta(seconds=i), "hot" if i % 10 else "cold") for i in range(4000)]
    df = spark.createDataFrame(rows, "timestamp timestamp, source string")
    c = compact(df, "flights", partitions=4).withColumn("pid", F.spark_partition_id())
    assert c.where(F.col("source") == "hot").select("pid").distinct().count() >= 3


def test_track_splits_hot_mover(spark):
    t0 = dt.datetime(2026, 4, 19, tzinfo=dt.timezone.utc)
    rows = [("hot" if i % 10 else f"m{i}", t0 + dt.timedelta(seconds=i), 1.0, 2.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "icao24 string, timestamp timestamp, latitude double, longitude double")
    t = mover_track(df, "icao24", partitions=4).withColumn("pid", F.spark_partition_id())
    assert t.where(F.col("icao24") == "hot").select("pid").distinct().count() >= 3
