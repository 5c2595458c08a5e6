"""Table writers and latency on generated rows: what is stored is what was given."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from movelake.operators import aggregates as agg
from movelake.operators import sinks
from movelake.session import scratch_path

SOURCES = ["north", "south", "west"]


def planes(spark, n: int, days: int = 4):
    """n rows over ``days`` UTC days; every 5th lacks a longitude, every 7th a latitude."""
    i = F.col("id")
    return spark.range(n).select(
        (F.timestamp_seconds(F.lit(1_930_003_200) + i * (86_400 * days // n))).alias("timestamp"),
        F.format_string("%06x", i * 7919).alias("icao24"), F.lit(None).cast("string").alias("callsign"),
        F.when(i % 5 != 0, i * 1.25 - 40).alias("longitude"), F.when(i % 7 != 0, 60 - i * 0.5).alias("latitude"),
        F.element_at(F.array(*map(F.lit, SOURCES)), (i % 3 + 1).cast("int")).alias("source"))


@pytest.fixture
def path(spark):
    return scratch_path(spark, "stored")


def test_every_row_comes_back_in_its_day(spark, path):
    given = planes(spark, 60)
    assert sinks.append(given, path, "flights") == 60
    back = sinks.read_table(spark, path, "flights")
    assert given.exceptAll(back.select(*given.columns)).isEmpty()
    assert back.where(F.col("chunk") != F.to_date("timestamp")).isEmpty()
    assert len([d for d in os.listdir(path.removeprefix("file:")) if d.startswith("chunk=")]) == 4


def test_point_needs_both_coordinates(spark, path):
    sinks.append(planes(spark, 70), path, "flights")
    back = sinks.read_table(spark, path, "flights")
    both = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    assert back.where(F.col("geom").isNotNull() != both).isEmpty()
    assert back.where(both & ((F.col("geom.lon") != F.col("longitude")) | (F.col("geom.lat") != F.col("latitude")))).isEmpty()


def test_appending_nothing_adds_nothing(spark, path):
    assert sinks.append(planes(spark, 10), path, "flights") == 10
    assert sinks.append(planes(spark, 10).where("false"), path, "flights") == 0
    assert sinks.read_table(spark, path, "flights").count() == 10


def test_insert_time_is_the_writers_unless_given(spark, path):
    noon = dt.datetime(2031, 3, 1, 12, tzinfo=dt.timezone.utc)
    own = planes(spark, 4).withColumn("ingested_at", F.when(F.col("source") == "north", F.lit(noon)))
    sinks.append(own, path, "flights")
    back = sinks.read_table(spark, path, "flights")
    assert back.where(F.col("ingested_at") == F.lit(noon)).count() == 2
    late = back.where(F.col("ingested_at") != F.lit(noon))
    assert late.count() == 2 and late.where(F.abs(F.unix_timestamp("ingested_at") - F.unix_timestamp()) > 600).isEmpty()


def test_flags_of_departures_default_to_false(spark):
    rows = [(f, p) for f in (None, True, False) for p in (None, True, False)]
    df = spark.createDataFrame(rows, "cancelled boolean, platform_changed boolean").withColumn("timestamp", F.current_timestamp())
    got = [(r.cancelled, r.platform_changed) for r in sinks.prepare(df, "departures").collect()]
    assert sorted(got) == sorted((bool(f), bool(p)) for f, p in rows)


def test_latency_percentile_between_two_rows(spark, path):
    ms = spark.range(11).select(F.timestamp_seconds(F.lit(1_930_000_000)).alias("timestamp"), (F.col("id") ** 2 * 10).alias("ms"))
    df = ms.select("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + (F.col("ms") * 1000).cast("long")).alias("ingested_at"),
                   F.lit("x").alias("source"))
    sinks.append(df, path, "flights")
    p99 = agg.latency_p99_or_zero(sinks.read_table(spark, path, "flights")).first().p99_ms
    assert p99 == pytest.approx(810 + 0.9 * (1000 - 810))  # rank 9.9 of 0 .. 10


def test_shorter_columns_are_padded(spark):
    df = spark.range(3).select("id", F.sequence(F.lit(0), F.lit(3)).alias("a"), F.sequence(F.lit(1), (F.col("id") + 1).cast("int")).alias("b"))
    rows = sinks.unnest_columns(df, ["a", "b"]).collect()
    assert sorted((r.id, r.a, r.b or 0) for r in rows) == [(i, a, a + 1 if a <= i else 0) for i in range(3) for a in range(4)]


def test_idempotent_append_with_missing_ids(spark):
    def rows(n):
        return planes(spark, n).withColumn("icao24", F.when(F.col("longitude").isNull(), None).otherwise(F.col("icao24"))) \
            .withColumn("chunk", F.to_date("timestamp")).withColumn("ingested_at", F.current_timestamp())

    batch = rows(30)
    key = ("source", "icao24", "timestamp")
    same_time = batch.withColumn("timestamp", F.lit(dt.datetime(2031, 2, 27, 12))).withColumn("chunk", F.to_date("timestamp")).withColumn("source", F.lit("north"))
    for given in (batch, same_time):  # rows without an id that differ elsewhere are all kept
        twice = given.unionByName(given)
        first = sinks.append_idempotent(twice, given.where("false"), key)
        gone = given.where("icao24 is null").drop("ingested_at").distinct().count()
        assert first.where("icao24 is not null").count() == given.where("icao24 is not null").count()
        assert first.where("icao24 is null").count() == gone > 1
        assert sinks.append_idempotent(twice, given, key).isEmpty()  # a retry adds nothing
        part = given.where("source != 'south'")
        assert sinks.append_idempotent(given, part, key).where("source != 'south'").isEmpty()
    assert sinks.append_idempotent(batch.where("false"), batch, key).isEmpty()
