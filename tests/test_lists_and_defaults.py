"""Fixed station lists, alerts stored beside positions, newest rows by key."""

from pyspark.sql import functions as F

from movelake import jobs
from movelake.operators import layout, sinks
from movelake.plans import catalog
from movelake.session import scratch_path
from movelake.sources import dims, landed, rail

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_station_lists_have_unique_ids(spark):
    for feed, n in (("ch", 47), ("be", 20), ("at", 20)):
        rows = dims.stations(spark, feed).collect()
        assert len(rows) == len({r.endpoint for r in rows}) == n
        assert all(r.station_name for r in rows)


def test_board_job_takes_the_feeds_own_list(spark):
    one, other = "8500010", "no such id"
    docs = landed.land_board_ch(spark, SF).withColumn("endpoint", F.when(F.col("endpoint") == "3", one).otherwise(other))
    path = scratch_path(spark, "departures")
    jobs.ingest(spark, "board_ch", docs, path)
    names = {(r.station_id, r.station_name) for r in sinks.read_table(spark, path, "departures").select("station_id", "station_name").distinct().collect()}
    assert names == {("sbb:8500010", "Basel SBB"), ("sbb:no such id", None)}


def test_station_list_is_broadcast_by_its_size(spark):
    docs = landed.land_board_be(spark, SF)
    small = rail.norm_departures_be(docs, dims.stations(spark, "be"))
    assert "BroadcastHashJoin [endpoint" in plan(small)
    large = spark.range(10_000_000).select(F.col("id").cast("string").alias("endpoint"), F.lit("x").alias("station_name"))
    assert "SortMergeJoin [endpoint" in plan(rail.norm_departures_be(docs, large))


def test_alerts_and_positions_from_one_decoding(spark):
    docs = landed.land_gtfs(spark, SF)
    vehicles, alerts = scratch_path(spark, "vehicle_positions"), scratch_path(spark, "service_alerts")
    first = jobs.ingest(spark, "gtfs_rt", docs, vehicles, alerts_path=alerts, run="r1")
    again = jobs.ingest(spark, "gtfs_rt", docs, vehicles, alerts_path=alerts, run="r1")
    assert first["alerts"] > 0 and first["rows"] > 0
    assert (again["alerts"], again["rows"]) == (0, 0)
    assert sinks.read_table(spark, alerts, "service_alerts").count() == first["alerts"]
    assert sinks.read_table(spark, vehicles, "vehicle_positions").count() == first["rows"]


def test_recent_rows_prune_chunks_and_keep_ties_apart(spark):
    rows = [("2024-01-%02d 12:00:00" % d, "2024-01-%02d 12:00:0%d" % (d, k), "hot" if k else "cold") for d in range(1, 29) for k in (0, 1, 1, 2)]
    df = spark.createDataFrame(rows, "timestamp string, ingested_at string, icao24 string").select(
        F.to_timestamp("timestamp").alias("timestamp"), F.to_timestamp("ingested_at").alias("ingested_at"), "icao24", F.lit("s").alias("source"))
    path = scratch_path(spark, "flights")
    sinks.append(df, path, "flights")
    stored = sinks.read_table(spark, path, "flights")
    got = layout.recent_rows(stored, "flights", "icao24", "2024-01-29 00:00:00", "3 days", 4)
    assert "PartitionFilters: [isnotnull(chunk" in plan(got) and "WindowGroupLimit" in plan(got)
    kept = sorted((r.icao24, r.rank, str(r.timestamp), str(r.ingested_at)[-2:]) for r in got.collect())
    assert kept == [("cold", 1, "2024-01-28 12:00:00", "00"), ("cold", 2, "2024-01-27 12:00:00", "00"), ("cold", 3, "2024-01-26 12:00:00", "00"),
                    ("hot", 1, "2024-01-28 12:00:00", "02"), ("hot", 2, "2024-01-28 12:00:00", "01"), ("hot", 3, "2024-01-28 12:00:00", "01"),
                    ("hot", 4, "2024-01-27 12:00:00", "02")]


def test_limits_bind(spark):
    """Each of these queries would change without its operator."""
    n = {k: catalog.QUERIES[k](spark, SF).count() for k in ("top_departures_by_station", "throughput_collapse_low", "recent_by_mover", "dedup_pings_batches")}
    from movelake.sources import standin
    assert n["top_departures_by_station"] < standin.departures(spark, SF).count()
    assert 0 < n["throughput_collapse_low"] < catalog.QUERIES["throughput_collapse"](spark, SF).count()
    assert n["recent_by_mover"] < standin.flights(spark, SF).count()
    assert n["dedup_pings_batches"] < catalog.QUERIES["norm_ship_messages"](spark, SF).count()
    assert {r.alarm for r in catalog.QUERIES["latency_alarm_by_source"](spark, SF).collect()} == {True, False}
