"""Stand-in movement tables derived from the driver's parquet tables.

The driver data holds no movement data, so each movement table is a
deterministic projection of a driver table (``events`` -> flights, ships,
vehicle positions; ``lineitem``/``orders``/``customer``/``nation`` ->
departures; ``part`` -> satellites). The oracle SQL in
``movelake.plans.oracle`` spells the same formulas in DuckDB. Every view
reads only the columns it needs, so the parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from movelake.functions.rules import make_point
from movelake.session import ensure_utc


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micros_add(ts: Column, micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def _lat(event_id: Column) -> Column:
    return (event_id * 7919 % 180000).cast("double") / F.lit(1000.0) - F.lit(90.0)


def _lon(event_id: Column) -> Column:
    return (event_id * 104729 % 360000).cast("double") / F.lit(1000.0) - F.lit(180.0)


# Fixed values (stand-in only): event_type -> aircraft feed name.
EVENT_SOURCE = {"view": "opensky", "click": "adsblol", "signup": "airplaneslive",
                "purchase": "adsbfi", "error": "adsbone"}


def _source(event_type: Column) -> Column:
    expr = None
    for k, v in EVENT_SOURCE.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id", "user_id", "event_type", "value",
        ts.alias("timestamp"),
        _micros_add(ts, F.floor(F.col("value") * 10000)).alias("ingested_at"))


def flights(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    return _events(spark, sf_dir).select(*flight_columns(with_event_id))


def flight_columns(with_event_id: bool = False) -> list[Column]:
    """The columns of ``flights`` over ``_events``."""
    eid = F.col("event_id")
    missing = (eid % 17) == 0
    lat = F.when(~missing, _lat(eid))
    lon = F.when(~missing, _lon(eid))
    et = F.col("event_type")
    cols = [
        F.col("timestamp"), F.col("ingested_at"),
        F.format_string("%06x", F.col("user_id")).alias("icao24"),
        F.concat(F.lit("FL"), F.col("user_id").cast("string")).alias("callsign"),
        F.when(et == "view", F.concat(F.lit("C"), (F.col("user_id") % 7).cast("string")))
         .alias("origin_country"),
        lon.alias("longitude"), lat.alias("latitude"),
        F.when(et != "error", F.col("value") * F.lit(100.0)).alias("baro_altitude"),
        F.when(et == "error", F.lit(True)).when(et == "view", F.lit(False)).alias("on_ground"),
        F.col("value").alias("velocity"),
        (eid % 360).cast("double").alias("true_track"),
        (((F.col("user_id") % 21) - 10).cast("double") * F.lit(64.0)).alias("vertical_rate"),
        make_point(lon, lat).alias("geom"),
        _source(et).alias("source"),
    ]
    if with_event_id:
        cols.append(eid.alias("event_id"))
        cols.append(F.col("value").alias("value"))
        cols.append(et.alias("event_type"))
        cols.append(F.col("user_id"))
    return cols


def ship_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ship pings of all events in arrival order (``seq``), with near-duplicates:
    each 5th event is repeated 4e-7 deg away (same 1e-5 cell), each 7th is
    repeated 2e-5 deg away (a different cell)."""
    e = _events(spark, sf_dir)
    eid = F.col("event_id")
    copies = F.array(
        F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("dlat")),
        F.struct(F.lit(1).alias("k"), F.lit(4e-7).alias("dlat")),
        F.struct(F.lit(2).alias("k"), F.lit(2e-5).alias("dlat")))
    keep = ((F.col("c.k") == 0) | ((F.col("c.k") == 1) & (eid % 5 == 0))
            | ((F.col("c.k") == 2) & (eid % 7 == 0)))
    x = e.withColumn("c", F.explode(copies)).where(keep)
    lat = _lat(eid) + F.col("c.dlat")
    lon = _lon(eid)
    return x.select(
        "timestamp", "ingested_at",
        (F.lit(200000000) + F.col("user_id")).cast("string").alias("mmsi"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("MV "), F.col("user_id").cast("string")))
         .alias("ship_name"),
        lat.alias("latitude"), lon.alias("longitude"),
        F.when(F.col("event_type") == "view", F.lit("PositionReport"))
         .otherwise(F.lit("StandardClassBPositionReport")).alias("message_type"),
        make_point(lon, lat).alias("geom"),
        (eid * 3 + F.col("c.k")).alias("seq"),
    )


def ships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship_pings(spark, sf_dir).drop("seq")


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    eid = F.col("event_id")
    lat, lon = _lat(eid), _lon(eid)
    return e.select(
        "timestamp", "ingested_at",
        F.unix_seconds(F.col("timestamp")).alias("feed_timestamp"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.concat(F.lit("t"), (eid % 97).cast("string")).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        lat.alias("latitude"), lon.alias("longitude"),
        (eid % 360).cast("float").alias("bearing"),
        F.col("value").cast("float").alias("speed"),
        make_point(lon, lat).alias("geom"),
    )


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departure_lines(spark, sf_dir).select(*departure_columns())


def departure_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer x nation, as they are stored.

    orders/customer join on the customer key and lineitem on the order key
    (shuffle joins at scale): the largest table is shuffled once. nation (25
    rows) is broadcast.
    """
    ensure_utc(spark)
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    od = (od.join(cu, od.o_custkey == cu.c_custkey)
            .join(F.broadcast(na), F.col("c_nationkey") == na.n_nationkey))
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))


def departure_columns() -> list[Column]:
    """The columns of ``departures`` over ``departure_lines``."""
    ship = F.col("l_shipdate").cast("timestamp")
    planned = _micros_add(F.col("o_orderdate").cast("timestamp"),
                          F.col("l_linenumber").cast("long") * F.lit(3_600_000_000))
    delay = ((F.floor(F.col("l_quantity")) - 25) * 60).cast("int")
    p_actual = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return [
        ship.alias("timestamp"),
        _micros_add(ship, F.col("l_linenumber").cast("long") * F.lit(1_000_000)).alias("ingested_at"),
        F.concat(F.lit("be:"), F.col("n_nationkey").cast("string")).alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("trip_id"),
        F.concat(F.lit("IC "), (F.col("l_partkey") % 100).cast("string")).alias("line_name"),
        F.col("c_mktsegment").alias("direction"),
        planned.alias("planned_time"),
        _micros_add(planned, delay.cast("long") * F.lit(1_000_000)).alias("actual_time"),
        delay.alias("delay_seconds"),
        (F.col("l_returnflag") == "R").alias("cancelled"),
        F.col("l_linestatus").alias("platform_planned"),
        p_actual.alias("platform_actual"),
        (p_actual.isNotNull() & ~F.col("l_linestatus").eqNullSafe(p_actual)).alias("platform_changed"),
    ]


SAT_BASE_SECONDS = 1704067200  # 2024-01-01T00:00:00Z


def satellite_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orbital elements per (category, satellite): every part is in the
    'active' category, each 7th one also in 'starlink' (same elements)."""
    ensure_utc(spark)
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    cats = F.when(k % 7 == 0, F.array(F.lit("starlink"), F.lit("active"))).otherwise(
        F.array(F.lit("active")))
    ts_s = (F.lit(SAT_BASE_SECONDS) + (k % 60) * 86400 + (k % 24) * 3600)
    ts = F.timestamp_seconds(ts_s)
    pad = F.lpad(k.cast("string"), 5, "0")
    return p.select(
        F.explode(cats).alias("category"),
        ts.alias("timestamp"),
        _micros_add(ts, F.col("p_size").cast("long") * F.lit(1000)).alias("ingested_at"),
        k.cast("int").alias("norad_id"),
        F.upper(F.col("p_name")).alias("name"),
        F.timestamp_seconds(F.lit(SAT_BASE_SECONDS) + F.col("p_size").cast("long") * 86400).alias("epoch"),
        (F.col("p_retailprice") / F.lit(100.0)).alias("mean_motion"),
        (F.col("p_size").cast("double") * F.lit(1.5)).alias("inclination"),
        (F.col("p_size").cast("double") / F.lit(1000.0)).alias("eccentricity"),
        F.concat(F.lit("1 "), pad, F.lit("U")).alias("tle_line1"),
        F.concat(F.lit("2 "), pad).alias("tle_line2"),
    )


def satellites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return satellite_elements(spark, sf_dir).drop("category")


VIEWS = {
    "flights": flights,
    "ships": ships,
    "departures": departures,
    "vehicle_positions": vehicle_positions,
    "satellites": satellites,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)
