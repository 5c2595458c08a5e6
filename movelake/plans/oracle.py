"""DuckDB twins of the stand-in views and of every registered query.

Each SQL string is self-contained: it starts with the CTEs of the stand-in
views it reads (same formulas as ``movelake.sources.standin``) and runs on
the driver's pre-registered parquet views.
"""

from __future__ import annotations


def _lat(e: str) -> str:
    return f"(CAST(({e} * 7919) % 180000 AS DOUBLE) / 1000.0 - 90.0)"


def _lon(e: str) -> str:
    return f"(CAST(({e} * 104729) % 360000 AS DOUBLE) / 1000.0 - 180.0)"


_CTE = {}
_DEPS = {}

_CTE["ev"] = """ev AS (
  SELECT event_id, user_id, event_type, value, ts AS "timestamp",
         make_timestamp(epoch_us(ts) + CAST(floor(value * 10000) AS BIGINT)) AS ingested_at
  FROM events)"""

_CTE["flights_x"] = f"""flights_x AS (
  SELECT "timestamp", ingested_at,
         printf('%06x', user_id) AS icao24,
         'FL' || CAST(user_id AS VARCHAR) AS callsign,
         CASE WHEN event_type = 'view' THEN 'C' || CAST(user_id % 7 AS VARCHAR) END AS origin_country,
         CASE WHEN event_id % 17 <> 0 THEN {_lon('event_id')} END AS longitude,
         CASE WHEN event_id % 17 <> 0 THEN {_lat('event_id')} END AS latitude,
         CASE WHEN event_type <> 'error' THEN value * 100.0 END AS baro_altitude,
         CASE WHEN event_type = 'error' THEN TRUE WHEN event_type = 'view' THEN FALSE END AS on_ground,
         value AS velocity,
         CAST(event_id % 360 AS DOUBLE) AS true_track,
         CAST(user_id % 21 - 10 AS DOUBLE) * 64.0 AS vertical_rate,
         CASE event_type WHEN 'view' THEN 'opensky' WHEN 'click' THEN 'adsblol'
              WHEN 'signup' THEN 'airplaneslive' WHEN 'purchase' THEN 'adsbfi'
              WHEN 'error' THEN 'adsbone' END AS source,
         event_id, value, event_type, user_id
  FROM ev)"""
_DEPS["flights_x"] = ["ev"]

_CTE["flights"] = """flights AS (
  SELECT "timestamp", ingested_at, icao24, callsign, origin_country, longitude, latitude,
         baro_altitude, on_ground, velocity, true_track, vertical_rate, source,
         CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN longitude END AS geom_lon,
         CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN latitude END AS geom_lat
  FROM flights_x)"""
_DEPS["flights"] = ["flights_x"]

_CTE["ship_pings"] = f"""ship_pings AS (
  SELECT e."timestamp", e.ingested_at,
         CAST(200000000 + e.user_id AS VARCHAR) AS mmsi,
         CASE WHEN e.user_id % 5 <> 0 THEN 'MV ' || CAST(e.user_id AS VARCHAR) END AS ship_name,
         {_lat('e.event_id')} + c.dlat AS latitude,
         {_lon('e.event_id')} AS longitude,
         CASE WHEN e.event_type = 'view' THEN 'PositionReport'
              ELSE 'StandardClassBPositionReport' END AS message_type,
         e.event_id * 3 + c.k AS seq
  FROM ev e
  JOIN (VALUES (0, CAST(0.0 AS DOUBLE)), (1, CAST(4e-7 AS DOUBLE)), (2, CAST(2e-5 AS DOUBLE))) c(k, dlat)
    ON c.k = 0 OR (c.k = 1 AND e.event_id % 5 = 0) OR (c.k = 2 AND e.event_id % 7 = 0))"""
_DEPS["ship_pings"] = ["ev"]

_CTE["ships"] = """ships AS (
  SELECT "timestamp", ingested_at, mmsi, ship_name, latitude, longitude, message_type,
         longitude AS geom_lon, latitude AS geom_lat
  FROM ship_pings)"""
_DEPS["ships"] = ["ship_pings"]

_CTE["vehicle_positions"] = f"""vehicle_positions AS (
  SELECT "timestamp", ingested_at,
         CAST(epoch_us("timestamp") // 1000000 AS BIGINT) AS feed_timestamp,
         'v' || CAST(user_id AS VARCHAR) AS vehicle_id,
         't' || CAST(event_id % 97 AS VARCHAR) AS trip_id,
         event_type AS route_id,
         {_lat('event_id')} AS latitude, {_lon('event_id')} AS longitude,
         CAST(event_id % 360 AS FLOAT) AS bearing, CAST(value AS FLOAT) AS speed,
         {_lon('event_id')} AS geom_lon, {_lat('event_id')} AS geom_lat
  FROM ev)"""
_DEPS["vehicle_positions"] = ["ev"]

_CTE["departures"] = """departures AS (
  SELECT l_shipdate AS "timestamp",
         make_timestamp(epoch_us(l_shipdate) + CAST(l_linenumber AS BIGINT) * 1000000) AS ingested_at,
         'be:' || CAST(n_nationkey AS VARCHAR) AS station_id,
         n_name AS station_name,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trip_id,
         'IC ' || CAST(l_partkey % 100 AS VARCHAR) AS line_name,
         c_mktsegment AS direction,
         make_timestamp(epoch_us(o_orderdate) + CAST(l_linenumber AS BIGINT) * 3600000000) AS planned_time,
         make_timestamp(epoch_us(o_orderdate) + CAST(l_linenumber AS BIGINT) * 3600000000
                        + CAST((floor(l_quantity) - 25) * 60 AS BIGINT) * 1000000) AS actual_time,
         CAST((floor(l_quantity) - 25) * 60 AS INTEGER) AS delay_seconds,
         l_returnflag = 'R' AS cancelled,
         l_linestatus AS platform_planned,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS platform_actual,
         (CASE WHEN l_returnflag <> 'N' THEN l_returnflag END) IS NOT NULL
           AND l_linestatus IS DISTINCT FROM (CASE WHEN l_returnflag <> 'N' THEN l_returnflag END)
           AS platform_changed
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

_CTE["sat_elements"] = """sat_elements AS (
  SELECT c.category,
         make_timestamp((1704067200 + (p_partkey % 60) * 86400 + (p_partkey % 24) * 3600) * 1000000)
           AS "timestamp",
         make_timestamp((1704067200 + (p_partkey % 60) * 86400 + (p_partkey % 24) * 3600) * 1000000
                        + CAST(p_size AS BIGINT) * 1000) AS ingested_at,
         CAST(p_partkey AS INTEGER) AS norad_id,
         upper(p_name) AS name,
         make_timestamp((1704067200 + CAST(p_size AS BIGINT) * 86400) * 1000000) AS epoch,
         p_retailprice / 100.0 AS mean_motion,
         CAST(p_size AS DOUBLE) * 1.5 AS inclination,
         CAST(p_size AS DOUBLE) / 1000.0 AS eccentricity,
         '1 ' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') || 'U' AS tle_line1,
         '2 ' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS tle_line2,
         c.cat_idx
  FROM part
  JOIN (VALUES ('starlink', 1, 1), ('active', 0, 17)) c(category, only7, cat_idx)
    ON c.only7 = 0 OR p_partkey % 7 = 0)"""

_CTE["satellites"] = """satellites AS (
  SELECT "timestamp", ingested_at, norad_id, name, epoch, mean_motion, inclination,
         eccentricity, tle_line1, tle_line2
  FROM sat_elements)"""
_DEPS["satellites"] = ["sat_elements"]


def ctes(*names: str, extra: list[str] | None = None) -> str:
    """WITH clause for the named views, dependencies first."""
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [_CTE[n] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


def lat_sql(e: str) -> str:
    return _lat(e)


def lon_sql(e: str) -> str:
    return _lon(e)
