"""Oracle SQL (DuckDB) per registered query. Column names and rounding
match the Spark side exactly."""

from __future__ import annotations

from movelake.plans.oracle import ctes, lat_sql, lon_sql

ORACLE: dict = {}


def _lat_ms(t: str = "") -> str:
    p = f"{t}." if t else ""
    return f'(epoch_us({p}ingested_at) - epoch_us({p}"timestamp")) / 1000.0'


def _pcts(x: str, digits: int = 6) -> str:
    return (f"round(quantile_cont({x}, 0.5), {digits}) AS p50_ms, "
            f"round(quantile_cont({x}, 0.95), {digits}) AS p95_ms, "
            f"round(quantile_cont({x}, 0.99), {digits}) AS p99_ms, count(*) AS samples")


def _lat_block(table: str, window: str | None, as_of: str) -> str:
    where = f"WHERE ingested_at > {as_of} - INTERVAL '{window}'" if window else ""
    return f"SELECT '{table}' AS \"table\", {_pcts(_lat_ms())} FROM {table} {where}"


ORACLE["latency_percentiles"] = (
    ctes("flights", "ships")
    + "SELECT * FROM (\n"
    + _lat_block("flights", "5 minutes",
                 "(SELECT greatest((SELECT max(ingested_at) FROM flights), (SELECT max(ingested_at) FROM ships)))")
    + "\nUNION ALL\n"
    + _lat_block("ships", "5 minutes",
                 "(SELECT greatest((SELECT max(ingested_at) FROM flights), (SELECT max(ingested_at) FROM ships)))")
    + ")")

ORACLE["latency_percentiles_all"] = (
    ctes("flights", "ships", "vehicle_positions", "departures", "satellites")
    + "\nUNION ALL\n".join(_lat_block(t, None, "")
                           for t in ["flights", "ships", "vehicle_positions", "departures", "satellites"]))


FIVE = ["flights", "ships", "vehicle_positions", "departures", "satellites"]
GEO3 = ["flights", "ships", "vehicle_positions"]

ORACLE["latency_p99_by_minute"] = ctes("flights") + f"""
SELECT date_trunc('minute', ingested_at) AS "time",
       round(quantile_cont({_lat_ms()}, 0.99), 6) AS p99_ms_flights
FROM flights
WHERE ingested_at BETWEEN (SELECT min(ingested_at) FROM flights) AND (SELECT max(ingested_at) FROM flights)
GROUP BY 1 ORDER BY 1"""

ORACLE["latency_alarm"] = ctes("flights") + """
SELECT p99_seconds, p99_seconds > 2.0 AS alarm FROM (
  SELECT round(quantile_cont((epoch_us(ingested_at) - epoch_us("timestamp")) / 1000000.0, 0.99), 6)
         AS p99_seconds
  FROM flights
  WHERE ingested_at > (SELECT max(ingested_at) FROM flights) - INTERVAL '60 seconds')"""

ORACLE["latency_p99_or_zero"] = ctes("flights") + f"""
SELECT round(coalesce(quantile_cont({_lat_ms()}, 0.99), 0.0), 6) AS p99_ms FROM flights"""

ORACLE["row_counts"] = ctes(*FIVE) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\" FROM {t}" for t in FIVE)

ORACLE["count_filtered"] = ctes(*GEO3) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", "
    f"count(*) FILTER (WHERE geom_lon IS NOT NULL) AS with_geom FROM {t}" for t in GEO3)

_AS_OF5 = "greatest(" + ", ".join(f"(SELECT max(ingested_at) FROM {t})" for t in FIVE) + ")"
ORACLE["freshness"] = ctes(*FIVE) + f"""
SELECT "table", source, newest,
       (epoch_us({_AS_OF5}) - epoch_us(newest)) / 1000000.0 AS age_seconds,
       newest < {_AS_OF5} - INTERVAL '10 minutes' AS stale
FROM (
  SELECT 'flights' AS "table", source, max("timestamp") AS newest FROM flights GROUP BY source
""" + "".join(
    f"  UNION ALL SELECT '{t}', CAST(NULL AS VARCHAR), max(\"timestamp\") FROM {t}\n"
    for t in FIVE[1:]) + ")"

ORACLE["flights_per_minute"] = ctes("flights") + """
SELECT date_trunc('minute', "timestamp") AS "minute", source, count(*) AS "rows"
FROM flights GROUP BY 1, 2"""

ORACLE["ship_rate_per_hour"] = ctes("ships") + """
SELECT date_trunc('hour', "timestamp") AS "hour", message_type, count(*) AS "rows",
       round(count(*) / 3600.0, 6) AS per_second
FROM ships GROUP BY 1, 2"""

ORACLE["delay_histogram"] = ctes("departures") + """
SELECT CAST(planned_time AS DATE) AS "day", station_id,
       CAST(floor(delay_seconds / 60) AS BIGINT) AS delay_min,
       count(*) AS departures, count(*) FILTER (WHERE cancelled) AS cancelled
FROM departures GROUP BY 1, 2, 3"""

ORACLE["delay_trend"] = ctes("departures") + """
SELECT CAST(planned_time AS DATE) AS "day", count(*) AS departures,
       round(avg(delay_seconds), 6) AS avg_delay_s,
       round(quantile_cont(CAST(delay_seconds AS DOUBLE), 0.5), 6) AS p50_delay_s,
       round(quantile_cont(CAST(delay_seconds AS DOUBLE), 0.95), 6) AS p95_delay_s,
       count(*) FILTER (WHERE cancelled) AS cancelled
FROM departures
WHERE planned_time > (SELECT max(planned_time) FROM departures) - INTERVAL '90 days'
GROUP BY 1"""

ORACLE["ship_density"] = ctes("ships") + """
SELECT CAST(floor(latitude / 1.0) AS BIGINT) AS cell_lat, CAST(floor(longitude / 1.0) AS BIGINT) AS cell_lon,
       count(*) AS messages, count(DISTINCT mmsi) AS ships
FROM ships
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND "timestamp" > (SELECT max(ingested_at) FROM ships) - INTERVAL '7 days'
GROUP BY 1, 2"""

ORACLE["throughput_report"] = ctes(*GEO3) + "\nUNION ALL\n".join(f"""
SELECT '{t}' AS "table", count(*) AS "rows",
       round((epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1000000.0, 6) AS span_seconds,
       round(CASE WHEN max(ingested_at) > min(ingested_at) THEN count(*) /
             ((epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1000000.0) END, 6) AS avg_rows_per_s,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM {t} GROUP BY date_trunc('hour', ingested_at))) AS peak_hour_rows,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM {t} GROUP BY date_trunc('minute', ingested_at))) AS peak_minute_rows
FROM {t}""" for t in GEO3)

_FLEET = {"flights": ("source", "icao24"), "ships": ("message_type", "mmsi"),
          "vehicle_positions": ("route_id", "vehicle_id"), "departures": (None, "station_id"),
          "satellites": (None, "norad_id")}
ORACLE["fleet_totals"] = ctes(*FIVE) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", {('CAST(NULL AS VARCHAR)' if s is None else s)} AS source, "
    f"count(*) AS \"rows\", count(DISTINCT {k}) AS movers FROM {t} GROUP BY 1, 2"
    for t, (s, k) in _FLEET.items())

_FROWS = 'icao24, "timestamp", ingested_at, latitude, longitude, source'
ORACLE["filter_has_position"] = ctes("flights") + f"""
SELECT {_FROWS} FROM flights WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""
ORACLE["filter_required_keys"] = ctes("flights") + f"""
SELECT {_FROWS} FROM flights WHERE icao24 IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""
ORACLE["filter_trailing"] = ctes("flights") + f"""
SELECT {_FROWS} FROM flights WHERE ingested_at > (SELECT max(ingested_at) FROM flights) - INTERVAL '5 minutes'"""
ORACLE["filter_time_range"] = ctes("flights") + f"""
SELECT {_FROWS} FROM flights
WHERE ingested_at BETWEEN (SELECT max(ingested_at) FROM flights) - INTERVAL '24 hours'
                      AND (SELECT max(ingested_at) FROM flights)"""
ORACLE["filter_bbox"] = ctes("ships") + """
SELECT mmsi, "timestamp", latitude, longitude FROM ships
WHERE (latitude BETWEEN 35.0 AND 60.0 AND longitude BETWEEN -10.0 AND 30.0)
   OR (latitude BETWEEN -40.0 AND -10.0 AND longitude BETWEEN 100.0 AND 155.0)"""
ORACLE["filter_sources"] = ctes("flights") + f"""
SELECT {_FROWS} FROM flights WHERE source IN ('opensky', 'adsblol')"""
ORACLE["point_lookup"] = ctes("vehicle_positions") + """
SELECT vehicle_id, "timestamp", geom_lon AS x, geom_lat AS y FROM vehicle_positions WHERE vehicle_id = 'v1'"""

ORACLE["all_positions"] = ctes(*GEO3) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS kind, {k} AS id, \"timestamp\" AS ts, latitude AS lat, longitude AS lon "
    f"FROM {t} WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
    for t, k in [("flights", "icao24"), ("ships", "mmsi"), ("vehicle_positions", "vehicle_id")])

ORACLE["geom_consistency"] = ctes(*GEO3) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", count(*) FILTER (WHERE geom_lon IS NULL) AS geom_null, "
    f"count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS coord_null, "
    f"count(*) FILTER (WHERE (geom_lon IS NULL) <> (latitude IS NULL OR longitude IS NULL)) AS violations "
    f"FROM {t}" for t in GEO3)


ORACLE["dedup_pings"] = ctes("ship_pings") + """
SELECT mmsi, "timestamp", latitude, longitude, message_type, ship_name, seq FROM (
  SELECT *, row_number() OVER (
      PARTITION BY mmsi, round(latitude * 1e5), round(longitude * 1e5), epoch_us("timestamp") // 1000000
      ORDER BY seq) AS rn
  FROM ship_pings) WHERE rn = 1 ORDER BY seq"""

ORACLE["dedup_aircraft"] = ctes("flights") + """
SELECT cycle_ts, icao24, "timestamp", source, latitude, longitude FROM (
  SELECT make_timestamp((epoch_us("timestamp") // 300000000) * 300000000) AS cycle_ts, *,
         row_number() OVER (PARTITION BY epoch_us("timestamp") // 300000000, icao24
                            ORDER BY ingested_at, "timestamp") AS rn
  FROM flights WHERE icao24 IS NOT NULL) WHERE rn = 1"""

ORACLE["dedup_orbits"] = ctes("sat_elements") + """
SELECT norad_id, name, epoch, category FROM (
  SELECT *, row_number() OVER (PARTITION BY norad_id, epoch ORDER BY cat_idx) AS rn FROM sat_elements)
WHERE rn = 1"""

_SECS = "\nUNION ALL\n".join(
    f"SELECT DISTINCT '{t}' AS t, epoch_us(ingested_at) // 1000000 AS sec FROM {t}" for t in GEO3)
ORACLE["stall_gaps"] = ctes(*GEO3, extra=[f"s AS ({_SECS})"]) + """
SELECT t AS "table", make_timestamp(prev * 1000000) AS gap_start, make_timestamp(sec * 1000000) AS gap_end,
       sec - prev AS gap_seconds
FROM (SELECT t, sec, lag(sec) OVER (PARTITION BY t ORDER BY sec) AS prev FROM s)
WHERE sec - prev > 120"""

_PERSEC = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS t, epoch_us(ingested_at) // 1000000 AS sec, count(*) AS n FROM {t} GROUP BY 2"
    for t in GEO3)
ORACLE["throughput_collapse"] = ctes(*GEO3, extra=[f"c AS ({_PERSEC})"]) + """
SELECT t AS "table", make_timestamp(sec * 1000000) AS "second", CAST(w AS BIGINT) AS rows_in_window FROM (
  SELECT t, sec, sum(n) OVER (PARTITION BY t ORDER BY sec RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS w,
         min(sec) OVER (PARTITION BY t) AS start
  FROM c)
WHERE sec - start > 300 AND w < 1000"""

ORACLE["latest_position"] = ctes(*GEO3) + "\nUNION ALL\n".join(f"""
SELECT kind, id, "timestamp", latitude, longitude FROM (
  SELECT '{t}' AS kind, {k} AS id, "timestamp", latitude, longitude,
         row_number() OVER (PARTITION BY {k} ORDER BY "timestamp" DESC, ingested_at DESC,
                            latitude DESC, longitude DESC) AS rn
  FROM {t} WHERE latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1"""
    for t, k in [("flights", "icao24"), ("ships", "mmsi"), ("vehicle_positions", "vehicle_id")])

ORACLE["mover_track"] = ctes("flights") + """
SELECT icao24, "timestamp", latitude, longitude FROM flights
WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY icao24, "timestamp" """

ORACLE["session_summary"] = ctes("ship_pings") + """
SELECT make_timestamp(b * 600000000) AS window_start, make_timestamp((b + 1) * 600000000) AS window_end,
       CAST(sum(n) AS BIGINT) AS messages, count(*) AS inserted
FROM (SELECT epoch_us("timestamp") // 600000000 AS b, count(*) AS n FROM ship_pings
      GROUP BY b, mmsi, round(latitude * 1e5), round(longitude * 1e5), epoch_us("timestamp") // 1000000)
GROUP BY b"""

ORACLE["top_departures"] = ctes("departures") + """
SELECT station_id, "timestamp", trip_id, planned_time, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY planned_time, trip_id) AS "rank"
  FROM departures) WHERE "rank" <= 30"""

from movelake.sources.dims import NM_KM, REGION_GRID, REGION_RADIUS_NM  # noqa: E402

_REGIONS = ", ".join(f"({i}, '{n}', {float(a)!r}, {float(b)!r})" for i, (n, a, b) in enumerate(REGION_GRID))
_RADIUS = repr(REGION_RADIUS_NM * NM_KM)


def _haversine(lat1, lon1, lat2, lon2):
    return (f"(2 * 6371.0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


ORACLE["region_coverage"] = ctes("flights", extra=[
    f"regions AS (SELECT * FROM (VALUES {_REGIONS}) r(region_idx, region, r_lat, r_lon))"]) + f"""
SELECT r.region, count(*) AS positions, count(DISTINCT icao24) AS movers FROM (
  SELECT f.icao24, f."timestamp", f.latitude, f.longitude, min(r.region_idx) AS region_idx
  FROM flights f, regions r
  WHERE f.latitude IS NOT NULL AND f.longitude IS NOT NULL
    AND {_haversine('f.latitude', 'f.longitude', 'r.r_lat', 'r.r_lon')} <= {_RADIUS}
  GROUP BY 1, 2, 3, 4) c
JOIN regions r ON r.region_idx = c.region_idx
GROUP BY r.region"""

ORACLE["station_names"] = ctes("departures") + """
SELECT station_id, station_name, count(*) AS departures FROM departures GROUP BY 1, 2"""


def _chunk(t: str) -> str:
    if t == "satellites":
        return ("(DATE '1970-01-01' + CAST(floor(date_diff('day', DATE '1970-01-01', "
                "CAST(\"timestamp\" AS DATE)) / 7) * 7 AS INTEGER))")
    return 'CAST("timestamp" AS DATE)'


_CHUNK_DAYS = {"satellites": 7}
_COMPACT_DAYS = {"satellites": 14}

ORACLE["chunk_counts"] = ctes(*FIVE) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", {_chunk(t)} AS chunk, count(*) AS \"rows\" FROM {t} GROUP BY 2" for t in FIVE)

ORACLE["chunks_to_compact"] = ctes(*FIVE) + "\nUNION ALL\n".join(f"""
SELECT '{t}' AS "table", chunk, count(*) AS "rows" FROM (SELECT {_chunk(t)} AS chunk FROM {t})
GROUP BY chunk
HAVING CAST(chunk + {_CHUNK_DAYS.get(t, 1)} AS TIMESTAMP)
       <= (SELECT max(ingested_at) FROM {t}) - INTERVAL '{_COMPACT_DAYS.get(t, 7)} days'""" for t in FIVE)

_RET = {"flights": 7, "ships": 7, "vehicle_positions": 3, "departures": 30}


def _keep(t):
    d = _RET.get(t)
    if d is None:
        return "TRUE"
    return (f"CAST(chunk + {_CHUNK_DAYS.get(t, 1)} AS TIMESTAMP) > "
            f"(SELECT max(ingested_at) FROM {t}) - INTERVAL '{d} days'")


ORACLE["retention_keep"] = ctes(*FIVE) + "\nUNION ALL\n".join(f"""
SELECT '{t}' AS "table",
       CAST(coalesce(sum(CASE WHEN keep THEN n ELSE 0 END), 0) AS BIGINT) AS rows_kept,
       CAST(coalesce(sum(CASE WHEN NOT keep THEN n ELSE 0 END), 0) AS BIGINT) AS rows_dropped,
       count(*) FILTER (WHERE keep) AS chunks_kept, count(*) FILTER (WHERE NOT keep) AS chunks_dropped
FROM (SELECT chunk, n, {_keep(t)} AS keep FROM
      (SELECT {_chunk(t)} AS chunk, count(*) AS n FROM {t} GROUP BY 1))""" for t in FIVE)

ORACLE["append_idempotent"] = ctes("flights") + """
SELECT DISTINCT source, icao24, "timestamp", CAST("timestamp" AS DATE) AS chunk FROM flights b
WHERE ingested_at >= (SELECT max(ingested_at) FROM flights) - INTERVAL '2 days'
  AND NOT EXISTS (SELECT 1 FROM flights t
                  WHERE t.ingested_at < (SELECT max(ingested_at) FROM flights) - INTERVAL '1 day'
                    AND t.source = b.source AND t.icao24 = b.icao24 AND t."timestamp" = b."timestamp")"""


# --- payload normalisation ----------------------------------------------------
# Document keys and damage rules mirror movelake.sources.landed:
# h = cycle_no + endpoint_idx + page; HTTP 500 when h % 23 = 0, truncated
# when h % 29 = 7.
from movelake.sources.dims import ADSB_ENDPOINTS, AIRCRAFT_TYPES  # noqa: E402

_OK = "(h % 23 <> 0 AND h % 29 <> 7)"
_AX = """ax AS (
  SELECT *, epoch_us("timestamp") // 300000000 AS cycle_no, event_id // 64 AS page FROM flights_x)"""


def _acopies(n: int, copies: bool) -> str:
    join = "JOIN (VALUES (0), (1)) c(k) ON c.k = 0 OR a.event_id % 4 = 0" if copies and n > 1 \
        else "JOIN (VALUES (0)) c(k) ON TRUE"
    return f"""acp AS (
  SELECT a.*, c.k, CAST((a.event_id % {n} + c.k) % {n} AS INTEGER) AS endpoint_idx,
         a.cycle_no + CAST((a.event_id % {n} + c.k) % {n} AS INTEGER) + a.page AS h
  FROM ax a {join})"""


def _adsb_map(source: str) -> str:
    return f"""make_timestamp(cycle_no * 300000000) AS "timestamp",
  CASE WHEN event_id % 23 <> 0 THEN icao24 END AS icao24,
  CASE WHEN event_id % 31 = 0 THEN '' ELSE callsign END AS callsign,
  CAST(NULL AS VARCHAR) AS origin_country, longitude, latitude,
  CASE WHEN event_type = 'error' OR event_id % 19 = 0 OR event_id % 13 = 0
       THEN (CASE WHEN event_id % 3 = 0 THEN value * 100.0 + 50.0 END) ELSE baro_altitude END AS baro_altitude,
  CASE WHEN event_type = 'error' THEN TRUE WHEN event_id % 19 = 0 THEN FALSE END AS on_ground,
  velocity + k AS velocity, true_track, vertical_rate, '{source}' AS source"""


_FCOLS = ('"timestamp", icao24, callsign, origin_country, longitude, latitude, baro_altitude, '
          'on_ground, velocity, true_track, vertical_rate, source')


def _adsb_rows(n, copies, source):
    return ctes("flights_x", extra=[_AX, _acopies(n, copies), f"""m AS (
  SELECT {_adsb_map(source)}, endpoint_idx, event_id, cycle_no FROM acp WHERE {_OK})"""])


def _endpoint_names(names):
    vals = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"(SELECT * FROM (VALUES {vals}) e(endpoint_idx, endpoint))"


ORACLE["norm_adsb_records"] = _adsb_rows(3, True, "adsblol") + f"""
SELECT e.endpoint, {_FCOLS} FROM m JOIN {_endpoint_names(ADSB_ENDPOINTS)} e USING (endpoint_idx)"""


def _dedup(where: str) -> str:
    return f"""
SELECT {_FCOLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY cycle_no, icao24 ORDER BY endpoint_idx, event_id) AS rn
  FROM m WHERE icao24 IS NOT NULL {where}) WHERE rn = 1"""


_POS = "AND latitude IS NOT NULL AND longitude IS NOT NULL"
ORACLE["norm_adsb_endpoints"] = _adsb_rows(3, True, "adsblol") + _dedup("")
ORACLE["norm_adsb_regions"] = _adsb_rows(len(REGION_GRID), True, "airplaneslive") + _dedup(_POS)
ORACLE["norm_adsb_types"] = _adsb_rows(len(AIRCRAFT_TYPES), True, "adsbone") + _dedup(_POS)
ORACLE["norm_adsb_snapshot"] = _adsb_rows(1, False, "adsbfi") + f"""
SELECT {_FCOLS} FROM m WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""

ORACLE["norm_private_feeder"] = ctes("flights_x", extra=[_AX, """pv AS (
  SELECT *, cycle_no + page AS h,
         bool_or(event_id % 37 = 0) OVER (PARTITION BY cycle_no, page) AS bad_doc,
         CASE WHEN event_id % 3 = 0 THEN CAST(CAST(floor(value * 100.0) AS INTEGER) AS DOUBLE) END AS alt_geom
  FROM ax)""", """alt AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 0.0
                 WHEN event_id % 19 = 0 OR event_id % 13 = 0 THEN alt_geom
                 ELSE baro_altitude END AS alt_v
  FROM pv WHERE (h % 23 <> 0 AND h % 29 <> 7) AND NOT bad_doc)"""]) + """
SELECT make_timestamp(cycle_no * 300000000) AS "timestamp", icao24,
       CASE WHEN event_id % 31 = 0 THEN '' ELSE callsign END AS callsign,
       CAST(NULL AS VARCHAR) AS origin_country, longitude, latitude,
       CAST(alt_v AS DOUBLE) AS baro_altitude, coalesce(alt_v = 0.0, FALSE) AS on_ground,
       velocity, true_track, vertical_rate, 'private' AS source
FROM alt WHERE event_id % 23 <> 0 AND latitude IS NOT NULL AND longitude IS NOT NULL"""

ORACLE["norm_state_vectors"] = ctes("flights_x", extra=[_AX]) + """
SELECT make_timestamp(cycle_no * 300000000) AS "timestamp", icao24, callsign, origin_country,
       longitude, CASE WHEN event_id % 13 = 0 THEN NULL ELSE latitude END AS latitude,
       baro_altitude, on_ground, velocity, true_track, vertical_rate, 'opensky' AS source
FROM ax WHERE ((cycle_no + page) % 23 <> 0 AND (cycle_no + page) % 29 <> 7) AND event_id % 11 <> 0"""

ORACLE["norm_ship_messages"] = ctes("ship_pings") + """
SELECT "timestamp", mmsi, ship_name || '  ' AS ship_name, latitude, longitude, message_type, seq
FROM ship_pings WHERE seq % 11 <> 0 AND seq % 13 <> 0"""

_BOARD = """b AS (
  SELECT d.*, CAST(regexp_extract(station_id, '^be:(.*)$', 1) AS INTEGER) AS endpoint_idx,
         regexp_extract(station_id, '^be:(.*)$', 1) AS endpoint,
         epoch_us("timestamp") // 86400000000 AS cycle_no,
         CAST(regexp_extract(trip_id, '^([0-9]+)-', 1) AS BIGINT) // 256 AS page
  FROM departures d),
bo AS (SELECT * FROM b WHERE (cycle_no + endpoint_idx + page) % 23 <> 0
                         AND (cycle_no + endpoint_idx + page) % 29 <> 7)"""

ORACLE["norm_departures_ch"] = ctes("departures", extra=[_BOARD]) + """
SELECT "timestamp", 'sbb:' || endpoint AS station_id, station_name, CAST(NULL AS VARCHAR) AS trip_id,
       CASE WHEN direction <> 'BUILDING' AND platform_planned = 'O' THEN 'IC ' || substring(line_name, 4, 8)
            WHEN direction <> 'BUILDING' THEN 'IC' ELSE line_name END AS line_name,
       direction, planned_time,
       CASE WHEN ((CAST(floor(delay_seconds / 60) AS BIGINT) % 4) + 4) % 4 IN (0, 1) THEN actual_time END
         AS actual_time,
       CASE WHEN direction <> 'MACHINERY' THEN delay_seconds END AS delay_seconds,
       FALSE AS cancelled, platform_planned, platform_actual, platform_changed
FROM bo WHERE NOT cancelled"""

ORACLE["norm_departures_be"] = ctes("departures", extra=[_BOARD]) + """
SELECT "timestamp", 'be:' || endpoint AS station_id, station_name, trip_id, trip_id AS line_name,
       direction, planned_time, CAST(NULL AS TIMESTAMP) AS actual_time,
       CASE WHEN direction IN ('HOUSEHOLD', 'AUTOMOBILE') THEN NULL ELSE delay_seconds END AS delay_seconds,
       cancelled, platform_planned,
       CASE WHEN platform_actual IS NOT NULL THEN platform_planned END AS platform_actual,
       platform_actual IS NOT NULL AS platform_changed
FROM bo"""

ORACLE["norm_departures_at"] = ctes("departures", extra=[_BOARD]) + """
SELECT "timestamp", 'at:' || endpoint AS station_id, station_name, trip_id, line_name, direction,
       planned_time, actual_time, delay_seconds, FALSE AS cancelled, platform_planned, platform_actual,
       coalesce(platform_planned <> platform_actual, FALSE) AS platform_changed
FROM bo"""

ORACLE["norm_orbital_elements"] = ctes("sat_elements", extra=["""so AS (
  SELECT *, epoch_us("timestamp") // 300000000 AS cycle_no, norad_id // 64 AS page FROM sat_elements)""",
    """sd AS (
  SELECT *, cycle_no + cat_idx + page AS h,
         bool_or(norad_id % 53 = 0) OVER (PARTITION BY category, cycle_no, page) AS bad_doc
  FROM so)"""]) + """
SELECT "timestamp", norad_id, name, CASE WHEN norad_id % 5 = 0 THEN NULL ELSE epoch END AS epoch,
       mean_motion, inclination, eccentricity, tle_line1, tle_line2
FROM sd WHERE h % 23 <> 0 AND h % 29 <> 7 AND NOT bad_doc"""

ORACLE["landed_ok"] = ctes("flights_x", extra=[_AX, _acopies(3, True)]) + f"""
SELECT DISTINCT 'adsb_endpoints' AS source, e.endpoint, make_timestamp(cycle_no * 300000000) AS cycle_ts,
       CAST(endpoint_idx AS BIGINT) * 1000000000 + page AS seq
FROM acp JOIN {_endpoint_names(ADSB_ENDPOINTS)} e USING (endpoint_idx)
WHERE h % 23 <> 0"""

ORACLE["counts_by_endpoint"] = ctes("flights_x", extra=[_AX, _acopies(len(REGION_GRID), True)]) + f"""
SELECT 'airplaneslive' AS source, e.endpoint, count(*) AS "rows"
FROM acp JOIN {_endpoint_names([r[0] for r in REGION_GRID])} e USING (endpoint_idx)
WHERE {_OK} GROUP BY 1, 2"""

_REJECTS = ctes("flights_x", extra=[_AX, _acopies(3, True), f"""rj AS (
  SELECT DISTINCT 'adsb_endpoints' AS source, e.endpoint, make_timestamp(cycle_no * 300000000) AS cycle_ts,
         CAST(endpoint_idx AS BIGINT) * 1000000000 + page AS seq,
         CASE WHEN h % 23 = 0 THEN 500 ELSE 200 END AS status,
         CASE WHEN h % 23 = 0 THEN 'http_status' ELSE 'corrupt' END AS reason
  FROM acp JOIN {_endpoint_names(ADSB_ENDPOINTS)} e USING (endpoint_idx)
  WHERE NOT {_OK}
  UNION ALL
  SELECT DISTINCT 'private_feeder', 'feeder', make_timestamp(cycle_no * 300000000), page,
         CASE WHEN (cycle_no + page) % 23 = 0 THEN 500 ELSE 200 END,
         CASE WHEN (cycle_no + page) % 23 = 0 THEN 'http_status' ELSE 'corrupt' END
  FROM (SELECT *, bool_or(event_id % 37 = 0) OVER (PARTITION BY cycle_no, page) AS bad_doc FROM ax)
  WHERE (cycle_no + page) % 23 = 0 OR (cycle_no + page) % 29 = 7 OR bad_doc)"""])

ORACLE["dead_letter"] = _REJECTS + "SELECT source, endpoint, cycle_ts, seq, status, reason FROM rj"
ORACLE["dropped_counts"] = _REJECTS + 'SELECT source, reason, count(*) AS "rows" FROM rj GROUP BY 1, 2'


# --- scalar rule families -------------------------------------------------------
ORACLE["scl_altitude_ground"] = ctes("flights_x", extra=["""sa AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'ground' WHEN event_id % 19 = 0 THEN 'num_text'
              WHEN event_id % 13 = 0 THEN 'missing' WHEN event_id % 7 = 0 THEN 'other'
              ELSE 'number' END AS kind,
         value * 100.0 AS num,
         CASE WHEN event_id % 3 = 0 THEN CAST(CAST(floor(value * 100.0) AS INTEGER) AS DOUBLE) END AS geom_alt
  FROM flights_x)"""]) + """
SELECT event_id,
       CASE WHEN kind = 'number' THEN num ELSE geom_alt END AS alt_shared,
       CASE WHEN kind = 'ground' THEN TRUE WHEN kind IN ('num_text', 'other') THEN FALSE END AS ground_shared,
       CASE WHEN kind = 'number' THEN num WHEN kind = 'ground' THEN 0.0 ELSE geom_alt END AS alt_private,
       coalesce((CASE WHEN kind = 'number' THEN num WHEN kind = 'ground' THEN 0.0 ELSE geom_alt END) = 0.0,
                FALSE) AS ground_private
FROM sa"""

ORACLE["scl_text"] = ctes("flights_x") + """
SELECT event_id,
       CASE WHEN event_id % 5 = 0 THEN '' ELSE callsign END AS callsign,
       icao24 AS hex,
       CASE WHEN event_id % 4 <> 0 AND event_id % 3 <> 0 THEN 'IR ' || CAST(event_id % 100 AS VARCHAR)
            WHEN event_id % 4 <> 0 THEN 'IR' ELSE callsign END AS line_name,
       'sbb:' || CAST(user_id AS VARCHAR) AS station_id,
       CAST(200000000 + user_id AS VARCHAR) AS mmsi
FROM flights_x"""

ORACLE["scl_time"] = ctes("flights_x", extra=["""st AS (
  SELECT event_id, "timestamp", epoch_us("timestamp") // 1000000 AS secs FROM flights_x)"""]) + """
SELECT event_id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE make_timestamp(secs * 1000000) END AS from_seconds,
       CASE WHEN event_id % 4 IN (0, 1) THEN make_timestamp(secs * 1000000) END AS strict,
       make_timestamp(secs * 1000000) AS lenient,
       CASE WHEN event_id % 5 = 1 THEN TIMESTAMP '1970-01-01 00:00:00'
            WHEN event_id % 5 <> 0 THEN make_timestamp(secs * 1000000)
            WHEN event_id % 3 <> 0 THEN make_timestamp((secs + 1) * 1000000)
            ELSE "timestamp" END AS entity_time,
       secs AS "second", strftime("timestamp", '%Y%m%d') AS day_text,
       date_trunc('minute', "timestamp") AS "minute"
FROM st"""

ORACLE["scl_delay_platform"] = ctes("departures", extra=["""sd AS (
  SELECT *, CAST(trunc(delay_seconds / 60) AS INTEGER) AS mins FROM departures)"""]) + """
SELECT trip_id,
       CASE WHEN mins % 5 = 1 THEN abs(delay_seconds) WHEN mins % 5 IN (0, 2, 3) THEN NULL
            ELSE delay_seconds END AS delay_text_s,
       CASE WHEN mins % 7 = 0 THEN NULL ELSE mins * 60 END AS delay_min_s,
       platform_actual IS NOT NULL AND platform_planned IS DISTINCT FROM platform_actual AS changed_ch,
       platform_actual IS NOT NULL AS changed_be,
       coalesce(platform_planned <> platform_actual, FALSE) AS changed_at,
       cancelled
FROM sd"""

ORACLE["scl_geo"] = ctes("flights_x") + f"""
SELECT event_id, CAST(CAST(latitude AS FLOAT) AS DOUBLE) AS lat_f32,
       CAST(round(latitude * 1e5) AS BIGINT) AS lat_cell, CAST(round(longitude * 1e5) AS BIGINT) AS lon_cell,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN longitude END AS x,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN latitude END AS y,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 4326 END AS srid,
       CAST(floor(latitude / 0.5) AS BIGINT) AS cell_half_deg,
       round({_haversine('latitude', 'longitude', '50.0', '10.0')}, 3) AS km_to_50_10
FROM flights_x"""


# --- writers ---------------------------------------------------------------------
ORACLE["append_flights"] = ctes("flights") + f"""
SELECT {_FCOLS}, ingested_at, geom_lon AS geom_x, geom_lat AS geom_y, CAST("timestamp" AS DATE) AS chunk
FROM flights"""
ORACLE["append_ships"] = ctes("ships") + """
SELECT "timestamp", ingested_at, mmsi, ship_name, latitude, longitude, message_type,
       geom_lon AS geom_x, geom_lat AS geom_y, CAST("timestamp" AS DATE) AS chunk FROM ships"""
ORACLE["append_departures"] = ctes("departures") + """
SELECT *, CAST("timestamp" AS DATE) AS chunk FROM departures"""
ORACLE["append_orbits"] = ctes("satellites") + f"""
SELECT *, {_chunk('satellites')} AS chunk FROM satellites"""
ORACLE["append_vehicles"] = ctes("vehicle_positions") + """
SELECT "timestamp", ingested_at, feed_timestamp, vehicle_id, trip_id, route_id, latitude, longitude,
       bearing, speed, geom_lon AS geom_x, geom_lat AS geom_y, CAST("timestamp" AS DATE) AS chunk
FROM vehicle_positions"""
ORACLE["ingest_metrics"] = ctes("flights") + """
SELECT 'flights' AS "table", count(*) AS "rows" FROM flights GROUP BY source"""
ORACLE["unnest_columns"] = ctes("flights") + """
SELECT make_timestamp((epoch_us("timestamp") // 300000000) * 300000000) AS cycle_ts, icao24, latitude, longitude
FROM flights"""
ORACLE["compact_chunk"] = ctes("flights") + """
SELECT CAST("timestamp" AS DATE) AS chunk, source, count(*) AS "rows" FROM flights GROUP BY 1, 2"""


# --- streams ----------------------------------------------------------------------
_SHIP_STREAM = ctes("ship_pings") + """
SELECT "timestamp", mmsi, ship_name || '  ' AS ship_name, latitude, longitude, message_type FROM (
  SELECT *, row_number() OVER (
      PARTITION BY mmsi, round(latitude * 1e5), round(longitude * 1e5), epoch_us("timestamp") // 1000000
      ORDER BY seq) AS rn
  FROM ship_pings WHERE seq % 11 <> 0 AND seq % 13 <> 0) WHERE rn = 1"""
ORACLE["stream_ships"] = _SHIP_STREAM
ORACLE["stream_ships_once"] = _SHIP_STREAM
ORACLE["stream_snapshots"] = ORACLE["norm_adsb_snapshot"]

ORACLE["stream_rollup"] = ctes("flights") + """
SELECT make_timestamp((epoch_us("timestamp") // 60000000) * 60000000) AS window_start,
       make_timestamp((epoch_us("timestamp") // 60000000 + 1) * 60000000) AS window_end,
       source, count(*) AS "rows"
FROM flights GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max("timestamp") FROM flights) - INTERVAL '10 minutes'"""

ORACLE["stream_latency"] = ctes("flights") + f"""
SELECT window_start, p99_ms, samples, p99_ms > 2000.0 AS alarm FROM (
  SELECT make_timestamp((epoch_us(ingested_at) // 60000000) * 60000000) AS window_start,
         round(quantile_cont({_lat_ms()}, 0.99), 6) AS p99_ms, count(*) AS samples
  FROM flights GROUP BY 1)
WHERE window_start + INTERVAL '1 minute' <= (SELECT max(ingested_at) FROM flights) - INTERVAL '10 minutes'"""

ORACLE["stream_collapse"] = ctes("vehicle_positions") + """
SELECT window_start, window_end, "rows" FROM (
  SELECT make_timestamp(s) AS window_start, make_timestamp(s + 300000000) AS window_end, count(*) AS "rows"
  FROM (SELECT (epoch_us(ingested_at) // 60000000) * 60000000 - j * 60000000 AS s
        FROM vehicle_positions, (VALUES (0), (1), (2), (3), (4)) w(j))
  GROUP BY s)
WHERE "rows" < 1000
  AND window_end <= (SELECT max(ingested_at) FROM vehicle_positions) - INTERVAL '10 minutes'"""

ORACLE["dedup_pings_stream"] = ctes("ship_pings") + """
SELECT DISTINCT mmsi, "timestamp", CAST(round(latitude * 1e5) AS BIGINT) AS lat_cell,
       CAST(round(longitude * 1e5) AS BIGINT) AS lon_cell
FROM ship_pings WHERE seq % 11 <> 0 AND seq % 13 <> 0"""


# --- GTFS-realtime --------------------------------------------------------------------
from movelake.sources.dims import ALERT_CAUSE, ALERT_EFFECT  # noqa: E402

_GT = ctes("ev", extra=["""g AS (
  SELECT *, epoch_us("timestamp") // 1000000 AS secs, epoch_us("timestamp") // 300000000 AS cycle_no,
         event_id // 64 AS page,
         epoch_us("timestamp") // 300000000 + event_id // 64 AS h
  FROM ev)""", """gok AS (SELECT * FROM g WHERE h % 23 <> 0 AND h % 29 <> 7)"""])

ORACLE["norm_vehicle_positions"] = _GT + f"""
SELECT CASE WHEN event_id % 5 = 1 THEN TIMESTAMP '1970-01-01 00:00:00'
            WHEN event_id % 5 <> 0 THEN make_timestamp(secs * 1000000)
            WHEN h % 7 <> 0 THEN make_timestamp((cycle_no * 300 + 300) * 1000000)
            ELSE make_timestamp(cycle_no * 300000000) END AS "timestamp",
       CASE WHEN h % 7 = 0 THEN 0 ELSE cycle_no * 300 + 300 END AS feed_timestamp,
       'v' || CAST(user_id AS VARCHAR) AS vehicle_id, 't' || CAST(event_id % 97 AS VARCHAR) AS trip_id,
       event_type AS route_id,
       CAST(CAST({lat_sql('event_id')} AS FLOAT) AS DOUBLE) AS latitude,
       CAST(CAST({lon_sql('event_id')} AS FLOAT) AS DOUBLE) AS longitude,
       CAST(event_id % 360 AS FLOAT) AS bearing, CAST(value AS FLOAT) AS speed
FROM gok"""

ORACLE["feed_counters"] = _GT + """
SELECT make_timestamp(cycle_no * 300000000) AS cycle_ts, page AS seq,
       count(*) + count(*) FILTER (WHERE event_id % 8 = 0) + count(*) FILTER (WHERE event_id % 6 IN (0, 3))
         AS total_entities,
       count(*) AS vehicle_positions
FROM gok GROUP BY cycle_no, page"""


def _enum_case(col, names, default):
    return ("CASE coalesce(" + col + f", {default}) "
            + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " END")


ORACLE["norm_service_alerts"] = _GT + f"""
SELECT make_timestamp(cycle_no * 300000000) AS "timestamp", 'a' || CAST(event_id AS VARCHAR) AS alert_id,
       'Alert ' || CAST(event_id AS VARCHAR) AS header_text,
       CASE WHEN event_id % 4 <> 0 THEN 'Delay on ' || event_type END AS description_text,
       {_enum_case("CASE WHEN event_id % 12 <> 11 THEN event_id % 12 + 1 END", ALERT_CAUSE, 1)} AS cause,
       {_enum_case("event_id % 9 + 1", ALERT_EFFECT, 8)} AS effect
FROM gok WHERE event_id % 6 = 0"""

ORACLE["norm_trip_updates"] = _GT + """
SELECT make_timestamp(cycle_no * 300000000) AS "timestamp", 'u' || CAST(event_id AS VARCHAR) AS entity_id,
       't' || CAST(event_id % 97 AS VARCHAR) AS trip_id, event_type AS route_id,
       CAST(s.k AS BIGINT) AS stop_sequence, 's' || CAST(event_id % 50 + s.k - 1 AS VARCHAR) AS stop_id,
       CASE WHEN s.k = 1 THEN CAST(floor(value) AS INTEGER) END AS arrival_delay,
       CASE WHEN s.k = 2 THEN CAST(floor(value) AS INTEGER) + 60 END AS departure_delay
FROM gok, (VALUES (1), (2)) s(k) WHERE event_id % 6 = 3"""


ORACLE["archive_catalogue"] = ctes("ev") + """
SELECT feed, "day", CASE WHEN max(dom) % 3 = 0 THEN 2 ELSE 1 END AS fetch FROM (
  SELECT event_type AS feed, CAST("timestamp" AS DATE) AS "day", dayofmonth("timestamp") AS dom FROM ev)
GROUP BY 1, 2"""

_AIRBUS = [i for i, t in enumerate(AIRCRAFT_TYPES) if t.startswith("A")]
ORACLE["filter_type_list"] = ctes("flights_x", extra=[_AX, _acopies(len(AIRCRAFT_TYPES), True)]) + f"""
SELECT e.endpoint, CASE WHEN event_id % 23 <> 0 THEN icao24 END AS icao24,
       make_timestamp(cycle_no * 300000000) AS "timestamp", velocity + k AS velocity
FROM acp JOIN {_endpoint_names(AIRCRAFT_TYPES)} e USING (endpoint_idx)
WHERE {_OK} AND endpoint_idx IN ({", ".join(map(str, _AIRBUS))})"""


ORACLE["vehicles_in_bbox"] = ctes("vehicle_positions") + """
SELECT vehicle_id, "timestamp", latitude, longitude, CAST("timestamp" AS DATE) AS chunk FROM vehicle_positions
WHERE (latitude BETWEEN 35.0 AND 60.0 AND longitude BETWEEN -10.0 AND 30.0)
   OR (latitude BETWEEN -40.0 AND -10.0 AND longitude BETWEEN 100.0 AND 155.0)"""


ORACLE["latency_percentiles_stored"] = ORACLE["latency_percentiles"]

ORACLE["ingest_job"] = ORACLE["norm_adsb_endpoints"]


ORACLE["fleet_rollup"] = ctes(*GEO3) + """
SELECT "table", source, count(*) AS "rows", count(DISTINCT mover) AS movers,
       CAST(grouping("table", source) AS BIGINT) AS level
FROM (SELECT 'flights' AS "table", source, 'flights:' || icao24 AS mover FROM flights
      UNION ALL SELECT 'ships', message_type, 'ships:' || mmsi FROM ships
      UNION ALL SELECT 'vehicle_positions', route_id, 'vehicle_positions:' || vehicle_id FROM vehicle_positions)
GROUP BY ROLLUP ("table", source)"""

ORACLE["stream_stall_gaps"] = ORACLE["stall_gaps"]

ORACLE["stream_adsb_endpoints"] = ORACLE["norm_adsb_endpoints"]

# --- one table for streams, a batch job and compaction ----------------------------
ORACLE["shared_flights_table"] = " UNION ALL ".join(
    f"SELECT {_FCOLS} FROM ({ORACLE[k]})" for k in ("norm_adsb_endpoints", "norm_state_vectors", "append_flights", "norm_adsb_snapshot"))

ORACLE["compaction_life_cycle"] = ctes("flights") + """, c AS (
  SELECT CAST("timestamp" AS DATE) AS chunk, count(*) FILTER (source IS NOT NULL AND source <> 'adsbone') AS early, count(*) FILTER (source = 'adsbone') AS late
  FROM flights GROUP BY 1),
due AS (SELECT *, CAST(chunk AS TIMESTAMP) + INTERVAL '1 day' <= (SELECT max(ingested_at) FROM flights) - INTERVAL '7 days' AS due FROM c)
SELECT 'compacted' AS phase, chunk, CASE WHEN due THEN 'compacted' ELSE 'raw' END AS state, early AS "rows", 0::BIGINT AS misordered FROM due WHERE early > 0
UNION ALL SELECT 'late feed', chunk, CASE WHEN NOT due OR early = 0 THEN 'raw' WHEN late > 0 THEN 'dirty' ELSE 'compacted' END, early + late, 0 FROM due WHERE early + late > 0
UNION ALL SELECT 'again', chunk, CASE WHEN due THEN 'compacted' ELSE 'raw' END, early + late, 0 FROM due WHERE early + late > 0"""

# --- rollups of streams: as the batch would count, the last windows and late rows included
ORACLE["stream_rollup_late"] = ctes("flights") + """
SELECT make_timestamp((epoch_us("timestamp") // 60000000) * 60000000) AS window_start, source, count(*) AS "rows" FROM flights GROUP BY 1, 2"""
ORACLE["stream_collapse_late"] = ctes("vehicle_positions") + """
SELECT make_timestamp(s) AS window_start, make_timestamp(s + 300000000) AS window_end, count(*) AS "rows"
FROM (SELECT (epoch_us(ingested_at) // 60000000) * 60000000 - j * 60000000 AS s FROM vehicle_positions, (VALUES (0), (1), (2), (3), (4)) w(j))
GROUP BY s HAVING count(*) < 3"""
ORACLE["stream_stall_late"] = ORACLE["stall_gaps"]
ORACLE["stream_latency_buckets"] = ctes("flights") + """
SELECT make_timestamp((epoch_us(ingested_at) // 60000000) * 60000000) AS window_start, count(*) AS samples, TRUE AS within_error FROM flights GROUP BY 1"""
ORACLE["stream_vehicle_positions"] = ORACLE["norm_vehicle_positions"]
ORACLE["gtfs_ingest"] = _GT + """, p AS (SELECT cycle_no, page, h, count(*) AS n, count(*) FILTER (WHERE event_id % 8 = 0) + count(*) FILTER (WHERE event_id % 6 IN (0, 3)) AS more FROM g GROUP BY ALL)
SELECT count(*) FILTER (h % 23 <> 0 AND h % 29 <> 7) AS payloads, (coalesce(sum(n + more) FILTER (h % 23 <> 0 AND h % 29 <> 7), 0))::BIGINT AS total_entities,
  (coalesce(sum(n) FILTER (h % 23 <> 0 AND h % 29 <> 7), 0))::BIGINT AS vehicle_positions, (coalesce(sum(n) FILTER (h % 23 <> 0 AND h % 29 <> 7), 0))::BIGINT AS inserted,
  (coalesce(sum(n) FILTER (h % 23 <> 0 AND h % 29 <> 7), 0))::BIGINT AS stored,
  count(*) FILTER (h % 23 <> 0 AND h % 29 = 7) AS corrupt, count(*) FILTER (h % 23 = 0) AS http_status FROM p"""

# --- rejects and dropped records of all twelve feeds --------------------------------
_TS5 = "make_timestamp(cycle_no * 300000000)"
_SEQ = "CAST(endpoint_idx AS BIGINT) * 1000000000 + page"
_LISTS = {"adsb_endpoints": ADSB_ENDPOINTS, "adsb_regions": [r[0] for r in REGION_GRID], "adsb_types": AIRCRAFT_TYPES, "adsb_snapshot": ["global"]}
_PV = "pv AS (SELECT *, cycle_no + page AS h, bool_or(event_id % 37 = 0) OVER (PARTITION BY cycle_no, page) AS bad_doc FROM ax)"
_SD = """so AS (SELECT *, epoch_us("timestamp") // 300000000 AS cycle_no, norad_id // 64 AS page FROM sat_elements),
sd AS (SELECT *, cycle_no + cat_idx + page AS h, bool_or(norad_id % 53 = 0) OVER (PARTITION BY category, cycle_no, page) AS bad_doc FROM so)"""
_NOWHERE = "(latitude IS NULL OR longitude IS NULL)"

# feed -> documents (source, endpoint, cycle_ts, seq, h, bad: reason of a rule or NULL)
_DOCUMENTS = {f: ctes("flights_x", extra=[_AX, _acopies(len(names), f != "adsb_snapshot")]) + f"""
  SELECT DISTINCT '{f}' AS source, e.endpoint, {_TS5} AS cycle_ts, {_SEQ} AS seq, h, NULL AS bad FROM acp JOIN {_endpoint_names(names)} e USING (endpoint_idx)"""
    for f, names in _LISTS.items()}
_DOCUMENTS |= {
    "state_vectors": ctes("flights_x", extra=[_AX]) + f"SELECT DISTINCT 'state_vectors', 'all', {_TS5}, page, cycle_no + page, NULL FROM ax",
    "private_feeder": ctes("flights_x", extra=[_AX, _PV]) + f"SELECT DISTINCT 'private_feeder', 'feeder', {_TS5}, page, h, CASE WHEN bad_doc THEN 'corrupt' END FROM pv",
    "ship_frames": ctes("ship_pings") + """SELECT 'ship_stream', 'stream', "timestamp", seq, 1, CASE WHEN seq % 13 = 0 THEN 'corrupt' END FROM ship_pings""",
    "orbits": ctes("sat_elements", extra=[_SD]) + """SELECT DISTINCT 'orbits', category, "timestamp", CAST(cat_idx AS BIGINT) * 1000000000 + page, h,
      CASE WHEN bad_doc THEN 'missing_required' END FROM sd""",
    "gtfs_rt": _GT + "SELECT DISTINCT 'gtfs_rt', 'vehicle_positions', make_timestamp(cycle_no * 300000000), page, h, NULL FROM g"}
for _f in ("board_ch", "board_be", "board_at"):
    _DOCUMENTS[_f] = ctes("departures", extra=[_BOARD]) + f"""SELECT DISTINCT '{_f}', endpoint, "timestamp", {_SEQ}, cycle_no + endpoint_idx + page, NULL FROM b"""

# feed -> (source, reason) of every record that a rule leaves out of an accepted document
_BOTH = f"CASE WHEN {_NOWHERE} THEN 'no_position' WHEN event_id % 23 = 0 THEN 'no_id' END"
_RECORDS = {f: ctes("flights_x", extra=[_AX, _acopies(len(_LISTS[f]), f != "adsb_snapshot")]) + f"SELECT '{f}' AS source, {rule} AS reason FROM acp WHERE {_OK}"
            for f, rule in (("adsb_endpoints", "CASE WHEN event_id % 23 = 0 THEN 'no_id' END"), ("adsb_regions", _BOTH), ("adsb_types", _BOTH),
                            ("adsb_snapshot", f"CASE WHEN {_NOWHERE} THEN 'no_position' END"))}
_RECORDS |= {
    "state_vectors": ctes("flights_x", extra=[_AX]) + "SELECT 'state_vectors', CASE WHEN event_id % 11 = 0 THEN 'short_record' END FROM ax "
                     "WHERE (cycle_no + page) % 23 <> 0 AND (cycle_no + page) % 29 <> 7",
    "private_feeder": ctes("flights_x", extra=[_AX, _PV]) + f"SELECT 'private_feeder', CASE WHEN event_id % 23 = 0 OR {_NOWHERE} THEN 'missing_required' END FROM pv WHERE {_OK} AND NOT bad_doc",
    "ship_frames": ctes("ship_pings") + "SELECT 'ship_stream', CASE WHEN seq % 11 = 0 THEN 'no_metadata' END FROM ship_pings WHERE seq % 13 <> 0",
    "board_ch": ctes("departures", extra=[_BOARD]) + "SELECT 'board_ch', CASE WHEN cancelled THEN 'no_stop' END FROM bo",
    "gtfs_rt": _GT + "SELECT 'gtfs_rt', 'no_position' FROM gok, (VALUES (0), (1)) x(k) WHERE (k = 0 AND event_id % 8 = 0) OR (k = 1 AND event_id % 6 IN (0, 3))"}

_DOCS12 = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in _DOCUMENTS.values())
_BAD12 = f"""(SELECT *, CASE WHEN h % 23 = 0 THEN 500 ELSE 200 END AS status,
  CASE WHEN h % 23 = 0 THEN 'http_status' WHEN h % 29 = 7 THEN 'corrupt' ELSE bad END AS reason FROM ({_DOCS12}))"""
ORACLE["dead_letter_all"] = f"SELECT source, endpoint, cycle_ts, seq, status, reason FROM {_BAD12} WHERE reason IS NOT NULL"
ORACLE["left_out_counts"] = f"""SELECT source, 'document' AS level, reason, count(*) AS "rows" FROM {_BAD12} WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT source, 'record', reason, count(*) FROM ({" UNION ALL ".join(f"SELECT * FROM ({q})" for q in _RECORDS.values())}) WHERE reason IS NOT NULL GROUP BY ALL"""


# --- station lists, binding limits, defaults, stored order ---------------------------
from movelake.sources.dims import STATIONS, STATION_PREFIX  # noqa: E402


def _listed(feed: str) -> str:
    values = ", ".join(f"({i}, '{e}', '{n}')" for i, (e, n) in enumerate(STATIONS[feed]))
    return f"""SELECT '{feed}' AS feed, '{STATION_PREFIX[feed]}' || l.e AS station_id, l.n AS station_name, count(*) AS departures
FROM ({ORACLE["norm_departures_" + feed]}) d
JOIN (VALUES {values}) l(i, e, n) ON l.i = CAST(split_part(d.station_id, ':', 2) AS INTEGER) % {len(STATIONS[feed])} GROUP BY ALL"""


ORACLE["board_station_lists"] = " UNION ALL ".join(f"SELECT * FROM ({_listed(f)})" for f in STATIONS)

ORACLE["top_departures_by_station"] = ctes("departures") + """
SELECT station_id, trip_id, planned_time, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY planned_time, trip_id) AS "rank" FROM departures)
WHERE "rank" <= 30"""

ORACLE["throughput_collapse_low"] = ORACLE["throughput_collapse"].replace("w < 1000", "w < 3")

ORACLE["latency_percentiles_week"] = ctes(*FIVE) + "\nUNION ALL\n".join(
    _lat_block(t, "7 days", "(SELECT max(ingested_at) FROM flights)") for t in FIVE)

_ALARM = {"opensky": 0.5, "adsblol": 2.0, "airplaneslive": 2.0, "adsbfi": 2.0, "adsbone": 10.0}
ORACLE["latency_alarm_by_source"] = ctes("flights") + "\nUNION ALL\n".join(f"""
SELECT '{s}' AS source, p99_seconds, p99_seconds > {t} AS alarm FROM (
  SELECT round(quantile_cont((epoch_us(ingested_at) - epoch_us("timestamp")) / 1000000.0, 0.99), 6) AS p99_seconds FROM flights
  WHERE source = '{s}' AND ingested_at > (SELECT max(ingested_at) FROM flights WHERE source = '{s}') - INTERVAL '7 days')"""
                                                                          for s, t in _ALARM.items())

ORACLE["mover_track_range"] = ctes("flights") + """
SELECT icao24, count(*) AS points, min("timestamp") AS "first", max("timestamp") AS "last", CAST(0 AS BIGINT) AS misordered FROM flights
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND "timestamp" BETWEEN (SELECT min("timestamp") FROM flights) + INTERVAL '3 days' AND (SELECT max("timestamp") FROM flights) - INTERVAL '5 days'
GROUP BY icao24"""

ORACLE["default_ingested_at"] = ctes("flights") + """
SELECT source, count(*) AS "rows", count(*) FILTER (source = 'adsbone') AS at_write,
       CASE WHEN source = 'adsbone' THEN CAST(1 AS BIGINT) END AS write_times
FROM flights GROUP BY source"""

ORACLE["default_flags"] = ctes("departures") + """
SELECT station_id, coalesce(CASE WHEN platform_actual IS NOT NULL THEN cancelled END, FALSE) AS cancelled,
       FALSE AS platform_changed, count(*) AS "rows"
FROM departures GROUP BY ALL"""

ORACLE["recent_by_mover"] = ctes("flights") + """
SELECT icao24, "timestamp", ingested_at, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY "timestamp" DESC, ingested_at DESC) AS "rank" FROM flights
  WHERE "timestamp" > (SELECT max(ingested_at) FROM flights) - INTERVAL '10 days') WHERE "rank" <= 5"""

ORACLE["retention_alerts"] = f"""
WITH a AS ({ORACLE["norm_service_alerts"]}), v AS ({ORACLE["norm_vehicle_positions"]})
SELECT 'service_alerts' AS "table", CAST("timestamp" AS DATE) AS chunk, count(*) AS "rows" FROM a
WHERE CAST(CAST("timestamp" AS DATE) + 1 AS TIMESTAMP) > (SELECT max("timestamp") FROM a) - INTERVAL '7 days' GROUP BY ALL
UNION ALL SELECT 'vehicle_positions', CAST("timestamp" AS DATE), count(*) FROM v GROUP BY ALL"""

ORACLE["dedup_pings_batches"] = ORACLE["dedup_pings_stream"]
