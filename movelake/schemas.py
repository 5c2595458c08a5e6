"""Fixed schemas of the movement tables and of the landed-payload table.

Nothing is inferred: every reader passes one of these. ``geom`` is a
``struct<lon,lat,srid>`` point (Spark's native geometry type cannot be
written to Parquet).
"""

from pyspark.sql import types as T

POINT = T.StructType([
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("srid", T.IntegerType()),
])

_TS = T.TimestampType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


FLIGHTS = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("icao24", T.StringType()), _f("callsign", T.StringType()),
    _f("origin_country", T.StringType()),
    _f("longitude", T.DoubleType()), _f("latitude", T.DoubleType()),
    _f("baro_altitude", T.DoubleType()), _f("on_ground", T.BooleanType()),
    _f("velocity", T.DoubleType()), _f("true_track", T.DoubleType()),
    _f("vertical_rate", T.DoubleType()), _f("geom", POINT),
    _f("source", T.StringType()),
])

SHIPS = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("mmsi", T.StringType()), _f("ship_name", T.StringType()),
    _f("latitude", T.DoubleType()), _f("longitude", T.DoubleType()),
    _f("message_type", T.StringType()), _f("geom", POINT),
])

SATELLITES = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("norad_id", T.IntegerType()), _f("name", T.StringType()),
    _f("epoch", _TS), _f("mean_motion", T.DoubleType()),
    _f("inclination", T.DoubleType()), _f("eccentricity", T.DoubleType()),
    _f("tle_line1", T.StringType()), _f("tle_line2", T.StringType()),
])

DEPARTURES = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("station_id", T.StringType()), _f("station_name", T.StringType()),
    _f("trip_id", T.StringType()), _f("line_name", T.StringType()),
    _f("direction", T.StringType()), _f("planned_time", _TS),
    _f("actual_time", _TS), _f("delay_seconds", T.IntegerType()),
    _f("cancelled", T.BooleanType()), _f("platform_planned", T.StringType()),
    _f("platform_actual", T.StringType()), _f("platform_changed", T.BooleanType()),
])

VEHICLE_POSITIONS = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("feed_timestamp", T.LongType()), _f("vehicle_id", T.StringType()),
    _f("trip_id", T.StringType()), _f("route_id", T.StringType()),
    _f("latitude", T.DoubleType()), _f("longitude", T.DoubleType()),
    _f("bearing", T.FloatType()), _f("speed", T.FloatType()),
    _f("geom", POINT),
])

SERVICE_ALERTS = T.StructType([
    _f("timestamp", _TS, False), _f("ingested_at", _TS, False),
    _f("alert_id", T.StringType()), _f("header_text", T.StringType()),
    _f("description_text", T.StringType()), _f("cause", T.StringType()),
    _f("effect", T.StringType()),
])

# One landed HTTP response / stream frame. ``seq`` is the poll order of the
# endpoint inside its cycle; first-wins de-dup orders by (seq, position).
LANDED = T.StructType([
    _f("source", T.StringType()), _f("endpoint", T.StringType()),
    _f("cycle_ts", _TS), _f("seq", T.LongType()),
    _f("status", T.IntegerType()), _f("body", T.StringType()),
])

# The same with the bytes of a protobuf feed.
LANDED_BINARY = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "body" else f for f in LANDED.fields])

TABLES = {
    "flights": FLIGHTS,
    "ships": SHIPS,
    "satellites": SATELLITES,
    "departures": DEPARTURES,
    "vehicle_positions": VEHICLE_POSITIONS,
    "service_alerts": SERVICE_ALERTS,
}

# Natural key of a mover per table (used by latest-position, tracks, totals).
MOVER_KEY = {
    "flights": "icao24",
    "ships": "mmsi",
    "satellites": "norad_id",
    "departures": "station_id",
    "vehicle_positions": "vehicle_id",
}

# Compression segment column per table (None = no segmentation).
SEGMENT_BY = {
    "flights": "source",
    "ships": "mmsi",
    "satellites": "norad_id",
    "departures": "station_id",
    "vehicle_positions": None,
    "service_alerts": None,
}

# Time-chunk width in days per table.
CHUNK_DAYS = {
    "flights": 1, "ships": 1, "satellites": 7, "departures": 1,
    "vehicle_positions": 1, "service_alerts": 1,
}

# Age in days after which a chunk is compacted.
COMPACT_AFTER_DAYS = {
    "flights": 7, "ships": 7, "satellites": 14, "departures": 7,
    "vehicle_positions": 7, "service_alerts": 7,
}
