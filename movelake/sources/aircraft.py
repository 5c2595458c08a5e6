"""Aircraft feeds -> ``flights`` (SRC-1 ... SRC-7).

Every job is one pass: parse the landed body with a fixed schema, explode
the aircraft array (position kept for first-wins order), apply the feed's
field rules as Column expressions, then the feed's filter and de-dup.
``timestamp`` is the collector's clock of the cycle (``cycle_ts``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.functions import rules as R
from movelake.operators.dedup import dedup_aircraft
from movelake.sources import payloads
from movelake.sources.dims import FLIGHT_SOURCES

FLIGHT_COLS = ["timestamp", "icao24", "callsign", "origin_country", "longitude", "latitude",
               "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "source"]

_REC = ("hex string, flight string, lat double, lon double, alt_baro variant, alt_geom double, "
        "gs double, track double, baro_rate double")
ADSB_DOC = f"ac array<struct<{_REC}>>, aircraft array<struct<{_REC}>>"
# The private feeder sends alt_geom as an integer: a fractional value
# rejects the whole payload.
PRIVATE_DOC = ("aircraft array<struct<hex string, flight string, lat double, lon double, "
               "alt_baro variant, alt_geom int, gs double, track double, baro_rate double>>")
STATE_DOC = "states array<array<variant>>"


def both_keys():
    """A document carrying both the key and its alias is a duplicate field
    for a strict deserialiser: the whole document is rejected."""
    return F.col("doc.ac").isNotNull() & F.col("doc.aircraft").isNotNull()


def rejected_adsb(landed: DataFrame) -> DataFrame:
    """Rejected shared-envelope documents (non-2xx, corrupt, key + alias)."""
    return payloads.rejected(landed, ADSB_DOC, (both_keys(), "corrupt"))


def adsb_records(landed: DataFrame, source: str) -> DataFrame:
    """SRC-2: shared aircraft record -> flight row, per (document, position).
    Keeps ``endpoint``, ``seq`` and ``pos`` for first-wins ordering."""
    p = payloads.accepted(payloads.parse(landed, ADSB_DOC)).where(~both_keys())
    arr = F.coalesce(F.col("doc.ac"), F.col("doc.aircraft"))
    x = p.select("endpoint", "cycle_ts", "seq", F.posexplode(arr).alias("pos", "a"))
    a = lambda f: F.col(f"a.{f}")
    return x.select(
        "endpoint", "cycle_ts", "seq", "pos",
        F.col("cycle_ts").alias("timestamp"),
        a("hex").alias("icao24"),
        R.trim_all(a("flight")).alias("callsign"),
        F.lit(None).cast("string").alias("origin_country"),
        a("lon").alias("longitude"), a("lat").alias("latitude"),
        R.altitude_shared(a("alt_baro"), a("alt_geom")).alias("baro_altitude"),
        R.on_ground_shared(a("alt_baro")).alias("on_ground"),
        a("gs").alias("velocity"), a("track").alias("true_track"),
        a("baro_rate").alias("vertical_rate"),
        F.lit(source).alias("source"))


def _has_position(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def norm_adsb_endpoints(landed: DataFrame) -> DataFrame:
    """SRC-3: endpoints in poll order, no position filter, NULL hex dropped,
    first hex per cycle wins."""
    r = adsb_records(landed, FLIGHT_SOURCES["adsb_endpoints"])
    return dedup_aircraft(r, "cycle_ts", ("seq", "pos")).select(*FLIGHT_COLS)


def norm_adsb_regions(landed: DataFrame) -> DataFrame:
    """SRC-4: overlapping regions; rows with a position only; first hex wins."""
    r = _has_position(adsb_records(landed, FLIGHT_SOURCES["adsb_regions"]))
    return dedup_aircraft(r, "cycle_ts", ("seq", "pos")).select(*FLIGHT_COLS)


def norm_adsb_types(landed: DataFrame) -> DataFrame:
    """SRC-5: a hex is claimed only by a record that has a position."""
    r = _has_position(adsb_records(landed, FLIGHT_SOURCES["adsb_types"]))
    return dedup_aircraft(r, "cycle_ts", ("seq", "pos")).select(*FLIGHT_COLS)


def norm_adsb_snapshot(landed: DataFrame) -> DataFrame:
    """SRC-6: global snapshot; position filter only, NULL hex kept, no de-dup."""
    return _has_position(adsb_records(landed, FLIGHT_SOURCES["adsb_snapshot"])).select(*FLIGHT_COLS)


def norm_private_feeder(landed: DataFrame) -> DataFrame:
    """SRC-7: hex, lat and lon required; hex lower-cased; own altitude
    ladder (number, 'ground' -> 0.0, else alt_geom) and ground rule."""
    p = payloads.accepted(payloads.parse(landed, PRIVATE_DOC))
    x = p.select("cycle_ts", F.explode("doc.aircraft").alias("a"))
    x = x.where(F.col("a.hex").isNotNull() & F.col("a.lat").isNotNull() & F.col("a.lon").isNotNull())
    alt = R.altitude_private(F.col("a.alt_baro"), F.col("a.alt_geom"))
    return x.select(
        F.col("cycle_ts").alias("timestamp"),
        F.lower(F.col("a.hex")).alias("icao24"),
        R.trim_all(F.col("a.flight")).alias("callsign"),
        F.lit(None).cast("string").alias("origin_country"),
        F.col("a.lon").alias("longitude"), F.col("a.lat").alias("latitude"),
        alt.alias("baro_altitude"), R.on_ground_private(alt).alias("on_ground"),
        F.col("a.gs").alias("velocity"), F.col("a.track").alias("true_track"),
        F.col("a.baro_rate").alias("vertical_rate"),
        F.lit(FLIGHT_SOURCES["private_feeder"]).alias("source"))


def norm_state_vectors(landed: DataFrame) -> DataFrame:
    """SRC-1: positional arrays; arrays shorter than 17 dropped; each cell
    read with its JSON type (a wrong-typed cell is NULL); no filter, no
    de-dup."""
    p = payloads.accepted(payloads.parse(landed, STATE_DOC))
    x = p.select("cycle_ts", F.explode("doc.states").alias("s")).where(F.size("s") >= 17)
    cell = lambda i: F.get(F.col("s"), i)
    return x.select(
        F.col("cycle_ts").alias("timestamp"),
        R.variant_string(cell(0)).alias("icao24"),
        R.trim_all(R.variant_string(cell(1))).alias("callsign"),
        R.variant_string(cell(2)).alias("origin_country"),
        R.variant_number(cell(5)).alias("longitude"),
        R.variant_number(cell(6)).alias("latitude"),
        R.variant_number(cell(7)).alias("baro_altitude"),
        R.variant_bool(cell(8)).alias("on_ground"),
        R.variant_number(cell(9)).alias("velocity"),
        R.variant_number(cell(10)).alias("true_track"),
        R.variant_number(cell(11)).alias("vertical_rate"),
        F.lit(FLIGHT_SOURCES["state_vectors"]).alias("source"))
