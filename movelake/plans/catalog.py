"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the stand-in movement tables (derived from the driver's
parquet tables by Spark, so work grows with them) and applies one library
operator. Timestamp outputs are ``timestamp_ntz`` (UTC wall clock) so the
schema lines up with DuckDB's TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movelake.operators import aggregates as agg
from movelake.operators.filters import latest
from movelake.sources import standin

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark, sf, *names):
    return {n: standin.table(spark, sf, n) for n in names}


def _as_of(*dfs) -> "F.Column":
    """max(ingested_at) over the given tables, as one scalar subquery each."""
    cols = [latest(d) for d in dfs]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


# --- AGG-1 / SET-1 / FLT-6: latency percentiles per table, last 5 minutes ---
@register("latency_percentiles")
def q_latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    t = _t(spark, sf, "flights", "ships")
    return agg.latency_percentiles(t, as_of=_as_of(*t.values()), window="5 minutes")


@register("latency_percentiles_all")
def q_latency_percentiles_all(spark: SparkSession, sf: str) -> DataFrame:
    t = _t(spark, sf, "flights", "ships", "vehicle_positions", "departures", "satellites")
    return agg.latency_percentiles(t, window=None)


FIVE = ("flights", "ships", "vehicle_positions", "departures", "satellites")
GEO3 = ("flights", "ships", "vehicle_positions")


# --- AGG-2 / SRT-1 / FLT-7: p99 per minute over the dashboard range --------
@register("latency_p99_by_minute")
def q_latency_p99_by_minute(spark, sf):
    f = standin.flights(spark, sf)
    return agg.latency_p99_by_minute(f, start=f.agg(F.min("ingested_at")).scalar(), end=latest(f))


# --- AGG-3: p99 alarm over the last 60 s, seconds ---------------------------
@register("latency_alarm")
def q_latency_alarm(spark, sf):
    f = standin.flights(spark, sf)
    return agg.latency_alarm(f, as_of=latest(f), window="60 seconds", threshold_s=2.0)


# --- AGG-5: NULL-safe p99 ----------------------------------------------------
@register("latency_p99_or_zero")
def q_latency_p99_or_zero(spark, sf):
    return agg.latency_p99_or_zero(standin.flights(spark, sf))


# --- AGG-4: row count per table ---------------------------------------------
@register("row_counts")
def q_row_counts(spark, sf):
    return agg.row_counts(_t(spark, sf, *FIVE))


# --- FLT-8: COUNT(*) FILTER (WHERE geom IS NOT NULL) ------------------------
@register("count_filtered")
def q_count_filtered(spark, sf):
    return agg.count_filtered(_t(spark, sf, *GEO3))


# --- AGG-6: freshness per table / source ------------------------------------
@register("freshness")
def q_freshness(spark, sf):
    t = _t(spark, sf, *FIVE)
    return agg.freshness(t, stale_after="10 minutes", group_col={"flights": "source"})


# --- AGG-7 / AGG-8 -----------------------------------------------------------
@register("flights_per_minute")
def q_flights_per_minute(spark, sf):
    return agg.flights_per_minute(standin.flights(spark, sf))


@register("ship_rate_per_hour")
def q_ship_rate_per_hour(spark, sf):
    return agg.ship_rate_per_hour(standin.ships(spark, sf))


# --- AGG-9 / AGG-10: departures delay histogram and trend -------------------
@register("delay_histogram")
def q_delay_histogram(spark, sf):
    return agg.delay_histogram(standin.departures(spark, sf))


@register("delay_trend")
def q_delay_trend(spark, sf):
    d = standin.departures(spark, sf)
    return agg.delay_trend(d, as_of=latest(d, "planned_time"), days=90)


# --- AGG-11: ship density per 1-degree cell over the trailing week ----------
@register("ship_density")
def q_ship_density(spark, sf):
    s = standin.ships(spark, sf)
    return agg.ship_density(s, cell_deg=1.0, as_of=latest(s), window="7 days")


# --- AGG-12 / AGG-13 ---------------------------------------------------------
@register("throughput_report")
def q_throughput_report(spark, sf):
    return agg.throughput_report(_t(spark, sf, *GEO3))


@register("fleet_totals")
def q_fleet_totals(spark, sf):
    return agg.fleet_totals(
        _t(spark, sf, *FIVE),
        source_col={"flights": "source", "ships": "message_type", "vehicle_positions": "route_id"},
        key_col={"flights": "icao24", "ships": "mmsi", "vehicle_positions": "vehicle_id",
                 "departures": "station_id", "satellites": "norad_id"})


# --- FLT-2 / FLT-3 / FLT-6 / FLT-7 / FLT-9 / FLT-12 / PRJ-1 ------------------
from movelake.functions.rules import ntz  # noqa: E402
from movelake.operators import filters as flt  # noqa: E402


def _flight_rows(df):
    return df.select("icao24", ntz("timestamp").alias("timestamp"),
                     ntz("ingested_at").alias("ingested_at"), "latitude", "longitude", "source")


@register("filter_has_position")
def q_filter_has_position(spark, sf):
    return _flight_rows(flt.filter_has_position(standin.flights(spark, sf)))


@register("filter_required_keys")
def q_filter_required_keys(spark, sf):
    return _flight_rows(flt.filter_required_keys(standin.flights(spark, sf),
                                                 "icao24", "latitude", "longitude"))


@register("filter_trailing")
def q_filter_trailing(spark, sf):
    f = standin.flights(spark, sf)
    return _flight_rows(flt.filter_trailing(f, latest(f), "5 minutes"))


@register("filter_time_range")
def q_filter_time_range(spark, sf):
    f = standin.flights(spark, sf)
    end = latest(f)
    return _flight_rows(flt.filter_time_range(f, end - flt.interval("24 hours"), end))


BOXES = [((35.0, -10.0), (60.0, 30.0)), ((-40.0, 100.0), (-10.0, 155.0))]


@register("filter_bbox")
def q_filter_bbox(spark, sf):
    s = flt.filter_bbox(standin.ships(spark, sf), BOXES)
    return s.select("mmsi", ntz("timestamp").alias("timestamp"), "latitude", "longitude")


@register("filter_sources")
def q_filter_sources(spark, sf):
    return _flight_rows(flt.filter_sources(standin.flights(spark, sf), ["opensky", "adsblol"]))


@register("point_lookup")
def q_point_lookup(spark, sf):
    # Equality lookup with X/Y projection (the feature itself is a lookup).
    v = standin.vehicle_positions(spark, sf).where(F.col("vehicle_id") == "v1")
    return v.select("vehicle_id", ntz("timestamp").alias("timestamp"),
                    F.col("geom.lon").alias("x"), F.col("geom.lat").alias("y"))


# --- SET-3: every mover in one relation -------------------------------------
from movelake.operators import quality  # noqa: E402
from movelake.operators.unions import all_positions  # noqa: E402


@register("all_positions")
def q_all_positions(spark, sf):
    return all_positions(_t(spark, sf, *GEO3))


# --- DQ-3: geom NULL iff a coordinate is NULL -------------------------------
@register("geom_consistency")
def q_geom_consistency(spark, sf):
    return quality.geom_consistency(_t(spark, sf, *GEO3))


# --- DED-1 / SRT-2: ship ping de-dup (one-shot: the whole input is one batch)
from movelake.operators import dedup, joins, layout, ledger, sinks, windows  # noqa: E402
from movelake.sources.dims import ORBIT_CATEGORIES  # noqa: E402


@register("dedup_pings")
def q_dedup_pings(spark, sf):
    d = dedup.dedup_pings(standin.ship_pings(spark, sf), order="seq")
    return d.select("mmsi", ntz("timestamp").alias("timestamp"), "latitude", "longitude",
                    "message_type", "ship_name", "seq").orderBy("seq")


def _cycle(ts="timestamp", seconds=300):
    return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts)) / seconds) * seconds)


# --- DED-2: aircraft first-wins per 5-minute cycle ---------------------------
@register("dedup_aircraft")
def q_dedup_aircraft(spark, sf):
    f = standin.flights(spark, sf).withColumn("cycle_ts", _cycle())
    d = dedup.dedup_aircraft(f, cycle_col="cycle_ts", order=("ingested_at", "timestamp"))
    return d.select(ntz("cycle_ts").alias("cycle_ts"), "icao24", ntz("timestamp").alias("timestamp"),
                    "source", "latitude", "longitude")


# --- DED-4: orbit identity (norad_id, epoch), first category wins ----------
@register("dedup_orbits")
def q_dedup_orbits(spark, sf):
    cats = F.create_map(*[x for i, c in enumerate(ORBIT_CATEGORIES) for x in (F.lit(c), F.lit(i))])
    e = standin.satellite_elements(spark, sf).withColumn("category_idx", cats[F.col("category")])
    d = dedup.dedup_orbits(e, order="category_idx")
    return d.select("norad_id", "name", ntz("epoch").alias("epoch"), "category")


# --- WIN-1 / WIN-2 -----------------------------------------------------------
@register("stall_gaps")
def q_stall_gaps(spark, sf):
    return windows.stall_gaps(_t(spark, sf, *GEO3), min_gap_s=120)


@register("throughput_collapse")
def q_throughput_collapse(spark, sf):
    return windows.throughput_collapse(_t(spark, sf, *GEO3), window_s=300, min_rows=1000)


# --- WIN-3 / WIN-4 / WIN-5 ---------------------------------------------------
_MOVER = {"flights": "icao24", "ships": "mmsi", "vehicle_positions": "vehicle_id"}


@register("latest_position")
def q_latest_position(spark, sf):
    return agg.union_all([
        windows.latest_position(df, _MOVER[n]).select(
            F.lit(n).alias("kind"), F.col(_MOVER[n]).alias("id"), "timestamp", "latitude", "longitude")
        for n, df in _t(spark, sf, *GEO3).items()])


@register("mover_track")
def q_mover_track(spark, sf):
    return windows.mover_track(standin.flights(spark, sf), "icao24")


@register("session_summary")
def q_session_summary(spark, sf):
    return windows.session_summary(standin.ship_pings(spark, sf), dedup.ping_key(), "10 minutes")


# --- SRT-4: first 30 departures per station board ---------------------------
@register("top_departures")
def q_top_departures(spark, sf):
    t = windows.top_n_per_group(standin.departures(spark, sf), ["station_id", "timestamp"],
                                ["planned_time", "trip_id"], 30)
    return t.select("station_id", ntz("timestamp").alias("timestamp"), "trip_id",
                    ntz("planned_time").alias("planned_time"), F.col("rank").cast("long").alias("rank"))


# --- JOIN-1 / FLT-10: region coverage by distance join ----------------------
@register("region_coverage")
def q_region_coverage(spark, sf):
    f = standin.flights(spark, sf)
    return joins.region_coverage(spark, f, ["icao24", "timestamp", "latitude", "longitude"], "icao24")


# --- JOIN-2: station id -> station name --------------------------------------
@register("station_names")
def q_station_names(spark, sf):
    counts = (standin.departures(spark, sf).groupBy("station_id")
              .agg(F.count(F.lit(1)).alias("departures")))
    nation = standin.read(spark, sf, "nation")
    stations = nation.select(F.concat(F.lit("be:"), F.col("n_nationkey").cast("string")).alias("station_id"),
                             F.col("n_name").alias("station_name"))
    return joins.attach_station_names(counts, stations).select("station_id", "station_name", "departures")


# --- LAY-1 / LAY-3 / LAY-4 ---------------------------------------------------
@register("chunk_counts")
def q_chunk_counts(spark, sf):
    return layout.chunk_counts(_t(spark, sf, *FIVE))


@register("chunks_to_compact")
def q_chunks_to_compact(spark, sf):
    t = _t(spark, sf, *FIVE)
    return layout.chunks_to_compact(t, {n: latest(d) for n, d in t.items()})


RETENTION_DAYS = {"flights": 7, "ships": 7, "service_alerts": 7, "vehicle_positions": 3, "departures": 30}


@register("retention_keep")
def q_retention_keep(spark, sf):
    t = _t(spark, sf, *FIVE)
    return layout.retention_summary(t, {n: latest(d) for n, d in t.items()}, RETENTION_DAYS)


# --- SNK-10 / JOIN-3: idempotent append of a retried batch ------------------
@register("append_idempotent")
def q_append_idempotent(spark, sf):
    f = layout.with_chunk(standin.flights(spark, sf), "flights")
    m = latest(f)
    target = f.where(F.col("ingested_at") < m - flt.interval("1 day"))
    batch = f.where(F.col("ingested_at") >= m - flt.interval("2 days"))
    out = sinks.append_idempotent(batch, target)
    return out.select("source", "icao24", ntz("timestamp").alias("timestamp"), "chunk")


# --- SRC-1 ... SRC-12, SRC-15, AGG-15, DQ-1, DQ-2: payload normalisation -----
from movelake.session import scratch_path  # noqa: E402
from movelake.sources import aircraft, dims, landed, orbits, payloads, rail, ships  # noqa: E402


def _flights_out(df):
    return df.select(ntz("timestamp").alias("timestamp"), *aircraft.FLIGHT_COLS[1:])


@register("norm_state_vectors")
def q_norm_state_vectors(spark, sf):
    return _flights_out(aircraft.norm_state_vectors(landed.land_state_vectors(spark, sf)))


@register("norm_adsb_records")
def q_norm_adsb_records(spark, sf):
    r = aircraft.adsb_records(landed.land_adsb(spark, sf, "adsb_endpoints"), "adsblol")
    return r.select("endpoint", ntz("timestamp").alias("timestamp"), *aircraft.FLIGHT_COLS[1:])


@register("norm_adsb_endpoints")
def q_norm_adsb_endpoints(spark, sf):
    return _flights_out(aircraft.norm_adsb_endpoints(landed.land_adsb(spark, sf, "adsb_endpoints")))


@register("norm_adsb_regions")
def q_norm_adsb_regions(spark, sf):
    return _flights_out(aircraft.norm_adsb_regions(landed.land_adsb(spark, sf, "adsb_regions")))


@register("norm_adsb_types")
def q_norm_adsb_types(spark, sf):
    return _flights_out(aircraft.norm_adsb_types(landed.land_adsb(spark, sf, "adsb_types")))


@register("norm_adsb_snapshot")
def q_norm_adsb_snapshot(spark, sf):
    return _flights_out(aircraft.norm_adsb_snapshot(landed.land_adsb(spark, sf, "adsb_snapshot")))


@register("norm_private_feeder")
def q_norm_private_feeder(spark, sf):
    return _flights_out(aircraft.norm_private_feeder(landed.land_private(spark, sf)))


@register("norm_ship_messages")
def q_norm_ship_messages(spark, sf):
    s = ships.norm_ship_messages(landed.land_ship_frames(spark, sf))
    return s.select(ntz("timestamp").alias("timestamp"), *ships.SHIP_COLS[1:], "seq")


def _dep_out(df):
    return df.select(ntz("timestamp").alias("timestamp"), "station_id", "station_name", "trip_id",
                     "line_name", "direction", ntz("planned_time").alias("planned_time"),
                     ntz("actual_time").alias("actual_time"), "delay_seconds", "cancelled",
                     "platform_planned", "platform_actual", "platform_changed")


@register("norm_departures_ch")
def q_norm_departures_ch(spark, sf):
    return _dep_out(rail.norm_departures_ch(landed.land_board_ch(spark, sf), landed.station_dim(spark, sf)))


@register("norm_departures_be")
def q_norm_departures_be(spark, sf):
    return _dep_out(rail.norm_departures_be(landed.land_board_be(spark, sf), landed.station_dim(spark, sf)))


@register("norm_departures_at")
def q_norm_departures_at(spark, sf):
    return _dep_out(rail.norm_departures_at(landed.land_board_at(spark, sf), landed.station_dim(spark, sf)))


@register("norm_orbital_elements")
def q_norm_orbital_elements(spark, sf):
    o = orbits.norm_orbital_elements(landed.land_orbits(spark, sf))
    return o.select(ntz("timestamp").alias("timestamp"), "norad_id", "name", ntz("epoch").alias("epoch"),
                    "mean_motion", "inclination", "eccentricity", "tle_line1", "tle_line2")


@register("landed_ok")
def q_landed_ok(spark, sf):
    ok = payloads.landed_ok(landed.land_adsb(spark, sf, "adsb_endpoints"))
    return ok.select("source", "endpoint", ntz("cycle_ts").alias("cycle_ts"), "seq")


@register("counts_by_endpoint")
def q_counts_by_endpoint(spark, sf):
    r = aircraft.adsb_records(landed.land_adsb(spark, sf, "adsb_regions"), "airplaneslive")
    return agg.counts_by_endpoint(r)


def _rejects(spark, sf):
    a = aircraft.rejected_adsb(landed.land_adsb(spark, sf, "adsb_endpoints"))
    p = payloads.rejected(landed.land_private(spark, sf), aircraft.PRIVATE_DOC)
    return a.unionByName(p)


@register("dead_letter")
def q_dead_letter(spark, sf):
    path = scratch_path(spark, "dead_letter")
    payloads.dead_letter(_rejects(spark, sf), path)
    back = spark.read.schema("source string, endpoint string, cycle_ts timestamp, seq long, "
                             "status int, body string, reason string") \
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return back.select("source", "endpoint", ntz("cycle_ts").alias("cycle_ts"), "seq", "status", "reason")


@register("dropped_counts")
def q_dropped_counts(spark, sf):
    return quality.dropped_counts(_rejects(spark, sf))


# --- SCL-*: scalar rule families ---------------------------------------------
from movelake.functions import geo as G  # noqa: E402
from movelake.functions import rules as R  # noqa: E402


def _alt_text(eid, et, value):
    return (F.when(et == "error", F.lit('"ground"'))
             .when(eid % 19 == 0, F.lit('"35000"'))
             .when(eid % 13 == 0, F.lit(None).cast("string"))
             .when(eid % 7 == 0, F.lit('"unknown"'))
             .otherwise((value * F.lit(100.0)).cast("string")))


@register("scl_altitude_ground")
def q_scl_altitude_ground(spark, sf):
    f = standin.flights(spark, sf, with_event_id=True)
    eid, et = F.col("event_id"), F.col("event_type")
    v = F.try_parse_json(_alt_text(eid, et, F.col("value")))
    geom_alt = F.when(eid % 3 == 0, F.floor(F.col("value") * F.lit(100.0)).cast("int"))
    alt_p = R.altitude_private(v, geom_alt)
    return f.select(
        eid.alias("event_id"),
        R.altitude_shared(v, geom_alt).alias("alt_shared"),
        R.on_ground_shared(v).alias("ground_shared"),
        alt_p.alias("alt_private"), R.on_ground_private(alt_p).alias("ground_private"))


@register("scl_text")
def q_scl_text(spark, sf):
    f = standin.flights(spark, sf, with_event_id=True)
    eid, uid = F.col("event_id"), F.col("user_id")
    padded = (F.when(eid % 5 == 0, F.lit(" \t\r\n "))
               .when(eid % 5 == 1, F.concat(F.lit("\t"), F.col("callsign"), F.lit("\n")))
               .otherwise(F.concat(F.lit("  "), F.col("callsign"), F.lit("  "))))
    cat = F.when(eid % 4 != 0, F.lit("IR"))
    num = F.when(eid % 3 != 0, (eid % 100).cast("string"))
    return f.select(
        eid.alias("event_id"),
        R.trim_all(padded).alias("callsign"),
        F.lower(F.upper(F.col("icao24"))).alias("hex"),
        R.line_name(cat, num, F.col("callsign")).alias("line_name"),
        R.station_key("sbb:", uid).alias("station_id"),
        R.id_text(F.lit(200000000) + uid).alias("mmsi"))


@register("scl_time")
def q_scl_time(spark, sf):
    f = standin.flights(spark, sf, with_event_id=True)
    eid = F.col("event_id")
    secs = F.unix_seconds("timestamp")
    wild = F.when(eid % 10 == 0, secs * F.lit(1_000_000)).otherwise(secs)
    fmt = eid % 4
    ts_s = F.timestamp_seconds(secs)
    z = F.date_format(ts_s, "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(fmt == 0, F.concat(z, F.lit("Z")))
             .when(fmt == 1, F.concat(F.date_format(ts_s + F.expr("INTERVAL 90 MINUTES"),
                                                    "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:30")))
             .when(fmt == 2, F.concat(z, F.lit("+0000")))
             .otherwise(z))
    entity = F.when(eid % 5 == 0, F.lit(None).cast("long")).when(eid % 5 == 1, F.lit(0)).otherwise(secs)
    feed = F.when(eid % 3 == 0, F.lit(0)).otherwise(secs + 1)
    return f.select(
        eid.alias("event_id"),
        ntz(R.seconds_to_ts(wild)).alias("from_seconds"),
        ntz(R.rfc3339_to_ts(text)).alias("strict"),
        ntz(R.rfc3339_to_ts(text, lenient=True)).alias("lenient"),
        ntz(R.entity_time(entity, feed, F.col("timestamp"))).alias("entity_time"),
        R.whole_second("timestamp").alias("second"),
        R.utc_day_text("timestamp").alias("day_text"),
        ntz(F.date_trunc("minute", "timestamp")).alias("minute"))


@register("scl_delay_platform")
def q_scl_delay_platform(spark, sf):
    d = standin.departures(spark, sf)
    k = F.col("delay_seconds")
    mins = (k / 60).cast("int")
    text = (F.when(mins % 5 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
             .when(mins % 5 == 1, F.concat(F.lit("+"), F.abs(k).cast("string")))
             .when(mins % 5 == 2, F.lit("99999999999"))
             .when(mins % 5 == 3, F.concat(k.cast("string"), F.lit("s")))
             .otherwise(k.cast("string")))
    big = F.when(mins % 7 == 0, F.lit(40000000)).otherwise(mins)
    normal = F.when(F.col("platform_actual").isNull(), F.lit("1")).otherwise(F.lit("0"))
    canceled = F.when(F.col("cancelled"), F.lit("1")).when(mins % 2 == 0, F.lit("0"))
    return d.select(
        "trip_id",
        R.int_text(text).alias("delay_text_s"),
        R.minutes_to_seconds(big).alias("delay_min_s"),
        R.platform_changed_ch(F.col("platform_planned"), F.col("platform_actual")).alias("changed_ch"),
        R.platform_changed_be(normal).alias("changed_be"),
        R.platform_changed_at(F.col("platform_planned"), F.col("platform_actual")).alias("changed_at"),
        R.cancelled_flag(canceled).alias("cancelled"))


@register("scl_geo")
def q_scl_geo(spark, sf):
    f = standin.flights(spark, sf, with_event_id=True)
    p = R.make_point(F.col("longitude"), F.col("latitude"))
    return f.select(
        F.col("event_id"),
        R.widen_float(F.col("latitude")).alias("lat_f32"),
        R.coord_cell(F.col("latitude")).alias("lat_cell"),
        R.coord_cell(F.col("longitude")).alias("lon_cell"),
        p["lon"].alias("x"), p["lat"].alias("y"), p["srid"].alias("srid"),
        G.grid_cell(F.col("latitude"), 0.5).alias("cell_half_deg"),
        F.round(G.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(50.0), F.lit(10.0)), 3)
         .alias("km_to_50_10"))


# --- SNK-1 ... SNK-9, LAY-2: writers, read back through the fixed schema ------
def _write_read(spark, df, table):
    path = scratch_path(spark, table)
    sinks.append(df, path, table)
    return sinks.read_table(spark, path, table)


def _geom_xy(df):
    return [F.col("geom.lon").alias("geom_x"), F.col("geom.lat").alias("geom_y")]


@register("append_flights")
def q_append_flights(spark, sf):
    r = _write_read(spark, standin.flights(spark, sf), "flights")
    return r.select(ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"),
                    *aircraft.FLIGHT_COLS[1:], *_geom_xy(r), "chunk")


@register("append_ships")
def q_append_ships(spark, sf):
    r = _write_read(spark, standin.ships(spark, sf), "ships")
    return r.select(ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"),
                    "mmsi", "ship_name", "latitude", "longitude", "message_type", *_geom_xy(r), "chunk")


@register("append_departures")
def q_append_departures(spark, sf):
    r = _write_read(spark, standin.departures(spark, sf), "departures")
    return r.select(
        ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"), "station_id",
        "station_name", "trip_id", "line_name", "direction", ntz("planned_time").alias("planned_time"),
        ntz("actual_time").alias("actual_time"), "delay_seconds", "cancelled", "platform_planned",
        "platform_actual", "platform_changed", "chunk")


@register("append_orbits")
def q_append_orbits(spark, sf):
    r = _write_read(spark, standin.satellites(spark, sf), "satellites")
    return r.select(ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"),
                    "norad_id", "name", ntz("epoch").alias("epoch"), "mean_motion", "inclination",
                    "eccentricity", "tle_line1", "tle_line2", "chunk")


@register("append_vehicles")
def q_append_vehicles(spark, sf):
    r = _write_read(spark, standin.vehicle_positions(spark, sf), "vehicle_positions")
    return r.select(ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"),
                    "feed_timestamp", "vehicle_id", "trip_id", "route_id", "latitude", "longitude",
                    "bearing", "speed", *_geom_xy(r), "chunk")


@register("ingest_metrics")
def q_ingest_metrics(spark, sf):
    """One batch per feed source (the fixed feed list), each append
    recording (table, rows) in ingest_metrics."""
    from movelake.sources.standin import EVENT_SOURCE
    f = standin.flights(spark, sf)
    data, metrics = scratch_path(spark, "flights"), scratch_path(spark, "ingest_metrics")
    for src in EVENT_SOURCE.values():
        sinks.append(f.where(F.col("source") == src), data, "flights", metrics_path=metrics)
    return spark.read.parquet(metrics).select("table", "rows")


@register("unnest_columns")
def q_unnest_columns(spark, sf):
    """Column-array documents (one per 5-minute cycle and page) zipped back
    to rows."""
    f = standin.flights(spark, sf, with_event_id=True).withColumn("cycle_ts", _cycle())
    f = f.withColumn("page", F.floor(F.col("event_id") / 64))
    g = (f.groupBy("cycle_ts", "page")
          .agg(F.array_sort(F.collect_list(F.struct("event_id", "icao24", "latitude", "longitude")))
               .alias("r")))
    cols = g.select("cycle_ts",
                    F.transform("r", lambda x: x["icao24"]).alias("hex"),
                    F.transform("r", lambda x: x["latitude"]).alias("lat"),
                    F.transform("r", lambda x: x["longitude"]).alias("lon"))
    rows = sinks.unnest_columns(cols, ["hex", "lat", "lon"], ["icao24", "latitude", "longitude"])
    return rows.select(ntz("cycle_ts").alias("cycle_ts"), "icao24", "latitude", "longitude")


@register("compact_chunk")
def q_compact_chunk(spark, sf):
    """LAY-2: rewrite the chunks due for compaction, segmented by source and
    sorted newest first; rows per (chunk, source) must be unchanged."""
    f = standin.flights(spark, sf)
    due = layout.retention_filter(f, "flights", latest(f), None)
    c = layout.compact(due, "flights")
    path = scratch_path(spark, "flights_compacted")
    c.write.mode("overwrite").partitionBy("chunk").option("compression", "zstd").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("chunk", "source").agg(F.count(F.lit(1)).alias("rows"))


# --- STR-1 ... STR-6, DED-5: streams run to completion over landed files ----
from movelake.streaming import streams  # noqa: E402


def _land_files(df, name, n_files, order_expr, fmt="json"):
    path = scratch_path(df.sparkSession, name)
    w = (df.repartitionByRange(n_files, order_expr).write.mode("overwrite")
           .option("timestampFormat", streams.TS_FORMAT))
    getattr(w, fmt)(path)
    return path


def _ship_landing(spark, sf):
    frames = landed.land_ship_frames(spark, sf)
    # copies of one ping (seq = 3 * event + k) always land in the same file
    return _land_files(frames, "landing_ships", 6, F.floor(F.col("seq") / 3))


def _ships_out(df):
    return df.select(ntz("timestamp").alias("timestamp"), "mmsi", "ship_name", "latitude", "longitude",
                     "message_type")


@register("stream_ships")
def q_stream_ships(spark, sf):
    land = _ship_landing(spark, sf)
    out, ck = scratch_path(spark, "ships"), scratch_path(spark, "ck_ships")
    streams.stream_ships(spark, land, out, ck, trigger="availableNow", max_files=1).awaitTermination()
    return _ships_out(sinks.read_table(spark, out, "ships"))


@register("stream_ships_once")
def q_stream_ships_once(spark, sf):
    land = _ship_landing(spark, sf)
    out, ck = scratch_path(spark, "ships"), scratch_path(spark, "ck_ships")
    streams.stream_ships(spark, land, out, ck, trigger=None, max_files=None).awaitTermination()
    return _ships_out(sinks.read_table(spark, out, "ships"))


@register("stream_snapshots")
def q_stream_snapshots(spark, sf):
    land = _land_files(landed.land_adsb(spark, sf, "adsb_snapshot"), "landing_snap", 6, "cycle_ts")
    out, ck = scratch_path(spark, "flights"), scratch_path(spark, "ck_snap")
    streams.stream_snapshots(spark, land, aircraft.norm_adsb_snapshot, "flights", out, ck,
                             trigger="availableNow", max_files=2).awaitTermination()
    return _flights_out(sinks.read_table(spark, out, "flights"))


def _table_stream(spark, sf, name, n_files=4):
    df = standin.table(spark, sf, name)
    path = _land_files(df.drop("geom"), f"landing_{name}", n_files, "timestamp", fmt="parquet")
    return spark.readStream.schema(df.drop("geom").schema).parquet(path)


def _run(spark, df, name, mode="append"):
    out, ck = scratch_path(spark, name), scratch_path(spark, f"ck_{name}")
    streams.run_to_parquet(df, out, ck, trigger="availableNow", mode=mode).awaitTermination()
    return spark.read.parquet(out)


@register("stream_rollup")
def q_stream_rollup(spark, sf):
    r = _run(spark, streams.rollup_counts(_table_stream(spark, sf, "flights")), "rollup")
    return r.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
                    "source", "rows")


@register("stream_latency")
def q_stream_latency(spark, sf):
    r = _run(spark, streams.latency_windows(_table_stream(spark, sf, "flights")), "latency")
    return r.select(ntz("window_start").alias("window_start"), "p99_ms", "samples", "alarm")


@register("stream_collapse")
def q_stream_collapse(spark, sf):
    r = _run(spark, streams.collapse_windows(_table_stream(spark, sf, "vehicle_positions")), "collapse")
    return r.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), "rows")


@register("dedup_pings_stream")
def q_dedup_pings_stream(spark, sf):
    land = _ship_landing(spark, sf)
    # one bounded batch: rows behind the watermark would otherwise be dropped
    # as late, depending on the order the file source picks files up
    r = _run(spark, streams.dedup_stream(spark, land, max_files=None), "dedup_stream")
    return r.select("mmsi", ntz("timestamp").alias("timestamp"),
                    R.coord_cell(F.col("latitude")).alias("lat_cell"),
                    R.coord_cell(F.col("longitude")).alias("lon_cell"))


# --- SRC-13, AGG-14, EXT-1, EXT-2: GTFS-realtime -----------------------------
from movelake.sources import gtfs  # noqa: E402


@register("norm_vehicle_positions")
def q_norm_vehicle_positions(spark, sf):
    v = gtfs.norm_vehicle_positions(landed.land_gtfs(spark, sf))
    return v.select(ntz("timestamp").alias("timestamp"), *gtfs.VP_COLS[1:])


@register("feed_counters")
def q_feed_counters(spark, sf):
    c = gtfs.feed_counters(landed.land_gtfs(spark, sf))
    return c.select(ntz("cycle_ts").alias("cycle_ts"), "seq", "total_entities", "vehicle_positions")


@register("norm_service_alerts")
def q_norm_service_alerts(spark, sf):
    a = gtfs.norm_service_alerts(landed.land_gtfs(spark, sf))
    return a.select(ntz("timestamp").alias("timestamp"), "alert_id", "header_text", "description_text",
                    "cause", "effect")


@register("norm_trip_updates")
def q_norm_trip_updates(spark, sf):
    t = gtfs.norm_trip_updates(landed.land_gtfs(spark, sf))
    return t.select(ntz("timestamp").alias("timestamp"), "entity_id", "trip_id", "route_id", "stop_sequence",
                    "stop_id", "arrival_delay", "departure_delay")


# --- SRC-14 / DED-3: archive catalogue ------------------------------------------
from movelake.sources import archives  # noqa: E402


@register("archive_catalogue")
def q_archive_catalogue(spark, sf):
    """Two fetch rounds of per-(feed, day) archives derived from events;
    days whose day-of-month is a multiple of 3 are fetched again later and
    must win."""
    e = standin._events(spark, sf).select(
        F.col("event_type").alias("feed"), F.date_format("timestamp", "yyyyMMdd").alias("day"),
        F.col("event_id").cast("string").alias("value"), "timestamp")
    base = scratch_path(spark, "archives")
    e.drop("timestamp").write.partitionBy("feed", "day").option("compression", "gzip").text(f"{base}/fetch=1")
    again = e.where(F.dayofmonth("timestamp") % 3 == 0).drop("timestamp")
    again.write.partitionBy("feed", "day").option("compression", "gzip").text(f"{base}/fetch=2")
    pattern = r"fetch=([0-9]+)/feed=([^/]+)/day=([0-9]{8})/"
    cat = archives.archive_catalogue(spark, base, pattern=r"feed=([^/]+)/day=([0-9]{8})/", glob="*.gz")
    return cat.select("feed", "day", F.regexp_extract("path", pattern, 1).cast("int").alias("fetch"))


# --- FLT-11: aircraft-type selection ---------------------------------------------
from movelake.sources.dims import AIRCRAFT_TYPES  # noqa: E402

AIRBUS_TYPES = [t for t in AIRCRAFT_TYPES if t.startswith("A")]


@register("filter_type_list")
def q_filter_type_list(spark, sf):
    r = aircraft.adsb_records(landed.land_adsb(spark, sf, "adsb_types"), "adsbone")
    return flt.filter_sources(r, AIRBUS_TYPES, col="endpoint").select(
        "endpoint", "icao24", ntz("timestamp").alias("timestamp"), "velocity")


# --- LAY-6 / FLT-9: bounding-box lookup on the cell-clustered vehicle table ----
@register("vehicles_in_bbox")
def q_vehicles_in_bbox(spark, sf):
    r = _write_read(spark, standin.vehicle_positions(spark, sf), "vehicle_positions")
    v = flt.filter_bbox(r, BOXES)
    return v.select("vehicle_id", ntz("timestamp").alias("timestamp"), "latitude", "longitude", "chunk")


# --- AGG-1 on stored tables: trailing window with chunk (partition) pruning ----
@register("latency_percentiles_stored")
def q_latency_percentiles_stored(spark, sf):
    t = {n: _write_read(spark, standin.table(spark, sf, n), n) for n in ("flights", "ships")}
    return agg.latency_percentiles(t, as_of=_as_of(*t.values()), window="5 minutes")


# --- one-shot ingest job: landed -> table, dead letter, metrics ----------------
from movelake import jobs  # noqa: E402


@register("ingest_job")
def q_ingest_job(spark, sf):
    table = scratch_path(spark, "flights")
    jobs.ingest(spark, "adsb_endpoints", landed.land_adsb(spark, sf, "adsb_endpoints"), table,
                dead_letter_path=scratch_path(spark, "dead_letter"),
                metrics_path=scratch_path(spark, "ingest_metrics"))
    return _flights_out(sinks.read_table(spark, table, "flights"))


# --- AGG-13 with ROLLUP subtotals -------------------------------------------------
@register("fleet_rollup")
def q_fleet_rollup(spark, sf):
    r = agg.fleet_rollup(
        _t(spark, sf, *GEO3),
        source_col={"flights": "source", "ships": "message_type", "vehicle_positions": "route_id"},
        key_col={"flights": "icao24", "ships": "mmsi", "vehicle_positions": "vehicle_id"})
    return r.withColumn("level", F.col("level").cast("long"))


# --- WIN-1 on a stream: stateful stall watchdog (gap rows vs the batch oracle) --
@register("stream_stall_gaps")
def q_stream_stall_gaps(spark, sf):
    inserts = agg.union_all([standin.table(spark, sf, n).select(F.lit(n).alias("table"), "ingested_at")
                             for n in GEO3])
    land = _land_files(inserts, "landing_inserts", 4, "ingested_at", fmt="parquet")
    src = spark.readStream.schema("table string, ingested_at timestamp").parquet(land)
    r = _run(spark, streams.stall_watch(src, gap_s=120), "stall_watch")
    return r.where(F.col("kind") == "gap").select(
        "table", ntz("gap_start").alias("gap_start"), ntz("gap_end").alias("gap_end"), "gap_seconds")


# --- STR-3 for a first-wins feed: the three-endpoint aircraft feed as a stream --
@register("stream_adsb_endpoints")
def q_stream_adsb_endpoints(spark, sf):
    # a cycle's documents land in one file, as one fetch of all endpoints would
    land = _land_files(landed.land_adsb(spark, sf, "adsb_endpoints"), "landing_adsb", 6, "cycle_ts")
    out, ck = scratch_path(spark, "flights"), scratch_path(spark, "ck_adsb")
    streams.stream_feed(spark, land, "adsb_endpoints", out, ck, trigger="availableNow",
                        max_files=2).awaitTermination()
    return _flights_out(sinks.read_table(spark, out, "flights"))


# --- STR-1/2/3 with SNK-1, LAY-2/3: one table for streams, a batch job and compaction
def _iso(ts) -> str:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


@register("shared_flights_table")
def q_shared_flights_table(spark, sf):
    """Three feeds' streams, a batch job that is run twice, a compaction, and a
    stream that is restarted after it, all on one table."""
    table, f = scratch_path(spark, "flights"), standin.flights(spark, sf)

    def stream(feed, land, checkpoint):
        streams.stream_feed(spark, land, feed, table, checkpoint, trigger="availableNow", max_files=2).awaitTermination()

    stream("adsb_endpoints", _land_files(landed.land_adsb(spark, sf, "adsb_endpoints"), "landing_adsb", 6, "cycle_ts"), scratch_path(spark, "ck_a"))
    land, checkpoint = scratch_path(spark, "landing_sv"), scratch_path(spark, "ck_sv")
    documents = landed.land_state_vectors(spark, sf)
    for part in (0, 1):
        documents.where(F.pmod(F.xxhash64("cycle_ts"), F.lit(2)) == part).write.option("timestampFormat", streams.TS_FORMAT).json(f"{land}/{part}")
        stream("state_vectors", f"{land}/*", checkpoint)
        if part == 0:
            for _ in range(2):  # the second run finds the batch in the ledger
                sinks.append(f, table, "flights", writer="backfill", batch="2024")
            layout.compact_chunks(spark, table, "flights", f.agg(_iso(F.max("ingested_at"))).first()[0])
    stream("adsb_snapshot", _land_files(landed.land_adsb(spark, sf, "adsb_snapshot"), "landing_snap", 6, "cycle_ts"), scratch_path(spark, "ck_snap"))
    return _flights_out(sinks.read_table(spark, table, "flights"))


@register("compaction_life_cycle")
def q_compaction_life_cycle(spark, sf):
    """LAY-2/3: state and rows of every chunk, and rows of compacted files that
    are not in file order, after a compaction, after a late feed, and after
    compacting again."""
    table, f = scratch_path(spark, "flights"), standin.flights(spark, sf)
    as_of = f.agg(_iso(F.max("ingested_at"))).first()[0]
    phases = []

    def note(phase):
        from pyspark.sql import Window
        rows = sinks.read_table(spark, table, "flights").select("chunk", "source", "timestamp", "_metadata.file_name", "_metadata.row_index")
        before = Window.partitionBy("chunk", "file_name").orderBy("row_index")
        wrong = ((F.lag("source").over(before) > F.col("source"))
                 | ((F.lag("source").over(before) == F.col("source")) & (F.lag("timestamp").over(before) < F.col("timestamp"))))
        rows = rows.select("chunk", (F.coalesce(wrong, F.lit(False)) & F.col("file_name").startswith(ledger.COMPACTED)).alias("wrong"))
        rows = rows.groupBy("chunk").agg(F.count("*").alias("rows"), F.count_if("wrong").alias("misordered"))
        out = scratch_path(spark, f"phase_{phase}")
        (layout.catalogue(spark, table).join(rows, "chunk").select(F.lit(phase).alias("phase"), "chunk", "state", "rows", "misordered").write.parquet(out))
        phases.append(spark.read.parquet(out))

    sinks.append(f.where("source != 'adsbone'"), table, "flights")
    layout.compact_chunks(spark, table, "flights", as_of)
    note("compacted")
    sinks.append(f.where("source = 'adsbone'"), table, "flights")
    note("late feed")
    layout.compact_chunks(spark, table, "flights", as_of)
    note("again")
    return agg.union_all(phases)


# --- STR-4 ... STR-6, WIN-1: rollups of streams whose rows come in no order -----
from movelake.streaming import rollups  # noqa: E402


def _rolled(spark, df, name, keys, window="1 minute", ts="timestamp"):
    """df as four micro-batches, each with rows of the whole time, into a rollup."""
    land, out = scratch_path(spark, f"landing_{name}"), scratch_path(spark, name)
    df.repartition(4, F.xxhash64(*df.columns)).write.parquet(land)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(land)
    names = [k.split()[0] for k in keys.split(", ")]
    rollups.stream_rollup(src, out, scratch_path(spark, f"ck_{name}"), names, window, ts, "availableNow").awaitTermination()
    return out


@register("stream_rollup_late")
def q_stream_rollup_late(spark, sf):
    out = _rolled(spark, standin.flights(spark, sf).select("timestamp", "source"), "rollup", "source string")
    rollups.compact_rollup(spark, out, "source string")
    return rollups.read_rollup(spark, out, "source string").select(ntz("window_start").alias("window_start"), "source", "rows")


@register("stream_collapse_late")
def q_stream_collapse_late(spark, sf):
    rows = standin.vehicle_positions(spark, sf).select("ingested_at", F.lit("vehicle_positions").alias("table"))
    out = _rolled(spark, rows, "collapse", "table string", ts="ingested_at")
    c = rollups.collapsed(rollups.read_rollup(spark, out, "table string"), min_rows=3)
    return c.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), "rows")


@register("stream_stall_late")
def q_stream_stall_late(spark, sf):
    inserts = agg.union_all([standin.table(spark, sf, n).select("ingested_at", F.lit(n).alias("table")) for n in GEO3])
    out = _rolled(spark, inserts, "seconds", "table string", "1 second", "ingested_at")
    g = rollups.gaps(rollups.read_rollup(spark, out, "table string"), 120)
    return g.select("table", ntz("gap_start").alias("gap_start"), ntz("gap_end").alias("gap_end"), "gap_seconds")


@register("stream_latency_buckets")
def q_stream_latency_buckets(spark, sf):
    """p99 per minute from bucket counts, beside the exact one: the stated error holds."""
    f = standin.flights(spark, sf).select("ingested_at", "timestamp")
    rows = f.select("ingested_at", rollups.latency_bucket().alias("bucket"))
    p = rollups.latency_percentile(rollups.read_rollup(spark, _rolled(spark, rows, "latency", "bucket int", ts="ingested_at"), "bucket int"))
    exact = f.groupBy(F.date_trunc("minute", "ingested_at").alias("window_start")).agg(F.percentile(R.latency_ms("ingested_at", "timestamp"), F.lit(0.99)).alias("exact"))
    near = F.abs(F.col("p_ms") - F.col("exact")) <= F.abs("exact") * (2.718281828 ** (0.5 / rollups.STEPS) - 1) + 1e-9
    return p.join(exact, "window_start", "full").select(ntz("window_start").alias("window_start"), "samples", near.alias("within_error"))


# --- STR-3 for the protobuf feed -------------------------------------------------
@register("stream_vehicle_positions")
def q_stream_vehicle_positions(spark, sf):
    land = _land_files(landed.land_gtfs(spark, sf), "landing_gtfs", 6, "cycle_ts", fmt="parquet")
    out, ck = scratch_path(spark, "vehicle_positions"), scratch_path(spark, "ck_gtfs")
    streams.stream_feed(spark, land, "gtfs_rt", out, ck, trigger="availableNow", max_files=2).awaitTermination()
    return sinks.read_table(spark, out, "vehicle_positions").select(ntz("timestamp").alias("timestamp"), *gtfs.VP_COLS[1:])


@register("gtfs_ingest")
def q_gtfs_ingest(spark, sf):
    """AGG-14 and DQ-1 of one run: payloads decoded once for table, counters and dead letter."""
    table, dead = scratch_path(spark, "vehicle_positions"), scratch_path(spark, "dead_letter")
    got = jobs.ingest(spark, "gtfs_rt", landed.land_gtfs(spark, sf), table, dead_letter_path=dead)
    stored = sinks.read_table(spark, table, "vehicle_positions").agg(F.count("*").alias("stored"))
    letters = payloads.read_dead_letter(spark, dead).agg(F.count_if(F.col("reason") == "corrupt").alias("corrupt"), F.count_if(F.col("reason") == "http_status").alias("http_status"))
    c = got["counters"]
    return letters.select(*[F.lit(c[k]).cast("long").alias(k) for k in ("payloads", "total_entities", "vehicle_positions", "inserted")],
                          stored.scalar().alias("stored"), "corrupt", "http_status")


# --- DQ-1 / DQ-2 over all twelve feeds -------------------------------------------
LANDINGS = {
    "state_vectors": landed.land_state_vectors, "private_feeder": landed.land_private, "ship_frames": landed.land_ship_frames,
    "board_ch": landed.land_board_ch, "board_be": landed.land_board_be, "board_at": landed.land_board_at,
    "orbits": landed.land_orbits, "gtfs_rt": landed.land_gtfs,
    **{f: (lambda spark, sf, f=f: landed.land_adsb(spark, sf, f)) for f in landed.FEEDS},
}


@register("dead_letter_all")
def q_dead_letter_all(spark, sf):
    path = scratch_path(spark, "dead_letter")
    # one write for the fixed list of feeds, so that those over the same rows share their shuffle
    payloads.dead_letter(agg.union_all([jobs.FEEDS[feed][2](land(spark, sf)) for feed, land in LANDINGS.items()]), path)
    return payloads.read_dead_letter(spark, path).select("source", "endpoint", ntz("cycle_ts").alias("cycle_ts"), "seq", "status", "reason")


@register("left_out_counts")
def q_left_out_counts(spark, sf):
    return agg.union_all([jobs.left_out(feed, land(spark, sf)) for feed, land in LANDINGS.items()])


# --- JOIN-2 with the feeds' own station lists --------------------------------------
@register("board_station_lists")
def q_board_station_lists(spark, sf):
    """Every board document served under a station of the feed's list."""
    boards = {"ch": (landed.land_board_ch, rail.norm_departures_ch), "be": (landed.land_board_be, rail.norm_departures_be),
              "at": (landed.land_board_at, rail.norm_departures_at)}
    out = []
    for feed, (land, normalise) in boards.items():
        ids = [e for e, _ in dims.STATIONS[feed]]
        listed = F.get(F.array(*map(F.lit, ids)), F.col("endpoint").cast("int") % len(ids))
        rows = normalise(land(spark, sf).withColumn("endpoint", listed), dims.stations(spark, feed))
        out.append(rows.groupBy("station_id", "station_name").agg(F.count("*").alias("departures")).select(F.lit(feed).alias("feed"), "station_id", "station_name", "departures"))
    return agg.union_all(out)


# --- SRT-4, WIN-2, AGG-1, AGG-3 with limits that bind ------------------------------
@register("top_departures_by_station")
def q_top_departures_by_station(spark, sf):
    t = windows.top_n_per_group(standin.departures(spark, sf), ["station_id"], ["planned_time", "trip_id"], 30)
    return t.select("station_id", "trip_id", ntz("planned_time").alias("planned_time"), F.col("rank").cast("long").alias("rank"))


@register("throughput_collapse_low")
def q_throughput_collapse_low(spark, sf):
    return windows.throughput_collapse(_t(spark, sf, *GEO3), window_s=300, min_rows=3)


@register("latency_percentiles_week")
def q_latency_percentiles_week(spark, sf):
    t = _t(spark, sf, *FIVE)
    return agg.latency_percentiles(t, as_of=_as_of(t["flights"]), window="7 days")


@register("latency_alarm_by_source")
def q_latency_alarm_by_source(spark, sf):
    """The alarm of every feed over its trailing week, and of one that is quiet."""
    f = standin.flights(spark, sf)
    out = []
    for source, threshold in ALARM_SECONDS.items():
        d = f.where(F.col("source") == source)
        out.append(agg.latency_alarm(d, latest(d), "7 days", threshold).select(F.lit(source).alias("source"), "p99_seconds", "alarm"))
    return agg.union_all(out)


# thresholds in seconds, on both sides of the stand-in's p99 of some 2.2 s
ALARM_SECONDS = {"opensky": 0.5, "adsblol": 2.0, "airplaneslive": 2.0, "adsbfi": 2.0, "adsbone": 10.0}


# --- WIN-4: a range of the track, in the order in which it is stored ----------------
@register("mover_track_range")
def q_mover_track_range(spark, sf):
    """Rows of each mover's track in the middle of the time, and those that do
    not follow their predecessor in the files."""
    from pyspark.sql import Window
    f = standin.flights(spark, sf)
    lo, hi = f.agg(F.min("timestamp")).scalar(), f.agg(F.max("timestamp")).scalar()
    path = scratch_path(spark, "track")
    windows.mover_track(f, "icao24", start=lo + flt.interval("3 days"), end=hi - flt.interval("5 days")).write.parquet(path)
    rows = spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
    before = F.lag(F.struct("icao24", "timestamp")).over(Window.partitionBy("file_name").orderBy("row_index"))
    return (rows.withColumn("wrong", F.coalesce(before > F.struct("icao24", "timestamp"), F.lit(False)))
            .groupBy("icao24").agg(F.count("*").alias("points"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count_if("wrong").alias("misordered")))


# --- SNK-6 / SNK-7: defaults of the writers -----------------------------------------
@register("default_ingested_at")
def q_default_ingested_at(spark, sf):
    """Rows of one feed come without ``ingested_at``: they have the append's time,
    one for all; those of the others keep theirs."""
    f, path = standin.flights(spark, sf), scratch_path(spark, "flights")
    late = F.col("source") == "adsbone"
    sinks.append(f.where(~late), path, "flights")
    sinks.append(f.where(late).drop("ingested_at"), path, "flights")
    r = sinks.read_table(spark, path, "flights")
    now = F.col("ingested_at").between(F.current_timestamp() - flt.interval("1 day"), F.current_timestamp())
    return r.groupBy("source").agg(F.count("*").alias("rows"), F.count_if(now).alias("at_write"),
                                   F.when(F.col("source") == "adsbone", F.count_distinct("ingested_at")).alias("write_times"))


@register("default_flags")
def q_default_flags(spark, sf):
    """Departures without ``platform_changed`` and with some ``cancelled`` unknown."""
    d, path = standin.departures(spark, sf), scratch_path(spark, "departures")
    known = F.when(F.col("platform_actual").isNotNull(), F.col("cancelled"))
    sinks.append(d.withColumn("cancelled", known).drop("platform_changed"), path, "departures")
    r = sinks.read_table(spark, path, "departures")
    return r.groupBy("station_id", "cancelled", "platform_changed").agg(F.count("*").alias("rows"))


# --- LAY-5: newest rows by key, from pruned chunks of a compacted table -------------
@register("recent_by_mover")
def q_recent_by_mover(spark, sf):
    f, path = standin.flights(spark, sf), scratch_path(spark, "flights")
    sinks.append(f, path, "flights")
    layout.compact_chunks(spark, path, "flights", f.agg(_iso(F.max("ingested_at"))).first()[0])
    r = layout.recent_rows(sinks.read_table(spark, path, "flights"), "flights", "icao24", latest(f), "10 days", 5)
    return r.select("icao24", ntz("timestamp").alias("timestamp"), ntz("ingested_at").alias("ingested_at"), F.col("rank").cast("long").alias("rank"))


# --- LAY-4 for service alerts: stored from the feed, then retained ------------------
@register("retention_alerts")
def q_retention_alerts(spark, sf):
    """Positions and alerts stored by one job; alerts past their days are dropped."""
    vehicles, alerts = scratch_path(spark, "vehicle_positions"), scratch_path(spark, "service_alerts")
    jobs.ingest(spark, "gtfs_rt", landed.land_gtfs(spark, sf), vehicles, alerts_path=alerts)
    as_of = sinks.read_table(spark, alerts, "service_alerts").agg(_iso(F.max("timestamp"))).first()[0]
    layout.drop_chunks(spark, alerts, "service_alerts", as_of, RETENTION_DAYS["service_alerts"])
    kept = [(n, sinks.read_table(spark, p, n)) for n, p in (("service_alerts", alerts), ("vehicle_positions", vehicles))]
    return agg.union_all([r.groupBy("chunk").agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "chunk", "rows") for n, r in kept])


# --- DED-5 over several micro-batches ------------------------------------------------
@register("dedup_pings_batches")
def q_dedup_pings_batches(spark, sf):
    """Copies of a ping come in other micro-batches, the watermark reaches back over all of them."""
    land = _land_files(landed.land_ship_frames(spark, sf), "landing_copies", 6, F.xxhash64("seq"))
    r = _run(spark, streams.dedup_stream(spark, land, watermark="400 days", max_files=1), "dedup_batches")
    return r.select("mmsi", ntz("timestamp").alias("timestamp"),
                    R.coord_cell(F.col("latitude")).alias("lat_cell"), R.coord_cell(F.col("longitude")).alias("lon_cell"))
