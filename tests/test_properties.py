"""Property tests of first-wins de-dup: idempotent, a subset of the input,
one row per key."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from movelake.operators.dedup import dedup_pings, first_wins

UTC = dt.timezone.utc
row = st.tuples(st.sampled_from(["111", "222", None]), st.sampled_from([50.0, 50.0000004, 50.00002]),
                st.sampled_from([10.0, 10.00001]), st.integers(1000, 1002))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=12))
def test_dedup_properties(spark, rows):
    data = [(i, m, la, lo, dt.datetime.fromtimestamp(s, UTC)) for i, (m, la, lo, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, mmsi string, latitude double, longitude double, timestamp timestamp")
    once = dedup_pings(df)
    out = sorted(tuple(r) for r in once.collect())
    twice = sorted(tuple(r) for r in dedup_pings(once).collect())
    assert out == twice
    assert set(out) <= set(tuple(r) for r in df.collect())
    keys = {(r[1], round(r[2] * 1e5), round(r[3] * 1e5), int(r[4].timestamp())) for r in out}
    assert len(keys) == len(out)
    # survivors are the first occurrence of each key in input order
    seen, expect = set(), []
    for seq, m, la, lo, ts in data:
        k = (m, round(la * 1e5), round(lo * 1e5), int(ts.timestamp()))
        if k not in seen:
            seen.add(k)
            expect.append(seq)
    assert sorted(r[0] for r in out) == expect


def test_first_wins_multi_column_order(spark):
    df = spark.createDataFrame([("k", 2, 0, "b"), ("k", 1, 5, "a"), ("k", 1, 3, "c")],
                               "key string, seq int, pos int, v string")
    assert first_wins(df, ["key"], ["seq", "pos"]).first().v == "c"


# --- normalise(encode(record)) follows the feed rules -----------------------------
import json  # noqa: E402

from movelake.schemas import LANDED  # noqa: E402
from movelake.sources import aircraft  # noqa: E402

alt_baro = st.one_of(st.none(), st.just("ground"), st.sampled_from(["35000", "other"]),
                     st.integers(-1000, 45000), st.floats(-1000, 45000, allow_nan=False))
record = st.fixed_dictionaries({
    "hex": st.one_of(st.none(), st.text("0123456789abcdef", min_size=6, max_size=6)),
    "flight": st.one_of(st.none(), st.sampled_from(["DLH12  ", " \tAB1\n", "   ", "X"])),
    "lat": st.one_of(st.none(), st.floats(-90, 90, allow_nan=False)),
    "lon": st.one_of(st.none(), st.floats(-180, 180, allow_nan=False)),
    "alt_baro": alt_baro,
    "alt_geom": st.one_of(st.none(), st.floats(0, 40000, allow_nan=False)),
    "gs": st.one_of(st.none(), st.floats(0, 600, allow_nan=False)),
})


def _expected(r):
    ab = r["alt_baro"]
    is_num = isinstance(ab, (int, float)) and not isinstance(ab, bool)
    alt = float(ab) if is_num else (float(r["alt_geom"]) if r["alt_geom"] is not None else None)
    ground = (ab == "ground") if isinstance(ab, str) else None
    cs = r["flight"].strip(" \t\n\r\x0b\x0c") if r["flight"] is not None else None
    return (r["hex"], cs, r["lat"], r["lon"], alt, ground, r["gs"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=8))
def test_adsb_snapshot_roundtrip(spark, recs):
    import datetime as dt
    body = json.dumps({"aircraft": [{k: v for k, v in r.items() if v is not None} for r in recs]})
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    landed = spark.createDataFrame([("snap", "global", cyc, 0, 200, body)], LANDED)
    got = sorted((tuple(x) for x in aircraft.norm_adsb_snapshot(landed).select(
        "icao24", "callsign", "latitude", "longitude", "baro_altitude", "on_ground", "velocity").collect()),
        key=repr)
    want = sorted((_expected(r) for r in recs if r["lat"] is not None and r["lon"] is not None), key=repr)
    assert got == want


# --- state vectors: positional cells of any JSON type ------------------------------
cell = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                 st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
                 st.sampled_from(["abc123", " DLH12 ", "", "12.5", "Germany"]))


def _num(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None


def _str(v):
    return v if isinstance(v, str) else None


def _sv_expected(s):
    cs = _str(s[1])
    return (_str(s[0]), cs.strip(" \t\n\r\x0b\x0c") if cs is not None else None, _str(s[2]),
            _num(s[5]), _num(s[6]), _num(s[7]), s[8] if isinstance(s[8], bool) else None,
            _num(s[9]), _num(s[10]), _num(s[11]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(cell, min_size=15, max_size=18), min_size=1, max_size=6))
def test_state_vectors_roundtrip(spark, states):
    import datetime as dt
    body = json.dumps({"time": 1, "states": states})
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    landed = spark.createDataFrame([("sv", "all", cyc, 0, 200, body)], LANDED)
    got = sorted((tuple(r) for r in aircraft.norm_state_vectors(landed).select(
        "icao24", "callsign", "origin_country", "longitude", "latitude", "baro_altitude", "on_ground",
        "velocity", "true_track", "vertical_rate").collect()), key=repr)
    want = sorted((_sv_expected(s) for s in states if len(s) >= 17), key=repr)
    assert got == want


# --- Belgian boards: every value is text ---------------------------------------------
import re  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from movelake.sources import rail  # noqa: E402

int_text = st.one_of(st.none(), st.integers(-3000, 3000).map(str), st.integers(0, 3000).map(lambda i: f"+{i}"),
                     st.integers(0, 99).map(lambda i: f" {i} "), st.just("99999999999"), st.just("12a"),
                     st.just(""), st.just("-"))
time_text = st.one_of(st.none(), st.integers(0, 2_000_000_000).map(str), st.just("x"),
                      st.just("999999999999999999"))
dep = st.fixed_dictionaries({"time": time_text, "delay": int_text,
                             "canceled": st.sampled_from([None, "0", "1", "yes"]),
                             "platform": st.sampled_from([None, "3", "4A"]),
                             "platforminfo": st.one_of(st.none(), st.fixed_dictionaries(
                                 {"normal": st.sampled_from([None, "1", "0", "x"])}))})


def _int(t, lo, hi):
    if t is None or not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    v = int(t)
    return v if lo <= v <= hi else None


def _be_expected(d):
    import datetime as dt
    secs = _int(d["time"], -62135596800, 253402300799)
    planned = (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=secs)) if secs is not None else None
    normal = (d["platforminfo"] or {}).get("normal")
    changed = normal is not None and normal != "1"
    return (planned, _int(d["delay"], -2**31, 2**31 - 1), d["canceled"] == "1", d["platform"],
            d["platform"] if changed else None, changed)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(dep, min_size=1, max_size=8))
def test_belgian_board_roundtrip(spark, deps):
    import datetime as dt
    body = json.dumps({"departures": {"departure": [{k: v for k, v in d.items() if v is not None}
                                                    for d in deps]}})
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    landed = spark.createDataFrame([("board_be", "ep0", cyc, 0, 200, body)], LANDED)
    stations = spark.createDataFrame([("ep0", "Gent")], "endpoint string, station_name string")
    out = rail.norm_departures_be(landed, stations).select(
        F.col("planned_time").cast("timestamp_ntz"), "delay_seconds", "cancelled", "platform_planned",
        "platform_actual", "platform_changed")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(map(_be_expected, deps), key=repr)


# --- Swiss boards: line name ladder, delay minutes, strict RFC 3339 -----------------
rfc_text = st.one_of(st.none(), st.sampled_from([
    "2026-04-19T10:00:00Z", "2026-04-19T12:00:00+02:00", "2026-04-19t10:00:00.5z",
    "2026-04-19T12:00:00+0200", "2026-04-19T10:00:00", "nonsense"]))
RFC_UTC = {"2026-04-19T10:00:00Z": (10, 0, 0, 0), "2026-04-19T12:00:00+02:00": (10, 0, 0, 0),
           "2026-04-19t10:00:00.5z": (10, 0, 0, 500000)}
entry = st.fixed_dictionaries({
    "stop": st.one_of(st.none(), st.fixed_dictionaries({
        "departureTimestamp": st.one_of(st.none(), st.integers(0, 2_000_000_000)),
        "delay": st.one_of(st.none(), st.integers(-100, 100), st.just(40_000_000)),
        "platform": st.sampled_from([None, "7", "8"]),
        "prognosis": st.one_of(st.none(), st.fixed_dictionaries({
            "platform": st.sampled_from([None, "7", "8"]), "departure": rfc_text}))})),
    "name": st.sampled_from([None, "S3"]), "category": st.sampled_from([None, "IC"]),
    "number": st.sampled_from([None, "5"]), "to": st.sampled_from([None, "Bern"])})


def _ch_expected(e):
    import datetime as dt
    s = e["stop"]
    prog = s["prognosis"] or {}
    ts = s["departureTimestamp"]
    planned = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=ts) if ts is not None else None
    actual = None
    if prog.get("departure") in RFC_UTC:
        h, m, sec, us = RFC_UTC[prog["departure"]]
        actual = dt.datetime(2026, 4, 19, h, m, sec, us)
    d = s["delay"]
    delay = d * 60 if d is not None and -2**31 <= d * 60 < 2**31 else None
    cat, num = e["category"], e["number"]
    line = f"{cat} {num}" if cat and num else cat if cat else e["name"]
    pp, pa = s["platform"], prog.get("platform")
    return (line, e["to"], planned, actual, delay, pp, pa, pa is not None and pp != pa)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(entry, min_size=1, max_size=8))
def test_swiss_board_roundtrip(spark, entries):
    import datetime as dt

    def clean(x):
        return {k: clean(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else x
    body = json.dumps({"stationboard": [clean(e) for e in entries]})
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    landed = spark.createDataFrame([("board_ch", "ep0", cyc, 0, 200, body)], LANDED)
    stations = spark.createDataFrame([("ep0", "Bern")], "endpoint string, station_name string")
    out = rail.norm_departures_ch(landed, stations).select(
        "line_name", "direction", F.col("planned_time").cast("timestamp_ntz"),
        F.col("actual_time").cast("timestamp_ntz"), "delay_seconds", "platform_planned",
        "platform_actual", "platform_changed")
    want = [_ch_expected(e) for e in entries if e["stop"] is not None]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)


# --- Austrian boards: camelCase, RFC 3339 times, both-present platform rule ---------
at_dep = st.fixed_dictionaries({
    "tripId": st.sampled_from([None, "t1", "t2"]), "direction": st.sampled_from([None, "Wien"]),
    "line": st.one_of(st.none(), st.fixed_dictionaries({"name": st.sampled_from([None, "RJX 62"])})),
    "when": rfc_text, "plannedWhen": rfc_text,
    "delay": st.one_of(st.none(), st.integers(-600, 3600)),
    "platform": st.sampled_from([None, "1", "2"]), "plannedPlatform": st.sampled_from([None, "1", "2"])})


def _at_expected(d):
    import datetime as dt

    def ts(t):
        if t in RFC_UTC:
            h, m, s, us = RFC_UTC[t]
            return dt.datetime(2026, 4, 19, h, m, s, us)
        return None
    pp, pa = d["plannedPlatform"], d["platform"]
    return (d["tripId"], (d["line"] or {}).get("name"), d["direction"], ts(d["plannedWhen"]), ts(d["when"]),
            d["delay"], False, pp, pa, pp is not None and pa is not None and pp != pa)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(at_dep, min_size=1, max_size=8))
def test_austrian_board_roundtrip(spark, deps):
    import datetime as dt

    def clean(x):
        return {k: clean(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else x
    body = json.dumps({"departures": [clean(d) for d in deps]})
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    landed = spark.createDataFrame([("board_at", "ep0", cyc, 0, 200, body)], LANDED)
    stations = spark.createDataFrame([("ep0", "Wien Hbf")], "endpoint string, station_name string")
    out = rail.norm_departures_at(landed, stations).select(
        "trip_id", "line_name", "direction", F.col("planned_time").cast("timestamp_ntz"),
        F.col("actual_time").cast("timestamp_ntz"), "delay_seconds", "cancelled", "platform_planned",
        "platform_actual", "platform_changed")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(map(_at_expected, deps), key=repr)


# --- orbital elements: one missing id or name rejects the whole category ----------------
from movelake.sources import orbits  # noqa: E402

element = st.fixed_dictionaries({
    "NORAD_CAT_ID": st.one_of(st.none(), st.integers(1, 99999)),
    "OBJECT_NAME": st.one_of(st.none(), st.sampled_from(["ISS (ZARYA)", "STARLINK-1007"])),
    "EPOCH": st.sampled_from([None, "2026-04-19T10:00:00Z", "2026-04-19T10:00:00.000000"]),
    "MEAN_MOTION": st.one_of(st.none(), st.floats(0, 20, allow_nan=False))})


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(element, min_size=0, max_size=5), min_size=1, max_size=4))
def test_orbit_documents_roundtrip(spark, docs):
    import datetime as dt
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    rows = [("orbits", f"cat{i}", cyc, i, 200, json.dumps([{k: v for k, v in e.items() if v is not None}
                                                          for e in doc]))
            for i, doc in enumerate(docs)]
    landed = spark.createDataFrame(rows, LANDED)
    got = sorted((tuple(r) for r in orbits.norm_orbital_elements(landed).select(
        "norad_id", "name", F.col("epoch").cast("timestamp_ntz"), "mean_motion").collect()), key=repr)
    want = []
    for doc in docs:
        if any(e["NORAD_CAT_ID"] is None or e["OBJECT_NAME"] is None for e in doc):
            continue
        for e in doc:
            ep = dt.datetime(2026, 4, 19, 10, 0) if e["EPOCH"] == "2026-04-19T10:00:00Z" else None
            want.append((e["NORAD_CAT_ID"], e["OBJECT_NAME"], ep, e["MEAN_MOTION"]))
    assert got == sorted(want, key=repr)
    rejected = orbits.rejected_orbits(landed).count()
    assert rejected == sum(any(e["NORAD_CAT_ID"] is None or e["OBJECT_NAME"] is None for e in d) for d in docs)
