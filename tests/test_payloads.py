"""Normaliser edge rows (one landed document each)."""

import datetime as dt


from movelake.schemas import LANDED
from movelake.sources import aircraft, orbits, payloads, rail, ships

UTC = dt.timezone.utc
CYC = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)


def _landed(spark, bodies, status=200, source="t"):
    rows = [(source, f"ep{i}", CYC, i, status, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, LANDED)


def test_state_vectors_short_array_and_wrong_type(spark):
    full = '["abc123","DLH12  ","Germany",1,2,8.5,47.1,10000,false,230,95,0,null,10010,"1000",false,0]'
    wrong = '["abc124","X","Germany",1,2,8.5,"47.1",10000,false,230,95,0,null,10010,"1000",false,0]'
    short = '["abc125","X","Germany",1,2,8.5,47.1,10000,false,230,95,0,null,10010,"1000",false]'
    df = aircraft.norm_state_vectors(_landed(spark, ['{"states":[%s,%s,%s]}' % (full, wrong, short)]))
    rows = {r.icao24: r for r in df.collect()}
    assert set(rows) == {"abc123", "abc124"}
    assert rows["abc123"].callsign == "DLH12" and rows["abc123"].latitude == 47.1
    assert rows["abc124"].latitude is None and rows["abc124"].on_ground is False


def test_adsb_key_alias_and_failed_siblings(spark):
    ok_ac = '{"ac":[{"hex":"a1","lat":1.0,"lon":2.0,"alt_baro":"ground"}]}'
    ok_aircraft = '{"aircraft":[{"hex":"a2","lat":1.0,"lon":2.0,"alt_baro":30000}]}'
    truncated = '{"ac":[{"hex":"a3","lat":1.0'
    wrong_type = '{"ac":[{"hex":"a4","lat":"1.0","lon":2.0}]}'
    landed = _landed(spark, [ok_ac, ok_aircraft, truncated, wrong_type]).unionByName(
        _landed(spark, [ok_ac.replace("a1", "a5")], status=500))
    got = {r.icao24: (r.on_ground, r.baro_altitude) for r in aircraft.norm_adsb_snapshot(landed).collect()}
    assert got == {"a1": (True, None), "a2": (None, 30000.0)}
    rej = aircraft.rejected_adsb(landed).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in rej} == {"corrupt": 2, "http_status": 1}


def test_first_endpoint_wins_and_null_hex(spark):
    b0 = '{"ac":[{"hex":"a1","gs":1.0},{"flight":"nohex"}]}'
    b1 = '{"ac":[{"hex":"a1","gs":2.0,"lat":1.0,"lon":1.0},{"hex":"a2","gs":3.0}]}'
    landed = _landed(spark, [b0, b1])
    got = {r.icao24: r.velocity for r in aircraft.norm_adsb_endpoints(landed).collect()}
    assert got == {"a1": 1.0, "a2": 3.0}
    # type feed: only a record with a position may claim the hex
    got = {r.icao24: r.velocity for r in aircraft.norm_adsb_types(landed).collect()}
    assert got == {"a1": 2.0}


def test_private_feeder_rules(spark):
    b = ('{"aircraft":[{"hex":"ABC","lat":1.0,"lon":2.0,"alt_baro":"ground"},'
         '{"hex":"DEF","lat":1.0,"lon":2.0,"alt_baro":"x","alt_geom":900},'
         '{"hex":"GHI","lat":1.0}]}')
    frac = '{"aircraft":[{"hex":"JKL","lat":1.0,"lon":2.0,"alt_geom":900.5}]}'
    got = {r.icao24: (r.baro_altitude, r.on_ground)
           for r in aircraft.norm_private_feeder(_landed(spark, [b, frac])).collect()}
    assert got == {"abc": (0.0, True), "def": (900.0, False)}


def test_ship_messages(spark):
    bodies = ['{"MessageType":"PositionReport","MetaData":{"MMSI":111222333,"ShipName":"MV TEST  ",'
              '"latitude":51.5,"longitude":0.1}}', '{"MessageType":"PositionReport"}', '{"Mess']
    rows = ships.norm_ship_messages(_landed(spark, bodies)).collect()
    assert len(rows) == 1 and rows[0].mmsi == "111222333" and rows[0].ship_name == "MV TEST  "


def _stations(spark):
    return spark.createDataFrame([("ep0", "Zürich HB")], "endpoint string, station_name string")


def test_swiss_board(spark):
    b = ('{"stationboard":[{"stop":{"departureTimestamp":1776600000,"delay":3,"platform":"7",'
         '"prognosis":{"platform":"8","departure":"2026-04-19T14:03:00+02:00"}},"category":"IC","number":"5"},'
         '{"name":"S3","stop":{"departureTimestamp":1776600000,"prognosis":{"platform":"4"}}},{"name":"gone"}]}')
    rows = rail.norm_departures_ch(_landed(spark, [b]), _stations(spark)).orderBy("line_name").collect()
    assert [r.line_name for r in rows] == ["IC 5", "S3"]
    ic, s3 = rows
    assert ic.delay_seconds == 180 and ic.platform_changed and ic.station_id == "sbb:ep0"
    assert ic.station_name == "Zürich HB" and ic.actual_time is not None
    assert s3.platform_changed is True and s3.delay_seconds is None and s3.trip_id is None


def test_belgian_board(spark):
    b = ('{"departures":{"departure":[{"station":"Gent","time":"1776600000","delay":"120","canceled":"1",'
         '"vehicle":"BE.NMBS.IC123","platform":"3","platforminfo":{"normal":"0"}},'
         '{"time":"x","delay":" 60 ","canceled":"0","platform":"4","platforminfo":{"normal":"1"}}]}}')
    rows = rail.norm_departures_be(_landed(spark, [b]), _stations(spark)).collect()
    a, c = sorted(rows, key=lambda r: r.platform_planned)
    assert a.delay_seconds == 120 and a.cancelled and a.platform_actual == "3" and a.trip_id == a.line_name
    assert c.planned_time is None and c.delay_seconds is None and c.platform_actual is None


def test_orbits_reject_whole_document(spark):
    good = '[{"NORAD_CAT_ID":25544,"OBJECT_NAME":"ISS","EPOCH":"2026-04-19T12:00:00.000000"}]'
    bad = '[{"NORAD_CAT_ID":1,"OBJECT_NAME":"A"},{"NORAD_CAT_ID":2}]'
    rows = orbits.norm_orbital_elements(_landed(spark, [good, bad])).collect()
    assert [(r.norad_id, r.epoch) for r in rows] == [(25544, None)]
    rej = orbits.rejected_orbits(_landed(spark, [good, bad])).select("reason").collect()
    assert [r.reason for r in rej] == ["missing_required"]


def test_gtfs_decode_roundtrip(spark):
    from movelake.sources import gtfs
    cls = gtfs.message_classes()["FeedMessage"]
    f = cls()
    f.header.gtfs_realtime_version = "2.0"
    f.header.timestamp = 1745064000
    e = f.entity.add(id="1")
    e.vehicle.vehicle.id = "v1"
    e.vehicle.position.latitude = 52.52
    e.vehicle.position.longitude = 13.4
    f.entity.add(id="2").vehicle.trip.trip_id = "no-position"
    rows = [("gtfs", "vp", CYC, 0, 200, bytearray(f.SerializeToString())),
            ("gtfs", "vp", CYC, 1, 200, bytearray(b"\x12\xff\xff"))]
    landed = spark.createDataFrame(rows, "source string, endpoint string, cycle_ts timestamp, seq long, "
                                         "status int, body binary")
    out = gtfs.norm_vehicle_positions(landed).collect()
    assert len(out) == 1 and out[0].latitude == 52.52000045776367
    assert out[0].timestamp.replace(tzinfo=None) == dt.datetime(2025, 4, 19, 12, 0) or \
        out[0].timestamp.astimezone(UTC) == dt.datetime(2025, 4, 19, 12, 0, tzinfo=UTC)
    counters = gtfs.feed_counters(landed).collect()
    assert [(c.total_entities, c.vehicle_positions) for c in counters] == [(2, 1)]


def test_key_and_alias_together_rejects_document(spark):
    both = '{"ac":[{"hex":"b1","lat":1.0,"lon":2.0}],"aircraft":[{"hex":"b2","lat":1.0,"lon":2.0}]}'
    landed = _landed(spark, [both])
    assert aircraft.norm_adsb_snapshot(landed).count() == 0
    assert [r.reason for r in aircraft.rejected_adsb(landed).collect()] == ["corrupt"]


def test_integer_fields_are_strict(spark):
    """Fractional, exponent or out-of-range numbers for integer fields reject
    the document, as a strict deserialiser does."""
    bad = ['{"MessageType":"P","MetaData":{"MMSI":123.5,"latitude":1.0,"longitude":2.0}}',
           '{"MessageType":"P","MetaData":{"MMSI":123.0,"latitude":1.0,"longitude":2.0}}',
           '{"MessageType":"P","MetaData":{"MMSI":1e3,"latitude":1.0,"longitude":2.0}}',
           '{"MessageType":"P","MetaData":{"MMSI":99999999999999999999}}']
    good = '{"MessageType":"P","MetaData":{"MMSI":123,"latitude":1.0,"longitude":2.0}}'
    rows = ships.norm_ship_messages(_landed(spark, bad + [good])).collect()
    assert [r.mmsi for r in rows] == ["123"]
    overflow = '{"stationboard":[{"stop":{"departureTimestamp":1,"delay":3000000000}}]}'
    assert rail.norm_departures_ch(_landed(spark, [overflow]), _stations(spark)).count() == 0
