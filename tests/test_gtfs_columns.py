"""The column reader of protobuf payloads against the parser's own attributes."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from movelake.operators import sinks
from movelake.session import scratch_path
from movelake.sources import gtfs, payloads, wire
from movelake.streaming import streams

FEED = gtfs.message_classes()["FeedMessage"]


def optional(m, name):
    return getattr(m, name) if m.HasField(name) else None


def by_attributes(feed):
    out = {"vehicle": [], "alert": [], "stop": []}
    for e in feed.entity:
        if e.HasField("vehicle") and e.vehicle.HasField("position"):
            v, p = e.vehicle, e.vehicle.position
            out["vehicle"].append((e.id, optional(v, "timestamp"), optional(v.vehicle, "id"), optional(v.trip, "trip_id"), optional(v.trip, "route_id"),
                                   p.latitude, p.longitude, optional(p, "bearing"), optional(p, "speed")))
        if e.HasField("alert"):
            text = lambda t: t.translation[0].text if len(t.translation) else None
            out["alert"].append((e.id, optional(e.alert, "cause"), optional(e.alert, "effect"), text(e.alert.header_text), text(e.alert.description_text)))
        for s in e.trip_update.stop_time_update:
            t = e.trip_update.trip
            out["stop"].append((e.id, optional(t, "trip_id"), optional(t, "route_id"), optional(s, "stop_sequence"), optional(s, "stop_id"),
                                optional(s.arrival, "delay"), optional(s.departure, "delay")))
    return out


def decoded(bodies):
    out = {i: {"vehicle": [], "alert": [], "stop": [], "kinds": set()} for i in range(len(bodies))}
    for kind, of, times, ids, columns in gtfs._decoded(bodies, gtfs.PARTS):
        for n, i in enumerate(of.tolist()):
            out[i]["kinds"].add(kind)
            if kind in gtfs.PARTS:
                out[i][kind].append((ids[n].as_py(), *(c[n].as_py() for c in columns.values())))
    return out


def random_feed(r):
    f = FEED()
    f.header.gtfs_realtime_version = "2.0"
    if r.random() < 0.7:
        f.header.timestamp = r.choice([0, 1, 1 << 33])
    maybe = lambda m, k, v: setattr(m, k, v) if r.random() < 0.6 else None
    word = lambda: r.choice(["", "a", "ü漢" * r.randint(1, 40), "x" * 200])
    for i in range(r.choice([0, 1, 30])):
        e = f.entity.add(id=f"{i}{word()}")
        if r.random() < 0.6:
            e.vehicle.SetInParent()
            maybe(e.vehicle, "timestamp", r.choice([0, 127, 128, 1 << 40]))
            for m, names in ((e.vehicle.trip, ("trip_id", "route_id", "start_date")), (e.vehicle.vehicle, ("id", "label"))):
                for k in names:
                    maybe(m, k, word())
            if r.random() < 0.7:
                e.vehicle.position.latitude, e.vehicle.position.longitude = r.uniform(-90, 90), 0.0
                for k in ("bearing", "speed", "odometer"):
                    maybe(e.vehicle.position, k, r.uniform(0, 9))
        if r.random() < 0.3:
            e.alert.SetInParent()
            maybe(e.alert, "cause", r.randint(0, 9))
            maybe(e.alert, "effect", r.randint(0, 300))
            for t in (e.alert.header_text, e.alert.description_text):
                for _ in range(r.randint(0, 2)):
                    t.translation.add(text=word(), language="en")
        for _ in range(r.choice([0, 0, 3])):
            s = e.trip_update.stop_time_update.add()
            maybe(s, "stop_id", word())
            maybe(s, "stop_sequence", r.randint(0, 1 << 31))
            maybe(s.arrival, "delay", r.randint(-500, 500))
            maybe(s.departure, "time", 5)
            maybe(s.departure, "delay", -1)
            maybe(e.trip_update.trip, "route_id", word())
    return f


@pytest.mark.parametrize("seed", range(40))
def test_columns_are_the_parsers_values(seed):
    r = random.Random(seed)
    feeds = [random_feed(r) for _ in range(4)]
    got = decoded([f.SerializeToString() for f in feeds])
    for i, f in enumerate(feeds):
        assert {k: got[i][k] for k in gtfs.PARTS} == by_attributes(f)


def tagged(number, kind, body=b""):
    return bytes([number << 3 | kind]) + body


def message(number, body):
    return tagged(number, 2, bytes([len(body)]) + body)


HEADER = message(1, message(1, b"2.0"))
POSITION = message(2, tagged(1, 5, struct.pack("<f", 1.5)) + tagged(2, 5, struct.pack("<f", 2.5)))


def test_unusual_payloads_read_as_the_parser_reads_them():
    again = HEADER + message(2, message(1, b"e") + message(4, POSITION + message(1, message(1, b"t1"))) + message(4, message(1, message(5, b"r1"))))
    group = HEADER + message(2, message(1, b"e") + message(4, tagged(15, 3) + tagged(15, 4) + POSITION))
    twice = HEADER + message(2, message(1, b"first") + message(1, b"last") + message(4, POSITION))
    plain = random_feed(random.Random(1)).SerializeToString()
    for bodies in ([again], [group], [twice], [plain, again, group, twice]):
        got = decoded(bodies)
        for i, b in enumerate(bodies):
            assert {k: got[i][k] for k in gtfs.PARTS} == by_attributes(FEED.FromString(b))
    with pytest.raises(wire.Unusual):
        gtfs._Reader([group]).vehicles()


def test_bad_payloads_are_rejects_and_big_times_are_signed(spark):
    import datetime as dt
    good = FEED()
    good.header.gtfs_realtime_version = "2.0"
    good.header.timestamp = (1 << 64) - 5
    e = good.entity.add(id="x")
    e.vehicle.position.latitude = e.vehicle.position.longitude = 1.0
    e.vehicle.timestamp = (1 << 63) + 7
    body = good.SerializeToString()
    latin = HEADER + message(2, message(1, b"e") + message(4, POSITION + message(1, message(1, b"\xff\xfe"))))
    bodies = [body, body[:-3] + b"\x12\xff\xff", latin, b"\xff" * 20, b""]
    at = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)
    rows = [("gtfs_rt", "x", at, i, 200, bytearray(b)) for i, b in enumerate(bodies)] + [("gtfs_rt", "x", at, 9, 503, bytearray(b"late"))]
    landed = spark.createDataFrame(rows, "source string, endpoint string, cycle_ts timestamp, seq long, status int, body binary").repartition(2)
    got = {(r.seq, r.reason) for r in gtfs.rejected_payloads(gtfs.decode(landed, ()), landed).collect()}
    accepted = {i for i, b in enumerate(bodies) if i != 2 and _parses(b)}
    assert got == {(i, "corrupt") for i in range(5) if i not in accepted} | {(9, "http_status")} and 0 in accepted and (2, "corrupt") in got
    v = gtfs.norm_vehicle_positions(landed).where("latitude = 1").first()
    assert v.feed_timestamp == -5
    back = gtfs.decode(landed, ("vehicle",)).where("kind = 'vehicle'").first().vehicle
    assert back.ts == (1 << 63) + 7 - (1 << 64)
    dead = scratch_path(spark, "dead")
    assert payloads.dead_letter(gtfs.rejected_payloads(gtfs.decode(landed, ()), landed), dead) == len(got)


def _parses(b):
    try:
        FEED.FromString(b)
        return True
    except Exception:  # noqa: BLE001
        return False


def test_a_large_payload_fills_some_records():
    f = FEED()
    f.header.gtfs_realtime_version = "2.0"
    for i in range(3000):
        p = f.entity.add(id=str(i)).vehicle.position
        p.latitude, p.longitude = 1.0, 2.0
    out = [x for x in gtfs._decoded([f.SerializeToString()], ("vehicle",)) if x[0] == "vehicle"][0]
    assert out[3].to_pylist() == [str(i) for i in range(3000)] and out[4]["latitude"].type == pa.float32()


def test_protobuf_files_as_a_stream(spark, tmp_path):
    f = FEED()
    f.header.gtfs_realtime_version = "2.0"
    for i in range(3):
        e = f.entity.add(id=str(i))
        e.vehicle.position.latitude, e.vehicle.position.longitude, e.vehicle.timestamp = 50.0 + i, 8.0, 1_700_000_000 + i
    for k in range(2):
        (tmp_path / "in" / f"city{k}").mkdir(parents=True)
        (tmp_path / "in" / f"city{k}" / "1.pb").write_bytes(f.SerializeToString())
    (tmp_path / "in" / "city0" / "broken.pb").write_bytes(b"\xff\xff")
    table, ck = scratch_path(spark, "vp"), scratch_path(spark, "ck")
    src = streams.payload_files(spark, str(tmp_path / "in"), "gtfs_rt", max_files=1)
    streams.stream_feed(spark, "", "gtfs_rt", table, ck, trigger=None, landed=src).awaitTermination()
    assert sinks.read_table(spark, table, "vehicle_positions").groupBy("latitude").count().where(F.col("count") == 2).count() == 3
