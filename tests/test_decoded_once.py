"""Protobuf payloads are decoded once, whatever else lies in their batch."""

import datetime as dt

from movelake import jobs
from movelake.sources import gtfs
from test_gtfs_columns import FEED, HEADER, POSITION, by_attributes, decoded, message

AT = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_odd_payloads_do_not_send_the_others_through_one_by_one(monkeypatch):
    def plain(i):
        f = FEED()
        f.header.gtfs_realtime_version = "2.0"
        f.entity.add(id=f"e{i}").vehicle.position.latitude = 1.0
        f.entity[0].vehicle.position.longitude = i
        f.entity[0].vehicle.trip.trip_id = "café"
        return f.SerializePartialToString()

    latin = HEADER + message(2, message(1, b"e") + message(4, POSITION + message(1, message(1, b"\xff\xfe"))))
    again = HEADER + message(2, message(1, b"e") + message(4, POSITION + message(1, message(1, b"t1"))) + message(4, message(1, message(5, b"r1"))))
    bodies = [x for i in range(40) for x in (plain(i), latin if i % 4 == 0 else again if i % 4 == 1 else b"")]
    made, init = [], gtfs._Reader.__init__
    monkeypatch.setattr(gtfs._Reader, "__init__", lambda self, b: (made.append(len(b)), init(self, b))[1])
    kinds = {}
    for kind, place, *_ in gtfs._decoded(bodies, ("vehicle",)):
        kinds.setdefault(kind, []).extend(place.tolist())
    assert len(made) <= 6
    assert set(kinds["reject"]) == {i for i, b in enumerate(bodies) if b == latin}
    assert sorted(kinds["payload"]) == sorted(set(range(len(bodies))) - set(kinds["reject"]))
    few = [plain(1), again, plain(2), again]
    got = decoded(few)
    for i, b in enumerate(few):
        assert {k: got[i][k] for k in gtfs.PARTS} == by_attributes(FEED.FromString(b))


def test_left_out_and_rejects_decode_once(spark):
    good = FEED()
    good.header.gtfs_realtime_version = "2.0"
    good.entity.add(id="x")  # no position
    ok = good.SerializeToString()
    bodies = [(200, ok), (200, b"\xff" * 9), (503, b"late"), (200, ok)]
    rows = [("gtfs_rt", "x", AT, i, s, bytearray(b)) for i, (s, b) in enumerate(bodies)]
    land = spark.createDataFrame(rows, "source string, endpoint string, cycle_ts timestamp, seq long, status int, body binary").repartition(2)
    counts = jobs.left_out("gtfs_rt", land)
    assert plan(counts).count("MapInArrow") == 1
    assert {tuple(r) for r in counts.collect()} == {("gtfs_rt", "document", "http_status", 1), ("gtfs_rt", "document", "corrupt", 1), ("gtfs_rt", "record", "no_position", 2)}
    rejects = jobs.FEEDS["gtfs_rt"][2](land)
    assert plan(rejects).count("MapInArrow") == 1
    columns = ["seq", "status", "body", "reason"]
    want = gtfs.rejected_payloads(gtfs.decode(land, ()), land)
    assert sorted(rejects.select(columns).collect()) == sorted(want.select(columns).collect()) != []
