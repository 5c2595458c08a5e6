"""Work that must not grow faster than the documents: each is put together
and parsed once."""

import datetime as dt

import pyarrow as pa
import pytest

from movelake.sources import landed, payloads, rail

AT = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_body_is_parsed_once(spark):
    body = '{"departures":[{"tripId":"a"},null,{"tripId":"b"}]}'
    rows = [("board_at", "1", AT, i, s, b) for i, (s, b) in enumerate([(200, body), (200, body[:20]), (503, body), (200, None), (200, "{}")])]
    land = spark.createDataFrame(rows, "source string, endpoint string, cycle_ts timestamp, seq long, status int, body string").repartition(2)
    stations = spark.createDataFrame([("1", "One")], "endpoint string, station_name string")
    out = rail.norm_departures_at(land, stations)
    assert plan(out).count("from_json") == 1
    assert sorted((r.trip_id or "", r.station_name) for r in out.collect()) == [("", "One"), ("a", "One"), ("b", "One")]
    bad = payloads.rejected(land, rail.AT_DOC)
    assert plan(bad).count("from_json") == 1
    assert sorted((r.seq, r.reason) for r in bad.collect()) == [(1, "corrupt"), (2, "http_status"), (3, "corrupt")]


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_records_of_a_document_are_joined_across_batches(size):
    keys = [(0, "a", 1, AT, 5)] * 4 + [(0, "a", 1, None, 5)] * 2 + [(0, "a", 1, None, 6)] + [(1, None, 1, AT, 5)] * 5
    schema = pa.schema([("endpoint_idx", pa.int32()), ("endpoint", pa.string()), ("cycle_no", pa.int64()), ("cycle_ts", pa.timestamp("us", "UTC")), ("page", pa.int64()), ("rec", pa.string())])
    rows = pa.Table.from_pylist([dict(zip(schema.names, (*k, f"r{i}"))) for i, k in enumerate(keys)], schema)
    out = [r for b in landed._join_records(iter(rows.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    want = {}
    for i, k in enumerate(keys):
        want.setdefault(k, []).append(f"r{i}")
    assert [(tuple(list(r.values())[:5]), r["rec"]) for r in out] == [(k, ",".join(v)) for k, v in want.items()]


def test_documents_are_sorted_once(spark):
    rows = [(0, "a", 1, AT, 0, 2, "y"), (0, "a", 1, AT, 0, 1, "x"), (0, "a", 1, AT, 0, 1, "w"), (1, "b", 1, AT, 0, 1, "z")]
    r = spark.createDataFrame(rows, "endpoint_idx int, endpoint string, cycle_no long, cycle_ts timestamp, page long, event_id long, rec string").repartition(3)
    d = landed.documents(r, "s", "ac")
    assert plan(d).count("ObjectHashAggregate") == 0
    assert sorted((x.endpoint, x.status, x.body.split('"ac":')[1]) for x in d.collect()) == [("a", 200, "[w,x,y]}"), ("b", 200, "[z]}")]
