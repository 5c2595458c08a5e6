"""GTFS-realtime feeds -> ``vehicle_positions`` (SRC-13), feed counters
(AGG-14), ``service_alerts`` (EXT-1) and stop-time updates (EXT-2).

Spark ships no protobuf reader here, so decoding is the one Python step:
``decode`` (``mapInArrow``) reads each landed payload once and emits tagged
rows: positions, alerts, stop-time updates, counters, and a reject where the
payload does not parse. Every rule after decoding (timestamp ladder, float
widening, enum names) is a Column expression.

The message classes are built at runtime from a descriptor that lists the
fields by their numbers in the public GTFS-realtime schema (proto2), so no
code generation step is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from movelake.functions import rules as R
from movelake.session import ship_package
from movelake.sources import wire
from movelake.sources.dims import ALERT_CAUSE, ALERT_EFFECT

_CLASSES = None

# Field numbers of the public GTFS-realtime schema.
# (message, [(field name, number, label, type, type_name)]); label 1 = optional,
# 2 = required, 3 = repeated. Enums are read as their numbers (varint).
_O, _R, _REP = 1, 2, 3
_T = {"double": 1, "float": 2, "int64": 3, "uint64": 4, "int32": 5, "bool": 8, "string": 9,
      "message": 11, "uint32": 13, "enum_as_int": 5}
_SCHEMA = [
    ("FeedMessage", [("header", 1, _R, "message", "FeedHeader"), ("entity", 2, _REP, "message", "FeedEntity")]),
    ("FeedHeader", [("gtfs_realtime_version", 1, _R, "string", None), ("incrementality", 2, _O, "enum_as_int", None),
                    ("timestamp", 3, _O, "uint64", None)]),
    ("FeedEntity", [("id", 1, _R, "string", None), ("is_deleted", 2, _O, "bool", None),
                    ("trip_update", 3, _O, "message", "TripUpdate"), ("vehicle", 4, _O, "message", "VehiclePosition"),
                    ("alert", 5, _O, "message", "Alert")]),
    ("TripUpdate", [("trip", 1, _O, "message", "TripDescriptor"), ("vehicle", 3, _O, "message", "VehicleDescriptor"),
                    ("stop_time_update", 2, _REP, "message", "StopTimeUpdate"), ("timestamp", 4, _O, "uint64", None),
                    ("delay", 5, _O, "int32", None)]),
    ("StopTimeUpdate", [("stop_sequence", 1, _O, "uint32", None), ("stop_id", 4, _O, "string", None),
                        ("arrival", 2, _O, "message", "StopTimeEvent"), ("departure", 3, _O, "message", "StopTimeEvent"),
                        ("schedule_relationship", 5, _O, "enum_as_int", None)]),
    ("StopTimeEvent", [("delay", 1, _O, "int32", None), ("time", 2, _O, "int64", None),
                       ("uncertainty", 3, _O, "int32", None)]),
    ("VehiclePosition", [("trip", 1, _O, "message", "TripDescriptor"), ("vehicle", 8, _O, "message", "VehicleDescriptor"),
                         ("position", 2, _O, "message", "Position"), ("current_stop_sequence", 3, _O, "uint32", None),
                         ("stop_id", 7, _O, "string", None), ("current_status", 4, _O, "enum_as_int", None),
                         ("timestamp", 5, _O, "uint64", None), ("congestion_level", 6, _O, "enum_as_int", None),
                         ("occupancy_status", 9, _O, "enum_as_int", None)]),
    ("Alert", [("active_period", 1, _REP, "message", "TimeRange"), ("cause", 6, _O, "enum_as_int", None),
               ("effect", 7, _O, "enum_as_int", None), ("url", 8, _O, "message", "TranslatedString"),
               ("header_text", 10, _O, "message", "TranslatedString"),
               ("description_text", 11, _O, "message", "TranslatedString")]),
    ("TimeRange", [("start", 1, _O, "uint64", None), ("end", 2, _O, "uint64", None)]),
    ("Position", [("latitude", 1, _R, "float", None), ("longitude", 2, _R, "float", None),
                  ("bearing", 3, _O, "float", None), ("odometer", 4, _O, "double", None),
                  ("speed", 5, _O, "float", None)]),
    ("TripDescriptor", [("trip_id", 1, _O, "string", None), ("route_id", 5, _O, "string", None),
                        ("direction_id", 6, _O, "uint32", None), ("start_time", 2, _O, "string", None),
                        ("start_date", 3, _O, "string", None), ("schedule_relationship", 4, _O, "enum_as_int", None)]),
    ("VehicleDescriptor", [("id", 1, _O, "string", None), ("label", 2, _O, "string", None),
                           ("license_plate", 3, _O, "string", None)]),
    ("TranslatedString", [("translation", 1, _REP, "message", "Translation")]),
    ("Translation", [("text", 1, _R, "string", None), ("language", 2, _O, "string", None)]),
]


def message_classes() -> dict:
    """Build (once per Python worker) the message classes of the feed."""
    global _CLASSES
    if _CLASSES is not None:
        return _CLASSES
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    fd = descriptor_pb2.FileDescriptorProto(name="movelake_gtfs_rt.proto", package="movelake_rt",
                                            syntax="proto2")
    for name, fields in _SCHEMA:
        m = fd.message_type.add(name=name)
        for fname, num, label, typ, tname in fields:
            f = m.field.add(name=fname, number=num, label=label, type=_T[typ])
            if tname:
                f.type_name = f".movelake_rt.{tname}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(fd)
    _CLASSES = {name: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"movelake_rt.{name}"))
                for name, _ in _SCHEMA}
    return _CLASSES


#: What one payload decodes to, by ``kind``: ``payload`` (one row, its counters), ``vehicle`` (entities with a vehicle and
#: a position), ``alert``, ``stop`` (stop-time updates) and ``reject`` (one row with a reason, nothing else).
DECODED = ("source string, endpoint string, cycle_ts timestamp, seq long, kind string, feed_ts long, entity_id string, "
           "vehicle struct<ts:bigint,vehicle_id:string,trip_id:string,route_id:string,latitude:float,longitude:float,bearing:float,speed:float>, "
           "alert struct<cause:int,effect:int,header_text:string,description_text:string>, "
           "stop struct<trip_id:string,route_id:string,stop_sequence:bigint,stop_id:string,arrival_delay:int,departure_delay:int>, "
           "payload struct<bytes:bigint,total_entities:bigint,vehicle_positions:bigint>, reason string")
#: What the rejects carry besides where they are wanted whole.
REJECTED = "status int, body binary"
PARTS = ("vehicle", "alert", "stop")
KEYS = ("source", "endpoint", "cycle_ts", "seq")


def _number(message: str, field: str) -> int:
    return next(num for name, fields in _SCHEMA if name == message for f, num, *_ in fields if f == field)


class _Reader:
    """Entities of some payloads, read by columns straight from their bytes."""

    def __init__(self, bodies: list[bytes]):
        self.data = np.frombuffer(b"".join(bodies), "u1")
        begin = np.cumsum([0, *map(len, bodies)])
        number, found, odd = _number("FeedMessage", "entity"), [], []
        for i, b in enumerate(bodies):
            try:
                found.append(wire.one_by_one(b, number))
            except wire.Unusual:
                odd.append(i)
        if odd:
            raise wire.Unusual("group", begin[odd])
        self.count = np.array([len(x) for x, _ in found], "i8")
        self.payload = np.repeat(np.arange(len(bodies)), self.count)  # of each entity
        start, end = (np.concatenate([x[k] + at for x, at in zip(found, begin)]) for k in (0, 1))
        self.entity = self.within("FeedEntity", start, end, ("id",), ("vehicle", "alert", "trip_update"))

    def within(self, message: str, start, end, single=(), messages=(), repeated=()) -> dict:
        number = {f: _number(message, f) for f in (*single, *messages, *repeated)}
        found = wire.fields(self.data, start.astype("i8"), end, {number[f] for f in single}, {number[f] for f in messages}, {number[f] for f in repeated})
        return {f: found[n] for f, n in number.items()}

    def sub(self, parent: tuple, message: str, single=(), messages=(), repeated=()) -> dict:
        """Fields of a sub-message; where it is not set, none is."""
        has, start, end = parent
        return self.within(message, start, end * has, single, messages, repeated)

    def text(self, field: tuple):
        return wire.texts(self.data, *field)

    def number(self, field: tuple, dtype: str):
        return wire.numbers(self.data, field[0], field[1], dtype)

    def vehicles(self):
        v = self.sub(self.entity["vehicle"], "VehiclePosition", ("timestamp",), ("trip", "vehicle", "position"))
        keep = v["position"][0].nonzero()[0]
        v = {k: tuple(x[keep] for x in f) for k, f in v.items()}
        trip = self.sub(v["trip"], "TripDescriptor", ("trip_id", "route_id"))
        named = self.sub(v["vehicle"], "VehicleDescriptor", ("id",))
        p = self.sub(v["position"], "Position", ("latitude", "longitude", "bearing", "speed"))
        return keep, {"ts": self.number(v["timestamp"], "i8"), "vehicle_id": self.text(named["id"]), "trip_id": self.text(trip["trip_id"]),
                      "route_id": self.text(trip["route_id"]), **{k: self.number(f, "f4") for k, f in p.items()}}

    def alerts(self):
        keep = self.entity["alert"][0].nonzero()[0]
        a = self.sub(tuple(x[keep] for x in self.entity["alert"]), "Alert", ("cause", "effect"), ("header_text", "description_text"))

        def first(field):
            owner, start, end = self.sub(field, "TranslatedString", repeated=("translation",))["translation"]
            at = np.flatnonzero(np.diff(owner, prepend=-1))
            has, s, e = (np.zeros(len(keep), t) for t in ("?", "i8", "i8"))
            has[owner[at]], s[owner[at]], e[owner[at]] = True, start[at], end[at]
            return self.text(self.sub((has, s, e), "Translation", ("text",))["text"])

        return keep, {"cause": self.number(a["cause"], "i4"), "effect": self.number(a["effect"], "i4"),
                      "header_text": first(a["header_text"]), "description_text": first(a["description_text"])}

    def stops(self):
        u = self.sub(self.entity["trip_update"], "TripUpdate", (), ("trip",), ("stop_time_update",))
        owner, start, end = u["stop_time_update"]
        trip = self.sub(u["trip"], "TripDescriptor", ("trip_id", "route_id"))
        trip = {k: tuple(x[owner] for x in f) for k, f in trip.items()}
        s = self.within("StopTimeUpdate", start, end, ("stop_sequence", "stop_id"), ("arrival", "departure"))
        delay = {k: self.number(self.sub(s[k], "StopTimeEvent", ("delay",))["delay"], "i4") for k in ("arrival", "departure")}
        return owner, {"trip_id": self.text(trip["trip_id"]), "route_id": self.text(trip["route_id"]), "stop_sequence": self.number(s["stop_sequence"], "i8"),
                       "stop_id": self.text(s["stop_id"]), "arrival_delay": delay["arrival"], "departure_delay": delay["departure"]}


_READ = {"vehicle": _Reader.vehicles, "alert": _Reader.alerts, "stop": _Reader.stops}


def _read(feeds: list[tuple], parts: tuple[str, ...]):
    """(kind, payload of each row, feed times of the payloads, entity ids,
    columns) of payloads (place, body, parsed feed). Payloads that cannot be
    read as they are are taken out, all that a column finds at once, and the
    others read again: as often as there are columns, not payloads."""
    try:
        reader = _Reader([body for _, body, _ in feeds])
        positions = reader.vehicles()
        out = {k: positions if k == "vehicle" else _READ[k](reader) for k in parts}
        names = {k: reader.text(tuple(x[entities] for x in reader.entity["id"])) for k, (entities, _) in out.items()}
    except (wire.Unusual, UnicodeDecodeError) as e:
        begin = np.cumsum([0, *(len(body) for _, body, _ in feeds)])
        # the last payload that begins there is the one that is not empty
        odd = set((np.searchsorted(begin, e.places, "right") - 1).tolist())
        rest = [f for i, f in enumerate(feeds) if i not in odd]
        if rest:
            yield from _read(rest, parts)
        if isinstance(e, wire.Unusual):  # written again by the parser, sub-messages merged and unknown groups left out
            again = []
            for i in sorted(odd):
                at, _, feed = feeds[i]
                feed.DiscardUnknownFields()
                again.append((at, feed.SerializeToString(), feed))
            yield from _read(again, parts)
        else:
            yield "reject", np.array([feeds[i][0] for i in sorted(odd)]), None, None, {}
        return
    place = np.array([at for at, _, _ in feeds], "i8")
    times = np.array([feed.header.timestamp for _, _, feed in feeds], "u8").view("i8")  # the signed numbers of the same bits
    counts = {"bytes": np.array([len(b) for _, b, _ in feeds], "i8"), "total_entities": reader.count,
              "vehicle_positions": np.bincount(reader.payload[positions[0]], minlength=len(feeds))}
    yield "payload", place, times, None, {k: pa.array(n) for k, n in counts.items()}
    for k, (entities, columns) in out.items():
        owner = reader.payload[entities]
        yield k, place[owner], times[owner], names[k], columns


def _decoded(bodies: list[bytes | None], parts: tuple[str, ...]):
    """The parser says which payloads are any, as strictly as it does; the values
    are then read by columns. One that does not parse is a ``reject``."""
    from google.protobuf.message import DecodeError
    cls, feeds, bad = message_classes()["FeedMessage"], [], []
    for i, body in enumerate(bodies):
        try:
            feeds.append((i, body or b"", cls.FromString(body or b"")))
        except DecodeError:
            bad.append(i)
    if bad:
        yield "reject", np.array(bad), None, None, {}
    if feeds:
        yield from _read(feeds, parts)


def decode(landed_bin: DataFrame, parts: tuple[str, ...] = PARTS, rows: int = 65_536, together: int = 32 << 20, rejects: bool = False) -> DataFrame:
    """landed(source, endpoint, cycle_ts, seq, status, body binary), 2xx only ->
    tagged rows (``DECODED``), each payload decoded once for all that is wanted
    of it. Entities go straight into Arrow columns; small payloads are read
    ``together`` (bytes), and records are cut at ``rows``. The nested feed never
    leaves the task. With ``rejects`` the failed responses are rejects too
    (``http_status``), and each reject carries its status and body, so that the
    landed payloads need not be read again for them."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ship_package(landed_bin.sparkSession)
    taken = landed_bin.where(F.col("status").isNotNull() if rejects else F.col("status").between(200, 299)).select(*KEYS, F.col("body").cast("binary"), F.col("status").cast("int"))
    ddl = f"{DECODED}, {REJECTED}" if rejects else DECODED
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    n_keys = len(KEYS)

    def record(batch, kind, of, times, ids, columns, reason="corrupt"):
        n, at = len(of), pa.array(of)
        own = {c: batch.column(j).take(at) for j, c in enumerate(KEYS)} | {"kind": pa.array([kind] * n)}
        if kind == "reject":
            own |= {"reason": pa.array([reason] * n), "body": batch.column(n_keys).take(at), "status": batch.column(n_keys + 1).take(at)}
        else:
            fields = schema.field(kind).type
            own["feed_ts"] = pa.array(times)
            own[kind] = pa.StructArray.from_arrays([columns[f.name].cast(f.type) for f in fields], fields=list(fields))
        if ids is not None:
            own["entity_id"] = ids
        return pa.RecordBatch.from_arrays([own[f.name].cast(f.type) if f.name in own else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        for whole in batches:
            if rejects:
                status = whole.column(n_keys + 1)
                ok = pc.and_(pc.greater_equal(status, 200), pc.less_equal(status, 299))
                failed = np.flatnonzero(~ok.to_numpy(zero_copy_only=False))
                if len(failed):
                    yield record(whole, "reject", failed, None, None, {}, "http_status")
                    whole = whole.filter(ok)
            ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column(n_keys)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < whole.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + together, "right")))
                batch = whole.slice(at, to - at)
                for found in _decoded(batch.column(n_keys).to_pylist(), parts):
                    if len(found[1]):
                        r = record(batch, *found)
                        yield from (r.slice(k, rows) for k in range(0, r.num_rows, rows))
                at = to

    return taken.mapInArrow(run, ddl)


VP_COLS = ["timestamp", "feed_timestamp", "vehicle_id", "trip_id", "route_id", "latitude", "longitude",
           "bearing", "speed"]


def vehicle_positions(decoded: DataFrame) -> DataFrame:
    """SRC-13: entities with a vehicle and a position; timestamp ladder
    (entity time, 0 kept; else feed time if > 0; else the collector's
    clock); float coordinates widened to double. ``is_deleted`` is not
    consulted."""
    v = lambda c: F.col("vehicle")[c]
    return decoded.where("kind = 'vehicle'").select(
        R.entity_time(v("ts"), F.col("feed_ts"), F.col("cycle_ts")).alias("timestamp"),
        F.col("feed_ts").alias("feed_timestamp"), *[v(c).alias(c) for c in ("vehicle_id", "trip_id", "route_id")],
        R.widen_float(v("latitude")).alias("latitude"), R.widen_float(v("longitude")).alias("longitude"),
        v("bearing").alias("bearing"), v("speed").alias("speed"))


def norm_vehicle_positions(landed_bin: DataFrame) -> DataFrame:
    return vehicle_positions(decode(landed_bin, ("vehicle",)))


def rejected_payloads(decoded: DataFrame, landed_bin: DataFrame | None = None) -> DataFrame:
    """DQ-1: payloads that failed (``http_status``) or did not decode
    (``corrupt``), with their bodies (base64) for replay. Decoding told which;
    it gives them whole (``decode(rejects=True)``), or their bodies are looked
    up in ``landed_bin`` by the payload's key."""
    body = F.base64(F.col("body").cast("binary")).alias("body")
    if landed_bin is None:
        return decoded.where("kind = 'reject'").select(*KEYS, "status", body, "reason")
    bad_status = landed_bin.where(~F.col("status").between(200, 299)).select(*KEYS, "status", body, F.lit("http_status").alias("reason"))
    bad = decoded.where("kind = 'reject'").select(*KEYS, "reason").distinct()
    ok = landed_bin.where(F.col("status").between(200, 299)).select(*KEYS, "status", body)
    return bad_status.unionByName(ok.join(bad, list(KEYS)).select(*KEYS, "status", "body", "reason"))


def feed_counters(landed_bin: DataFrame) -> DataFrame:
    """AGG-14: per payload, total entities and vehicle positions found (rows
    stored are counted by the write: ``jobs.ingest``)."""
    return decode(landed_bin, ()).where("kind = 'payload'").select("cycle_ts", "seq", "payload.total_entities", "payload.vehicle_positions")


def _enum_name(code, names: dict, default: int):
    m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return m[F.coalesce(code, F.lit(default))]


def service_alerts(decoded: DataFrame) -> DataFrame:
    """EXT-1 (our rule; the reference never writes alerts): id, first
    translation of header and description, cause/effect enum names (proto2
    defaults UNKNOWN_CAUSE / UNKNOWN_EFFECT when absent)."""
    return decoded.where("kind = 'alert'").select(
        F.col("cycle_ts").alias("timestamp"), F.col("entity_id").alias("alert_id"), "alert.header_text", "alert.description_text",
        _enum_name(F.col("alert.cause"), ALERT_CAUSE, 1).alias("cause"), _enum_name(F.col("alert.effect"), ALERT_EFFECT, 8).alias("effect"))


def norm_service_alerts(landed_bin: DataFrame) -> DataFrame:
    return service_alerts(decode(landed_bin, ("alert",)))


def trip_updates(decoded: DataFrame) -> DataFrame:
    """EXT-2: one row per stop-time update (no target table in the reference)."""
    return decoded.where("kind = 'stop'").select(F.col("cycle_ts").alias("timestamp"), "entity_id", "stop.*")


def norm_trip_updates(landed_bin: DataFrame) -> DataFrame:
    return trip_updates(decode(landed_bin, ("stop",)))
