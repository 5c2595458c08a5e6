"""Ingest jobs: one feed's landed payloads -> its table, in one run.

The Spark counterpart of fetching a source once: read the landed batch
(persisted so it is read once), normalise it, append the rows (chunk
layout, rows-written metric), and route rejected documents to the dead
letter. Runs as ``python -m movelake.jobs --feed ... --landed ... --table ...``
(``spark-submit --py-files movelake.zip movelake/jobs.py ...`` on a cluster)
or from Python via :func:`ingest`.
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from movelake.operators import sinks
from movelake.schemas import LANDED
from movelake.sources import aircraft, dims, gtfs, orbits, payloads, rail, ships

def _rejects(doc):
    return lambda L: payloads.rejected(L, doc)


# feed -> (table, normaliser(landed, stations) -> rows, rejected(landed) -> rows)
FEEDS = {
    "state_vectors": ("flights", lambda L, st: aircraft.norm_state_vectors(L), _rejects(aircraft.STATE_DOC)),
    "adsb_endpoints": ("flights", lambda L, st: aircraft.norm_adsb_endpoints(L), aircraft.rejected_adsb),
    "adsb_regions": ("flights", lambda L, st: aircraft.norm_adsb_regions(L), aircraft.rejected_adsb),
    "adsb_types": ("flights", lambda L, st: aircraft.norm_adsb_types(L), aircraft.rejected_adsb),
    "adsb_snapshot": ("flights", lambda L, st: aircraft.norm_adsb_snapshot(L), aircraft.rejected_adsb),
    "private_feeder": ("flights", lambda L, st: aircraft.norm_private_feeder(L), _rejects(aircraft.PRIVATE_DOC)),
    "ship_frames": ("ships", lambda L, st: ships.norm_ship_messages(L, keep_seq=False), _rejects(ships.SHIP_DOC)),
    "board_ch": ("departures", lambda L, st: rail.norm_departures_ch(L, st), _rejects(rail.CH_DOC)),
    "board_be": ("departures", lambda L, st: rail.norm_departures_be(L, st), _rejects(rail.BE_DOC)),
    "board_at": ("departures", lambda L, st: rail.norm_departures_at(L, st), _rejects(rail.AT_DOC)),
    "orbits": ("satellites", lambda L, st: orbits.norm_orbital_elements(L), orbits.rejected_orbits),
    "gtfs_rt": ("vehicle_positions", lambda L, st: gtfs.norm_vehicle_positions(L), lambda L: gtfs.rejected_payloads(gtfs.decode(L, (), rejects=True))),
}
BINARY_FEEDS = {"gtfs_rt"}
_ADSB = {f: aircraft.ADSB_DOC for f in ("adsb_endpoints", "adsb_regions", "adsb_types", "adsb_snapshot")}
_DOCS = _ADSB | {"state_vectors": aircraft.STATE_DOC, "private_feeder": aircraft.PRIVATE_DOC, "ship_frames": ships.SHIP_DOC,
                 "board_ch": rail.CH_DOC, "board_be": rail.BE_DOC, "board_at": rail.AT_DOC}


def parsed_once(feed: str, landed: DataFrame) -> DataFrame:
    """What rows, rejects and counts of a JSON feed all come from."""
    return orbits.parse_orbits(landed) if feed == "orbits" else payloads.parse_all(landed, _DOCS[feed])


# documents that a feed's own rule rejects
REJECT_RULES = {f: (aircraft.both_keys, "corrupt") for f in _ADSB} | {"orbits": (orbits.missing_required, "missing_required")}


def _n(array, leaves_out):
    return F.size(F.filter(array, leaves_out))


def record_rules(feed: str) -> dict:
    """DQ-2: the rules by which a feed leaves out records of accepted documents,
    as counts in ``doc`` (a record counts under the first rule that it meets)."""
    ac = F.coalesce(F.col("doc.ac"), F.col("doc.aircraft"), F.array())
    nowhere = lambda a: a["lat"].isNull() | a["lon"].isNull()
    one_key = ~aircraft.both_keys()
    rules = {
        "state_vectors": {"short_record": _n(F.coalesce("doc.states", F.array()), lambda s: F.coalesce(F.size(s), F.lit(0)) < 17)},
        "adsb_endpoints": {"no_id": F.when(one_key, _n(ac, lambda a: a["hex"].isNull()))},
        "adsb_snapshot": {"no_position": F.when(one_key, _n(ac, nowhere))},
        "private_feeder": {"missing_required": _n(F.coalesce("doc.aircraft", F.array()), lambda a: a["hex"].isNull() | nowhere(a))},
        "ship_frames": {"no_metadata": F.col("doc.MetaData").isNull().cast("int")},
        "board_ch": {"no_stop": _n(F.coalesce("doc.stationboard", F.array()), lambda e: e["stop"].isNull())},
    }
    both = {"no_position": F.when(one_key, _n(ac, nowhere)), "no_id": F.when(one_key, _n(ac, lambda a: a["hex"].isNull() & ~nowhere(a)))}
    return (rules | {"adsb_regions": both, "adsb_types": both}).get(feed, {})


def left_out(feed: str, landed: DataFrame) -> DataFrame:
    """DQ-2 for any feed, landed or parsed: (source, level, reason, rows)."""
    if feed in BINARY_FEEDS:
        counts = [F.struct(F.lit("document").alias("level"), F.lit(k).alias("reason"), F.count_if(F.col("reason") == k).alias("rows")) for k in ("http_status", "corrupt")]
        lost = F.sum(F.col("payload.total_entities") - F.col("payload.vehicle_positions"))  # NULL for rejects
        counts.append(F.struct(F.lit("record").alias("level"), F.lit("no_position").alias("reason"), F.coalesce(lost, F.lit(0)).alias("rows")))
        # one decoding for all three
        return gtfs.decode(landed, (), rejects=True).groupBy("source").agg(F.array(*counts).alias("counts")).select("source", F.inline("counts")).where("rows > 0")
    rule = REJECT_RULES.get(feed)
    parsed = landed if payloads.CORRUPT in landed.columns else parsed_once(feed, landed)
    return payloads.left_out(parsed, record_rules(feed), (rule[0](), rule[1]) if rule else None)


def station_list(spark: SparkSession, feed: str) -> DataFrame | None:
    """The fixed list of a departure-board feed; None for other feeds."""
    return dims.stations(spark, feed.removeprefix("board_")) if feed.startswith("board_") else None


def ingest(spark: SparkSession, feed: str, landed: DataFrame, table_path: str,
           stations: DataFrame | None = None, dead_letter_path: str | None = None,
           metrics_path: str | None = None, as_of=None, run: str | None = None, alerts_path: str | None = None) -> dict:
    """Normalise and append one landed batch, each document parsed once:
    {'rows': n, 'rejected': m, 'dropped': {reason: records}}, and for a protobuf
    feed its 'counters'. With ``run`` (a name of this batch) the rows are
    appended once, however often the job is run again under it. Boards take the
    feed's own station list unless ``stations`` is given; ``alerts_path`` also
    stores a protobuf feed's alerts ('alerts' rows), from the same decoding."""
    table, normalise, reject = FEEDS[feed]
    stations = station_list(spark, feed) if stations is None else stations
    batch = landed.persist(StorageLevel.MEMORY_AND_DISK)
    kinds = ("vehicle",) if alerts_path is None else ("vehicle", "alert")
    parsed = (gtfs.decode(batch, kinds) if feed in BINARY_FEEDS else parsed_once(feed, batch)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = gtfs.vehicle_positions(parsed) if feed in BINARY_FEEDS else normalise(parsed, stations)
        n = sinks.append(rows, table_path, table, as_of=as_of, metrics_path=metrics_path, writer=f"run-{feed}" if run else None, batch=run)
        out = {"rows": n, "rejected": 0}
        if feed in BINARY_FEEDS and alerts_path is not None:
            out["alerts"] = sinks.append(gtfs.service_alerts(parsed), alerts_path, "service_alerts", as_of=as_of, metrics_path=metrics_path,
                                         writer=f"run-{feed}" if run else None, batch=run)
        if dead_letter_path is not None:
            out["rejected"] = payloads.dead_letter(gtfs.rejected_payloads(parsed, batch) if feed in BINARY_FEEDS else reject(parsed), dead_letter_path)
        if feed in BINARY_FEEDS:
            c = parsed.where("kind = 'payload'").agg(F.count("*").alias("payloads"), *[F.coalesce(F.sum(f"payload.{k}"), F.lit(0)).alias(k)
                                                     for k in ("bytes", "total_entities", "vehicle_positions")]).first().asDict()
            out |= {"counters": c | {"inserted": n}, "dropped": {"no_position": c["total_entities"] - c["vehicle_positions"]}}
        else:
            out["dropped"] = {r.reason: r.rows for r in left_out(feed, parsed).where("level = 'record'").collect()}  # a row per source and rule
        return out
    finally:
        parsed.unpersist()
        batch.unpersist()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Ingest one feed's landed payloads into its table.")
    ap.add_argument("--feed", required=True, choices=sorted(FEEDS))
    ap.add_argument("--landed", required=True, help="landed payloads (parquet or json)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json"])
    ap.add_argument("--table", required=True, help="table path (chunk-partitioned parquet)")
    ap.add_argument("--stations", help="station list (parquet: endpoint, station_name) in place of a board feed's own")
    ap.add_argument("--alerts", help="service_alerts table path (protobuf feed)")
    ap.add_argument("--dead-letter")
    ap.add_argument("--metrics")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"movelake-ingest-{a.feed}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.read if a.format == "parquet" else spark.read.schema(LANDED)
    landed = reader.format(a.format).load(a.landed)
    st = spark.read.parquet(a.stations) if a.stations else None
    print(ingest(spark, a.feed, landed, a.table, st, a.dead_letter, a.metrics, alerts_path=a.alerts))


if __name__ == "__main__":
    main()
