"""The ingest job end to end through its command-line entry point."""

from movelake import jobs
from movelake.operators import sinks
from movelake.session import scratch_path
from movelake.sources import aircraft, landed, payloads

SF = "/root/testdata/sf0.001"


def test_ingest_cli_private_feeder(spark, capsys):
    land = scratch_path(spark, "j_landed")
    landed.land_private(spark, SF).write.parquet(land)
    table, dl, met = (scratch_path(spark, n) for n in ("j_table", "j_dead", "j_metrics"))
    jobs.main(["--feed", "private_feeder", "--landed", land, "--table", table,
               "--dead-letter", dl, "--metrics", met])
    L = spark.read.parquet(land)
    want_rows = aircraft.norm_private_feeder(L).count()
    want_rejected = payloads.rejected(L, aircraft.PRIVATE_DOC).count()
    assert sinks.read_table(spark, table, "flights").count() == want_rows
    assert spark.read.json(dl).count() == want_rejected > 0
    m = spark.read.parquet(met).first()
    assert (m.table, m.rows) == ("flights", want_rows)
    assert f"'rows': {want_rows}" in capsys.readouterr().out


def test_every_feed_ingests(spark):
    """Each entry of the job registry writes exactly its normaliser's rows."""
    builders = {
        "state_vectors": landed.land_state_vectors,
        "adsb_endpoints": lambda s, sf: landed.land_adsb(s, sf, "adsb_endpoints"),
        "adsb_regions": lambda s, sf: landed.land_adsb(s, sf, "adsb_regions"),
        "adsb_types": lambda s, sf: landed.land_adsb(s, sf, "adsb_types"),
        "adsb_snapshot": lambda s, sf: landed.land_adsb(s, sf, "adsb_snapshot"),
        "private_feeder": landed.land_private,
        "ship_frames": landed.land_ship_frames,
        "board_ch": landed.land_board_ch,
        "board_be": landed.land_board_be,
        "board_at": landed.land_board_at,
        "orbits": landed.land_orbits,
        "gtfs_rt": landed.land_gtfs,
    }
    assert set(builders) == set(jobs.FEEDS)
    stations = landed.station_dim(spark, SF)
    for feed, build in builders.items():
        L = build(spark, SF)
        table, normalise, _ = jobs.FEEDS[feed]
        path = scratch_path(spark, f"j_{feed}")
        res = jobs.ingest(spark, feed, L, path, stations, dead_letter_path=scratch_path(spark, f"d_{feed}"))
        want = normalise(L, stations).count()
        assert res["rows"] == want == sinks.read_table(spark, path, table).count(), feed
