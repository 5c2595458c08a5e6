"""Ship stream with a processing-time trigger while files keep landing."""

from pyspark.sql import functions as F

from movelake.operators import ledger
from movelake.operators.dedup import dedup_pings
from movelake.operators.sinks import read_table
from movelake.session import scratch_path
from movelake.sources import landed, ships
from movelake.streaming import streams

SF = "/root/testdata/sf0.001"


def test_continuous_ship_stream_picks_up_new_files(spark):
    frames = landed.land_ship_frames(spark, SF)
    first = frames.where(F.col("seq") % 2 == 0)
    second = frames.where(F.col("seq") % 2 == 1)
    land = scratch_path(spark, "s_landing")
    opts = {"timestampFormat": streams.TS_FORMAT}
    first.write.options(**opts).json(f"{land}/a")
    out, ck = scratch_path(spark, "s_ships"), scratch_path(spark, "s_ck")
    q = streams.stream_ships(spark, f"{land}/*", out, ck, trigger=streams.FLUSH_INTERVAL, max_files=None)
    try:
        q.processAllAvailable()
        second.write.options(**opts).json(f"{land}/b")
        q.processAllAvailable()
    finally:
        q.stop()
    got = read_table(spark, out, "ships")
    # each half was its own micro-batch: de-dup within each batch, as the reference does
    want = (dedup_pings(ships.norm_ship_messages(first), "seq").count()
            + dedup_pings(ships.norm_ship_messages(second), "seq").count())
    assert got.count() == want
    batches = ledger.entries(spark, out).collect()  # the streams' rows-written metric
    assert len(batches) >= 2 and sum(r.rows for r in batches) == want and all(r.elapsed_s > 0 for r in batches)


def test_stall_watch_gaps_across_batches_and_silence(spark):
    import datetime as dt
    base = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)

    def rows(pairs):
        return spark.createDataFrame([(t, base + dt.timedelta(seconds=s)) for t, s in pairs],
                                     "table string, ingested_at timestamp")

    land = scratch_path(spark, "w_landing")
    rows([("A", 0), ("A", 10), ("A", 20), ("B", 0), ("B", 50)]).write.parquet(f"{land}/1")
    src = spark.readStream.schema("table string, ingested_at timestamp").parquet(f"{land}/*")
    out, ck = scratch_path(spark, "w_out"), scratch_path(spark, "w_ck")
    q = streams.run_to_parquet(streams.stall_watch(src, gap_s=120), out, ck, trigger="1 second")
    try:
        q.processAllAvailable()
        rows([("A", 400), ("B", 2000)]).write.parquet(f"{land}/2")
        q.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.table, r.kind, r.gap_seconds) for r in spark.read.parquet(out).collect()}
    assert ("A", "gap", 380) in got and ("B", "gap", 1950) in got
    assert ("A", "silence", None) in got
    assert not any(t == "B" and k == "silence" for t, k, _ in got)


def test_stream_feed_first_wins_across_batches(spark):
    import datetime as dt
    from movelake.schemas import LANDED
    cyc = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)
    land = scratch_path(spark, "f_landing")
    opts = {"timestampFormat": streams.TS_FORMAT}
    spark.createDataFrame([("adsb_endpoints", "ladd", cyc, 0, 200, '{"ac":[{"hex":"a1","gs":1.0}]}')],
                          LANDED).write.options(**opts).json(f"{land}/1")
    out, ck = scratch_path(spark, "f_out"), scratch_path(spark, "f_ck")
    q = streams.stream_feed(spark, f"{land}/*", "adsb_endpoints", out, ck, trigger="1 second")
    try:
        q.processAllAvailable()
        spark.createDataFrame(
            [("adsb_endpoints", "mil", cyc, 1_000_000_000, 200,
              '{"ac":[{"hex":"a1","gs":2.0},{"hex":"a2","gs":3.0}]}')],
            LANDED).write.options(**opts).json(f"{land}/2")
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.icao24: r.velocity for r in spark.read.parquet(out).collect()}
    assert got == {"a1": 1.0, "a2": 3.0}


def test_watermark_dedup_across_batches(spark):
    import datetime as dt
    from movelake.schemas import LANDED
    t0 = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)

    def frame(seq, lat, ts):
        body = ('{"MessageType":"PositionReport","MetaData":{"MMSI":111,"ShipName":"X",'
                f'"latitude":{lat},"longitude":10.0}}}}')
        return ("ship_stream", "stream", ts, seq, 200, body)

    land = scratch_path(spark, "d_landing")
    opts = {"timestampFormat": streams.TS_FORMAT}
    spark.createDataFrame([frame(0, 50.0, t0)], LANDED).write.options(**opts).json(f"{land}/1")
    out, ck = scratch_path(spark, "d_out"), scratch_path(spark, "d_ck")
    q = streams.run_to_parquet(streams.dedup_stream(spark, f"{land}/*"), out, ck, trigger="1 second")
    try:
        q.processAllAvailable()
        # same ping 4e-7 deg away (same 1e-5 cell, same second) in a later batch, and a new ping
        spark.createDataFrame([frame(1, 50.0000004, t0), frame(2, 50.001, t0 + dt.timedelta(seconds=30))],
                              LANDED).write.options(**opts).json(f"{land}/2")
        q.processAllAvailable()
    finally:
        q.stop()
    lats = sorted(r.latitude for r in spark.read.parquet(out).collect())
    assert lats == [50.0, 50.001]


def test_writers_of_one_table_keep_each_others_rows(spark, tmp_path):
    from movelake.sources import landed
    from movelake.streaming.streams import stream_feed

    table, n = str(tmp_path / "flights"), 0
    for run, feed in enumerate(("adsb_endpoints", "adsb_endpoints", "state_vectors")):
        make = landed.land_state_vectors(spark, "/root/testdata/sf0.001") if feed == "state_vectors" else landed.land_adsb(spark, "/root/testdata/sf0.001", feed)
        make.coalesce(1).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(str(tmp_path / f"in{run}"))
        stream_feed(spark, str(tmp_path / f"in{run}"), feed, table, str(tmp_path / f"ck{run}"), trigger=None).awaitTermination()
        rows = spark.read.parquet(table).count()
        # the second run holds the first one's rows again, which first-wins drops; the other feed's are all new
        assert rows == n if run == 1 else rows > n
        n = rows
