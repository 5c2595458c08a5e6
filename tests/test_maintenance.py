"""Table maintenance on a written table: retention drops, compaction,
idempotent micro-batch writes."""

import datetime as dt

from pyspark.sql import functions as F

from movelake.operators import layout, ledger, sinks
from movelake.session import scratch_path
from movelake.sources import standin
from movelake.streaming.streams import write_batch

SF = "/root/testdata/sf0.001"


def _flights_table(spark):
    path = scratch_path(spark, "m_flights")
    f = standin.flights(spark, SF)
    sinks.append(f, path, "flights")
    return f, path


def test_drop_chunks_keeps_recent(spark):
    f, path = _flights_table(spark)
    as_of = dt.datetime(2024, 1, 31)
    dropped = layout.drop_chunks(spark, path, "flights", as_of, days=7)
    assert dropped and all(d < "2024-01-24" for d in dropped)
    back = sinks.read_table(spark, path, "flights")
    want = f.where(F.to_date("timestamp") >= F.lit("2024-01-24")).count()
    assert back.count() == want
    assert layout.drop_chunks(spark, path, "flights", as_of, days=None) == []


def test_compact_chunks_rewrites_due_only(spark):
    f, path = _flights_table(spark)
    before = {(r.chunk, r.source): r.n for r in
              sinks.read_table(spark, path, "flights").groupBy("chunk", "source").agg(F.count("*").alias("n")).collect()}
    due = layout.compact_chunks(spark, path, "flights", dt.datetime(2024, 1, 31))
    assert due and max(due) <= "2024-01-23"
    after = sinks.read_table(spark, path, "flights")
    got = {(r.chunk, r.source): r.n for r in after.groupBy("chunk", "source").agg(F.count("*").alias("n")).collect()}
    assert got == before
    # inside each compacted file rows are clustered by segment, newest first
    import glob
    import pyarrow.parquet as pq
    for fpath in glob.glob(f"{path}/chunk={due[0]}/*.parquet"):
        t = pq.read_table(fpath, columns=["source", "timestamp"]).to_pylist()
        keys = [(r["source"], -r["timestamp"].timestamp()) for r in t]
        assert keys == sorted(keys)


def test_replayed_micro_batch_does_not_duplicate(spark):
    s = standin.ships(spark, SF).limit(50).persist()
    path = scratch_path(spark, "m_ships")
    assert [write_batch(s, path, "ships", b) for b in (7, 7, 8)] == [50, 0, 50]  # the second is a replay
    assert sinks.read_table(spark, path, "ships").count() == 100
    assert {(r.batch, r.rows) for r in ledger.entries(spark, path).collect()} == {("7", 50), ("8", 50)}


def test_seven_day_chunks_align_to_epoch(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 0),), (dt.datetime(2024, 1, 3, 23, 0),),
                                (dt.datetime(2024, 1, 4, 0, 0),)], "ts timestamp")
    got = [r.c for r in df.select(layout.chunk_of("ts", 7).alias("c")).collect()]
    assert got == [dt.date(2023, 12, 28), dt.date(2023, 12, 28), dt.date(2024, 1, 4)]


def test_drop_chunks_uses_seven_day_chunk_end(spark):
    s = standin.satellites(spark, SF)
    path = scratch_path(spark, "m_sat")
    sinks.append(s, path, "satellites")
    chunks = layout.list_chunks(spark, path)
    first = dt.datetime.fromisoformat(chunks[0])
    # cutoff exactly at the first chunk's end drops it; one second earlier keeps it
    kept = layout.drop_chunks(spark, path, "satellites", first + dt.timedelta(days=7, seconds=-1), days=0)
    assert kept == []
    dropped = layout.drop_chunks(spark, path, "satellites", first + dt.timedelta(days=7), days=0)
    assert dropped == [chunks[0]]
