"""Structured Streaming jobs (STR-*, DED-5).

Sources are file streams over landed payloads (JSON lines in the shared
folder); a Kafka topic with the same columns plugs in the same way. Every
query has a checkpoint under the shared folder, so a lost executor or a
restarted driver resumes from the last committed batch.

Exactly-once output: jobs that fill a table publish each micro-batch under
(writer, batch id) by the table's ledger, so a replayed batch adds nothing, and
any number of streams, batch appends and compactions share one table. Jobs that
write results of their own use the Parquet file sink, whose commit log is
idempotent.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from movelake.functions.rules import latency_ms
from movelake.operators.dedup import dedup_pings, dedup_pings_stream
from movelake.operators.layout import with_chunk
from movelake.operators.sinks import append, read_table
from movelake.schemas import LANDED, LANDED_BINARY
from movelake.sources.ships import norm_ship_messages

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # landed JSON keeps microseconds
FLUSH_ROWS = 500          # a batch is flushed at 500 rows ...
FLUSH_INTERVAL = "3 seconds"  # ... or after 3 s, whichever first


def landed_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None,
                  fmt: str = "json", binary: bool = False) -> DataFrame:
    """Landed payloads as they come; ``binary`` ones (protobuf) are Parquet."""
    r = spark.readStream.schema(LANDED_BINARY if binary else LANDED).format("parquet" if binary else fmt).option("timestampFormat", TS_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing_dir)


def payload_files(spark: SparkSession, landing_dir: str, source: str, max_files: int | None = None, glob: str = "*.pb") -> DataFrame:
    """Binary payloads as plain files, one response each, as a stream of landed
    rows: the folder is the endpoint, the file's time the cycle. A file that is
    there was a success."""
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
         .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing_dir).select(F.lit(source).alias("source"), F.element_at(F.split("path", "/"), -2).alias("endpoint"),
                                      F.col("modificationTime").alias("cycle_ts"), F.xxhash64("path").alias("seq"),
                                      F.lit(200).alias("status"), F.col("content").alias("body"))


def kafka_frames(spark: SparkSession, servers: str, topic: str, max_offsets: int = FLUSH_ROWS,
                 starting: str = "latest") -> DataFrame:
    """Ship frames from a Kafka topic in the ``landed`` shape. With
    ``trigger=FLUSH_INTERVAL`` this is the reference's flush rule: at most
    ``max_offsets`` messages per micro-batch, and a batch at least every
    3 s. Needs the Spark Kafka connector on the classpath (not bundled)."""
    k = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting)
              .option("maxOffsetsPerTrigger", max_offsets).load())
    return k.select(F.lit("ship_stream").alias("source"), F.col("topic").alias("endpoint"),
                    F.col("timestamp").alias("cycle_ts"), F.col("offset").alias("seq"),
                    F.lit(200).alias("status"), F.col("value").cast("string").alias("body"))


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def writer_of(checkpoint: str) -> str:
    """Identity of the stream that owns a checkpoint folder: batch ids count
    from 0 in each, so two streams (or one restarted on a new checkpoint) must
    not share names in the ledger."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def write_batch(df: DataFrame, path: str, table: str, batch_id: int, writer: str = "none", metrics_path: str | None = None) -> int:
    """Idempotent micro-batch write: published once per (writer, batch_id); gives
    the rows written, 0 for a replay. SNK-9: the ledger's entry has the rows and
    seconds of the batch (``ledger.entries``); ``metrics_path`` adds them to
    ``ingest_metrics`` as a batch job does."""
    return append(df, path, table, metrics_path=metrics_path, writer=f"w{writer}", batch=batch_id, many_chunks=False)


def stream_ships(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                 trigger: str | None = FLUSH_INTERVAL, max_files: int | None = 1,
                 dedup: bool = True, metrics_path: str | None = None) -> StreamingQuery:
    """STR-1 / STR-2: parse ship frames, de-dup within each micro-batch
    (DED-1), append to ``ships``. ``trigger=None`` runs once over what is
    landed (the bounded one-shot collection, always de-duped)."""
    frames = landed_stream(spark, landing_dir, max_files)
    parsed = norm_ship_messages(frames)

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = dedup_pings(batch, order="seq") if (dedup or trigger is None) else batch
        write_batch(b.drop("seq"), table_path, "ships", batch_id, writer_of(checkpoint), metrics_path)

    w = parsed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def stream_snapshots(spark: SparkSession, landing_dir: str, normalise, table: str, table_path: str,
                     checkpoint: str, trigger: str | None = "300 seconds",
                     max_files: int | None = None, metrics_path: str | None = None) -> StreamingQuery:
    """STR-3: periodic snapshot ingest; ``normalise`` is a landed ->
    table-rows job (stateless)."""
    rows, writer = normalise(landed_stream(spark, landing_dir, max_files)), writer_of(checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, table_path, table, batch_id, writer, metrics_path)

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def rollup_counts(rows: DataFrame, window: str = "1 minute", watermark: str = "10 minutes",
                  keys=("source",), ts: str = "timestamp") -> DataFrame:
    """STR-4: windowed counts kept up to date; append mode emits a window
    once the watermark passes its end (late rows beyond it are dropped)."""
    return (rows.withWatermark(ts, watermark)
                .groupBy(F.window(ts, window).alias("w"), *keys)
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        *keys, "rows"))


def latency_windows(rows: DataFrame, window: str = "1 minute", watermark: str = "10 minutes",
                    threshold_ms: float = 2000.0, digits: int = 6) -> DataFrame:
    """STR-5: p99 ingest latency per window of ``ingested_at`` and alarm."""
    p = F.percentile(latency_ms("ingested_at", "timestamp"), F.lit(0.99))
    return (rows.withWatermark("ingested_at", watermark)
                .groupBy(F.window("ingested_at", window).alias("w"))
                .agg(p.alias("p99"), F.count(F.lit(1)).alias("samples"))
                .select(F.col("w.start").alias("window_start"), F.round("p99", digits).alias("p99_ms"),
                        "samples", (F.round("p99", digits) > threshold_ms).alias("alarm")))


def collapse_windows(rows: DataFrame, length: str = "300 seconds", slide: str = "60 seconds",
                     min_rows: int = 1000, watermark: str = "10 minutes",
                     ts: str = "ingested_at") -> DataFrame:
    """STR-6: sliding-window insert counts below ``min_rows``. Windows with
    no rows at all are never emitted; silence is caught by freshness."""
    return (rows.withWatermark(ts, watermark)
                .groupBy(F.window(ts, length, slide).alias("w"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .where(F.col("rows") < min_rows)
                .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rows"))


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                   mode: str = "append") -> StreamingQuery:
    w = (df.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint).outputMode(mode))
    return _trigger(w, trigger).start()


def dedup_stream(spark: SparkSession, landing_dir: str, watermark: str = "10 minutes",
                 max_files: int | None = None) -> DataFrame:
    """DED-5: ship pings de-duplicated across micro-batches; state is kept
    only within the watermark."""
    return dedup_pings_stream(norm_ship_messages(landed_stream(spark, landing_dir, max_files)), watermark)


# --- stall watchdog (custom stateful operator) ------------------------------------
STALL_OUT = "table string, gap_start timestamp, gap_end timestamp, gap_seconds long, kind string"
STALL_STATE = "last long"


def _stall_fn(gap_s: int):
    import pandas as pd

    def silence(table, last):
        return pd.DataFrame({"table": [table], "gap_start": [pd.Timestamp(last, unit="s", tz="UTC")],
                             "gap_end": [pd.NaT], "gap_seconds": pd.array([None], dtype="Int64"),
                             "kind": ["silence"]})

    def fn(key, pdfs, state):
        table = key[0]
        if state.hasTimedOut:
            # the watermark passed last + gap with no newer insert: raise the
            # silence alarm once and keep `last` (no new timeout), so the
            # next insert still reports its gap
            (last,) = state.get
            state.update((last,))
            yield silence(table, last)
            return
        secs = sorted({int(s) for pdf in pdfs for s in pdf["sec"]})
        prev = state.get[0] if state.exists else None
        rows = []
        for s in secs:
            if prev is not None and s <= prev:
                continue  # late row behind what this key already saw
            if prev is not None and s - prev > gap_s:
                rows.append((table, prev, s))
            prev = s
        out = pd.DataFrame(rows, columns=["table", "a", "b"])
        yield pd.DataFrame({"table": out["table"],
                            "gap_start": pd.to_datetime(out["a"], unit="s", utc=True),
                            "gap_end": pd.to_datetime(out["b"], unit="s", utc=True),
                            "gap_seconds": pd.array(out["b"] - out["a"], dtype="Int64"),
                            "kind": ["gap"] * len(out)})
        if prev is not None:
            state.update((prev,))
            due_ms = (prev + gap_s) * 1000
            if due_ms > state.getCurrentWatermarkMs():
                state.setTimeoutTimestamp(due_ms)
            elif secs:
                yield silence(table, prev)  # already behind the watermark
    return fn


def stall_watch(inserts: DataFrame, gap_s: int = 120, watermark: str = "2 minutes",
                table_col: str = "table", ts: str = "ingested_at") -> DataFrame:
    """WIN-1 on a stream (STR): per table, every gap longer than ``gap_s``
    between consecutive inserts, across micro-batches (state = last insert
    second), plus one 'silence' row when the watermark passes the last
    insert + ``gap_s`` without a newer insert -- the case windows cannot
    report. A key's rows per micro-batch are bounded by the trigger limits."""
    from movelake.session import ship_package
    ship_package(inserts.sparkSession)
    rows = (inserts.select(F.col(table_col).alias("table"), F.col(ts).alias("ts"))
                   .withWatermark("ts", watermark)
                   .withColumn("sec", F.unix_seconds("ts")))
    return rows.groupBy("table").applyInPandasWithState(
        _stall_fn(gap_s), STALL_OUT, STALL_STATE, "append", "EventTimeTimeout")


# --- any feed as a stream (STR-3 with first-wins across micro-batches) ------------
# (cycle, aircraft) of one source, for the feeds that poll several endpoints per cycle; the others keep every row
DEDUP_KEYS = {feed: ["source", "timestamp", "icao24"] for feed in ("adsb_endpoints", "adsb_regions", "adsb_types")}


def stream_feed(spark: SparkSession, landing_dir: str, feed: str, table_path: str, checkpoint: str,
                trigger: str | None = "300 seconds", max_files: int | None = None,
                stations: DataFrame | None = None, first_wins: bool = True, metrics_path: str | None = None,
                landed: DataFrame | None = None) -> StreamingQuery:
    """STR-3 for every feed, read from ``landing_dir`` or given as ``landed``: each micro-batch is normalised (first-wins
    within the batch, as the batch job does) and published to the table. With
    ``first_wins`` a row whose (cycle, key) is already stored -- a cycle split
    across micro-batches -- is dropped by an anti join against the table, pruned
    to the batch's chunks. A replayed batch finds none of its own rows there:
    either it is in the ledger, and nothing is done, or all it wrote is still
    staged, and is published as it is."""
    from movelake.jobs import BINARY_FEEDS, FEEDS, station_list
    from movelake.operators.layout import list_chunks
    table, normalise, _reject = FEEDS[feed]
    stations = station_list(spark, feed) if stations is None else stations
    key = DEDUP_KEYS.get(feed) if first_wins else None
    landed = landed_stream(spark, landing_dir, max_files, binary=feed in BINARY_FEEDS) if landed is None else landed
    writer = writer_of(checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        from pyspark import StorageLevel
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # used for range, anti join and write
        rows = with_chunk(normalise(batch, stations), table)
        if key and list_chunks(spark, table_path):
            lo, hi = rows.agg(F.min("chunk")).scalar(), rows.agg(F.max("chunk")).scalar()
            seen = read_table(spark, table_path, table).where(F.col("chunk").between(lo, hi)).select(*key, "chunk")
            rows = rows.join(seen, key + ["chunk"], "left_anti")
        write_batch(rows.drop("chunk"), table_path, table, batch_id, writer, metrics_path)
        batch.unpersist()

    w = landed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()
