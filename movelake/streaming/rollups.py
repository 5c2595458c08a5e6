"""Rollups that late rows correct (STR-4 ... STR-6, WIN-1 on a stream).

Each micro-batch is counted by (window, keys) and published to a rollup table by
the table's ledger: once per batch, also when it is replayed. A window's count
is the sum of its entries. There is no state in the stream and no watermark: a
row that comes hours late adds to its window like any other, the last windows
are there as soon as their rows are, and a window holds as many entries as
batches that touched it (``compact_rollup`` makes them one again).

What is asked of a stream reads the rollup: counts, collapsed windows, gaps, and
latency percentiles from counts by value bucket. A gap that a late insert fills
is gone with the next reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from movelake.functions.rules import latency_ms
from movelake.operators import ledger
from movelake.streaming.streams import _trigger, writer_of

DAY = 86_400
#: Buckets for each factor of e: a bucket's middle is within 0.2 % of its values.
STEPS = 256


def stream_rollup(rows: DataFrame, path: str, checkpoint: str, keys: list[str], window: str = "1 minute",
                  ts: str = "timestamp", trigger: str | None = None) -> StreamingQuery:
    """Counts of rows by (window of ts, keys) into the rollup table at path. Rows
    without ts are in no window."""
    writer = writer_of(checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        counted = (batch.where(F.col(ts).isNotNull()).groupBy(F.window(ts, window).alias("w"), *keys)
                   .agg(F.count("*").alias("rows")).select(F.col("w.start").alias("window_start"), *keys, "rows"))
        ledger.publish(counted.withColumn("chunk", F.to_date("window_start")), path, writer, batch_id, ("window_start",), "rollup")

    return _trigger(rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), trigger).start()


def _entries(spark: SparkSession, path: str, keys: str) -> DataFrame:
    return spark.read.schema(f"window_start timestamp, {keys}, rows long, chunk date").parquet(path)


def _summed(entries: DataFrame) -> DataFrame:
    by = [c for c in entries.columns if c != "rows"]
    return entries.groupBy(*by).agg(F.sum("rows").alias("rows"))


def read_rollup(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """(window_start, keys, rows) with every window's count so far; ``keys`` as
    DDL. The day (``chunk``) prunes: filter on it for a part of the time."""
    entries, gone = _entries(spark, path, keys), ledger.hidden(spark, path)
    return _summed(entries.where(~ledger.among(gone)) if gone else entries)


def compact_rollup(spark: SparkSession, path: str, keys: str) -> list[str]:
    """One entry per window again in every day that has got entries since."""
    ledger.finish_swaps(spark, path)
    days = sorted(str(r.chunk) for r in ledger.catalogue(spark, path).where("state != 'compacted'").collect())
    if days:
        ledger.swap(spark, path, lambda files: ledger.arranged(
            _summed(_entries(spark, path, keys).where(F.col("chunk").isin(days) & ledger.among(files))), "window_start"), days, uuid.uuid4().hex[:12])
    return days


def collapsed(rollup: DataFrame, length_s: int = 300, slide_s: int = 60, min_rows: int = 1000) -> DataFrame:
    """STR-6: sliding windows with a row but fewer than ``min_rows``, from counts by slide."""
    starts = F.transform(F.sequence(F.lit(0), F.lit(length_s // slide_s - 1)), lambda j: F.unix_seconds("window_start") - j * slide_s)
    counts = rollup.select(F.explode(starts).alias("s"), "rows").groupBy("s").agg(F.sum("rows").alias("rows"))
    return counts.where(F.col("rows") < min_rows).select(F.timestamp_seconds("s").alias("window_start"),
                                                         F.timestamp_seconds(F.col("s") + length_s).alias("window_end"), "rows")


def gaps(rollup: DataFrame, min_gap_s: int = 120) -> DataFrame:
    """WIN-1: (table, gap_start, gap_end, gap_seconds) between consecutive inserts,
    from counts by (table, second). Seconds are ordered within a day alone; the
    last second of the day before comes from one row per table and day."""
    secs = rollup.select("table", F.unix_seconds("window_start").alias("sec")).distinct().withColumn("day", F.floor(F.col("sec") / DAY))
    within = secs.withColumn("prev", F.lag("sec").over(Window.partitionBy("table", "day").orderBy("sec")))
    last = secs.groupBy("table", "day").agg(F.max("sec").alias("last"))
    before = last.select("table", "day", F.lag("last").over(Window.partitionBy("table").orderBy("day")).alias("before"))
    g = within.join(before, ["table", "day"]).select("table", "sec", F.coalesce("prev", "before").alias("prev"))
    return g.where(F.col("sec") - F.col("prev") > min_gap_s).select(
        "table", F.timestamp_seconds("prev").alias("gap_start"), F.timestamp_seconds("sec").alias("gap_end"), (F.col("sec") - F.col("prev")).alias("gap_seconds"))


def latency_bucket(ingested_at: str = "ingested_at", ts: str = "timestamp", steps: int = STEPS) -> Column:
    """Bucket of the latency's microseconds: monotone, ``steps`` for each factor of e."""
    us = F.abs(F.unix_micros(ingested_at) - F.unix_micros(ts))
    size = F.when(us > 0, F.floor(F.ln(us) * steps) + 1).otherwise(0).cast("int")
    return F.when(latency_ms(ingested_at, ts) < 0, -size).otherwise(size)


def latency_percentile(rollup: DataFrame, p: float = 0.99, threshold_ms: float = 2000.0, steps: int = STEPS) -> DataFrame:
    """STR-5: (window_start, p_ms, samples, alarm) per window from counts by
    bucket, within a factor of e ** (0.5 / steps) of the exact percentile. A
    window has at most as many entries as buckets, however many its rows."""
    value = F.signum("bucket") * F.exp((F.abs("bucket") - 0.5) / steps) / 1000
    return rollup.groupBy("window_start").agg(F.percentile(value, F.lit(p), F.col("rows")).alias("p_ms"), F.sum("rows").alias("samples")).select(
        "window_start", "p_ms", "samples", (F.col("p_ms") > threshold_ms).alias("alarm"))
