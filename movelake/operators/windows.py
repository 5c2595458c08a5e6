"""Window work (WIN-*, SRT-4): stall gaps, throughput collapse, latest
position, tracks, fixed-window session summaries, top-N per station.

Ordered windows are never global: time-ordered scans are pre-aggregated to
distinct seconds and partitioned by (table, UTC day); the few rows that
need the previous day (first second of a day, trailing 300 s) get it from a
per-day summary or a 300-second halo copied from the previous day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from movelake.functions.rules import ntz
from movelake.operators.aggregates import union_all

DAY = 86400


def _seconds(df: DataFrame, ts_col: str) -> DataFrame:
    s = F.unix_seconds(F.col(ts_col))
    return df.select(s.alias("sec"))


def stall_gaps(tables: dict, ts_col: str = "ingested_at", min_gap_s: int = 120) -> DataFrame:
    """WIN-1: gaps longer than ``min_gap_s`` between consecutive inserts."""
    out = []
    for n, df in tables.items():
        secs = _seconds(df, ts_col).distinct().withColumn("day", F.floor(F.col("sec") / DAY))
        w = Window.partitionBy("day").orderBy("sec")
        within = secs.withColumn("prev", F.lag("sec").over(w))
        per_day = secs.groupBy("day").agg(F.max("sec").alias("last"))
        # previous non-empty day's last second, for each day's first second
        prev_day = per_day.withColumn(
            "prev_last", F.lag("last").over(Window.orderBy("day"))).select("day", "prev_last")
        g = (within.join(prev_day, "day", "left")
                   .select("sec", F.coalesce("prev", "prev_last").alias("prev"))
                   .where(F.col("prev").isNotNull()))
        out.append(g.where(F.col("sec") - F.col("prev") > min_gap_s).select(
            F.lit(n).alias("table"),
            ntz(F.timestamp_seconds("prev")).alias("gap_start"),
            ntz(F.timestamp_seconds("sec")).alias("gap_end"),
            (F.col("sec") - F.col("prev")).alias("gap_seconds")))
    return union_all(out)


def throughput_collapse(tables: dict, ts_col: str = "ingested_at", window_s: int = 300,
                        min_rows: int = 1000) -> DataFrame:
    """WIN-2: seconds at which the rows inserted in the trailing
    ``window_s`` (inclusive) fall below ``min_rows``, once the table has run
    longer than ``window_s``."""
    out = []
    for n, df in tables.items():
        per_sec = (_seconds(df, ts_col).groupBy("sec").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("day", F.floor(F.col("sec") / DAY)))
        start = per_sec.agg(F.min("sec")).scalar()
        halo = (per_sec.where(F.col("sec") - F.col("day") * DAY >= DAY - window_s)
                       .withColumn("day", F.col("day") + 1).withColumn("halo", F.lit(True)))
        both = per_sec.withColumn("halo", F.lit(False)).unionByName(halo)
        w = Window.partitionBy("day").orderBy("sec").rangeBetween(-window_s, 0)
        r = (both.withColumn("rows_in_window", F.sum("n").over(w))
                 .where(~F.col("halo"))
                 .where(F.col("sec") - start > window_s)
                 .where(F.col("rows_in_window") < min_rows))
        out.append(r.select(F.lit(n).alias("table"), ntz(F.timestamp_seconds("sec")).alias("second"),
                            F.col("rows_in_window").cast("long").alias("rows_in_window")))
    return union_all(out)


def latest_position(df: DataFrame, key: str, extra=()) -> DataFrame:
    """WIN-3: newest positioned row per mover (ties broken by ingest time
    and coordinates). ``max_by`` is partially aggregated on each mapper."""
    d = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    row = F.struct("timestamp", "latitude", "longitude", *extra)
    order = F.struct("timestamp", "ingested_at", "latitude", "longitude")
    return (d.groupBy(key).agg(F.max_by(row, order).alias("r"))
             .select(F.col(key), ntz("r.timestamp").alias("timestamp"),
                     F.col("r.latitude").alias("latitude"), F.col("r.longitude").alias("longitude"),
                     *[F.col(f"r.{e}").alias(e) for e in extra]))


def mover_track(df: DataFrame, key: str, start=None, end=None, partitions: int | None = None
                ) -> DataFrame:
    """WIN-4: time-ordered track of every mover in [start, end]. Range
    partitioning on (key, timestamp) splits a hot mover across tasks by
    time; rows come out sorted within each partition."""
    d = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if start is not None:
        d = d.where(F.col("timestamp") >= start)
    if end is not None:
        d = d.where(F.col("timestamp") <= end)
    d = d.select(key, "timestamp", "latitude", "longitude")
    d = (d.repartitionByRange(partitions, key, "timestamp") if partitions
         else d.repartitionByRange(key, "timestamp"))
    return (d.sortWithinPartitions(key, "timestamp")
             .select(key, ntz("timestamp").alias("timestamp"), "latitude", "longitude"))


def session_summary(pings: DataFrame, key_cols, window: str = "10 minutes") -> DataFrame:
    """WIN-5: per fixed window (the 600 s session recycle), messages
    received and rows inserted after first-wins de-dup on ``key_cols``."""
    per_key = (pings.groupBy(F.window("timestamp", window).alias("w"), *key_cols)
                    .agg(F.count(F.lit(1)).alias("n")))
    return (per_key.groupBy("w").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("inserted"))
                   .select(ntz("w.start").alias("window_start"), ntz("w.end").alias("window_end"),
                           F.col("messages").cast("long").alias("messages"), "inserted"))


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int = 30) -> DataFrame:
    """SRT-4: first ``n`` rows per group (row_number <= n; Spark plans this
    as a window group limit, so each group keeps at most ``n`` rows before
    the final window)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
