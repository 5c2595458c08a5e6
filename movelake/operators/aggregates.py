"""Aggregations (AGG-*): latency percentiles, counts, freshness, rollups.

All are hash aggregates with map-side partial aggregation, so a hot key
(one source holding a third of the rows) is pre-aggregated on every mapper
before the shuffle. Exact percentiles use Spark's ``percentile`` (partial
value->count maps merged per group); pass ``approx=True`` for
``percentile_approx`` on groups with very many distinct values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from movelake.functions.rules import latency_ms, latency_seconds, ntz
from movelake.operators.filters import as_column, filter_time_range, filter_trailing, interval

PCTS = [0.5, 0.95, 0.99]
APPROX_ACCURACY = 100000


def _pct(x: Column, ps, approx: bool) -> Column:
    """In-aggregate percentiles (used by streaming windows and the approx
    path). Batch queries use ``percentiles_of`` below."""
    if approx:
        return F.percentile_approx(x, ps, APPROX_ACCURACY)
    return F.percentile(x, F.array(*[F.lit(p) for p in ps]))


def percentiles_of(df: DataFrame, groups, x: Column, ps, approx: bool = False) -> DataFrame:
    """Per group: ``p0..p{k-1}`` and ``n``. Exact by default through the
    distributed operator (no task holds a whole group); ``approx=True``
    uses one-pass ``percentile_approx``."""
    from movelake.operators.quantiles import exact_percentiles
    d = df.select(*groups, x.alias("_x"))
    if approx:
        q = F.percentile_approx("_x", ps, APPROX_ACCURACY)
        agg = d.groupBy(*groups).agg(q.alias("_q"), F.count("_x").alias("n"))
        return agg.select(*groups, *[F.col("_q")[i].alias(f"p{i}") for i in range(len(ps))], "n")
    return exact_percentiles(d, groups, "_x", ps)


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def latency_percentiles(tables: dict, as_of=None, window: str | None = "5 minutes",
                        approx: bool = False, digits: int = 6) -> DataFrame:
    """p50/p95/p99 of ingest latency (ms) and sample count, one row per
    table, also for a table with no rows in the window (NULL percentiles,
    0 samples), as the reference's UNION ALL of global aggregates gives.
    All tables go through one percentile computation grouped by table."""
    parts = []
    for name, df in tables.items():
        d = df.select("timestamp", "ingested_at")
        if window is not None:
            d = filter_trailing(d, as_of, window)
        parts.append(d.select(F.lit(name).alias("table"), latency_ms("ingested_at", "timestamp").alias("v")))
    q = percentiles_of(union_all(parts), ["table"], F.col("v"), PCTS, approx)
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(n,) for n in tables], "table string")  # table list (configuration)
    return (names.join(q, "table", "left").select(
        "table", F.round("p0", digits).alias("p50_ms"), F.round("p1", digits).alias("p95_ms"),
        F.round("p2", digits).alias("p99_ms"), F.coalesce("n", F.lit(0)).cast("long").alias("samples")))


def latency_p99_by_minute(df: DataFrame, start=None, end=None, approx: bool = False,
                          digits: int = 6, col_name: str = "p99_ms_flights") -> DataFrame:
    """p99 latency per minute of ``ingested_at`` inside [start, end], ordered."""
    d = df.select("timestamp", "ingested_at")
    if start is not None or end is not None:
        d = filter_time_range(d, start, end)
    d = d.select(F.date_trunc("minute", F.col("ingested_at")).alias("minute"),
                 latency_ms("ingested_at", "timestamp").alias("v"))
    q = percentiles_of(d, ["minute"], F.col("v"), [0.99], approx)
    return q.select(ntz("minute").alias("time"), F.round("p0", digits).alias(col_name)).orderBy("time")


def latency_alarm(df: DataFrame, as_of, window: str = "60 seconds", threshold_s: float = 2.0,
                  approx: bool = False, digits: int = 6) -> DataFrame:
    """p99 latency in seconds over the trailing window, and the alarm flag."""
    d = filter_trailing(df.select("timestamp", "ingested_at"), as_of, window)
    q = percentiles_of(d, [], latency_seconds("ingested_at", "timestamp"), [0.99], approx)
    return (q.select(F.round("p0", digits).alias("p99_seconds"))
             .withColumn("alarm", F.col("p99_seconds") > F.lit(threshold_s)))


def latency_p99_or_zero(df: DataFrame, approx: bool = False, digits: int = 6) -> DataFrame:
    q = percentiles_of(df.select("timestamp", "ingested_at"), [],
                       latency_ms("ingested_at", "timestamp"), [0.99], approx)
    return q.select(F.round(F.coalesce("p0", F.lit(0.0)), digits).alias("p99_ms"))


def row_counts(tables: dict) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.lit(n).alias("table"), "rows")
                      for n, df in tables.items()])


def count_filtered(tables: dict) -> DataFrame:
    """COUNT(*) and COUNT(*) FILTER (WHERE geom IS NOT NULL) per table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows"),
               F.count_if(F.col("geom").isNotNull()).alias("with_geom"))
          .select(F.lit(n).alias("table"), "rows", "with_geom")
        for n, df in tables.items()])


def freshness(tables: dict, as_of=None, stale_after: str = "10 minutes",
              group_col: dict | None = None) -> DataFrame:
    """Newest ``timestamp`` per table (and source where given), its age in
    seconds at ``as_of`` and the stale flag. Without ``as_of``, the newest
    ``ingested_at`` over all tables is used, computed in the same single
    pass per table (a window over the few result rows, no extra scans)."""
    from pyspark.sql import Window
    out = []
    for n, df in tables.items():
        g = (group_col or {}).get(n)
        keys = [F.lit(n).alias("table"),
                (F.col(g) if g else F.lit(None).cast("string")).alias("source")]
        out.append(df.groupBy(*keys).agg(F.max("timestamp").alias("newest"),
                                         F.max("ingested_at").alias("_ing")))
    u = union_all(out)
    a = as_column(as_of) if as_of is not None else F.max("_ing").over(Window.partitionBy())
    u = u.withColumn("_as_of", a)
    age = (F.unix_micros(F.col("_as_of")) - F.unix_micros(F.col("newest"))) / F.lit(1_000_000.0)
    return u.select("table", "source", ntz("newest").alias("newest"),
                    age.alias("age_seconds"),
                    (F.col("newest") < F.col("_as_of") - interval(stale_after)).alias("stale"))


def counts_per_bucket(df: DataFrame, unit: str, keys, ts_col: str = "timestamp",
                      bucket_name: str = "bucket") -> DataFrame:
    return (df.groupBy(F.date_trunc(unit, F.col(ts_col)).alias("_b"), *keys)
              .agg(F.count(F.lit(1)).alias("rows"))
              .select(ntz("_b").alias(bucket_name), *keys, "rows"))


def flights_per_minute(flights: DataFrame) -> DataFrame:
    return counts_per_bucket(flights, "minute", ["source"], bucket_name="minute")


def ship_rate_per_hour(ships: DataFrame) -> DataFrame:
    c = counts_per_bucket(ships, "hour", ["message_type"], bucket_name="hour")
    return c.withColumn("per_second", F.round(F.col("rows") / F.lit(3600.0), 6))


def delay_histogram(dep: DataFrame, bucket_minutes: int = 1) -> DataFrame:
    """Departures per (UTC day, station, delay bucket in minutes) with the
    cancelled count."""
    b = F.floor(F.col("delay_seconds") / F.lit(60 * bucket_minutes)) * bucket_minutes
    return (dep.groupBy(F.to_date("planned_time").alias("day"), "station_id",
                        b.cast("long").alias("delay_min"))
               .agg(F.count(F.lit(1)).alias("departures"),
                    F.count_if(F.col("cancelled")).alias("cancelled")))


def delay_trend(dep: DataFrame, as_of=None, days: int | None = 90, approx: bool = False,
                digits: int = 6) -> DataFrame:
    """Daily mean, p50 and p95 delay over the trailing ``days``. One pass
    over the departures: rows are first counted per (day, delay, cancelled)
    -- a small table -- and counts, mean, cancelled share and exact
    percentiles (weighted by those counts) all come from it."""
    from movelake.operators.quantiles import exact_percentiles
    d = dep.select("planned_time", "delay_seconds", "cancelled")
    if days is not None:
        d = d.where(F.col("planned_time") > as_column(as_of) - interval(f"{days} days"))
    t = (d.groupBy(F.to_date("planned_time").alias("day"), "delay_seconds", "cancelled")
          .agg(F.count(F.lit(1)).alias("w")))
    base = t.groupBy("day").agg(
        F.sum("w").cast("long").alias("departures"),
        (F.sum(F.col("delay_seconds").cast("long") * F.col("w")) / F.sum(F.when(F.col("delay_seconds").isNotNull(),
                                                                              F.col("w")))).alias("avg"),
        F.sum(F.when(F.col("cancelled"), F.col("w")).otherwise(0)).cast("long").alias("cancelled"))
    v = t.select("day", F.col("delay_seconds").cast("double").alias("v"), "w")
    if approx:
        q = percentiles_of(d.withColumn("day", F.to_date("planned_time")), ["day"],
                           F.col("delay_seconds").cast("double"), [0.5, 0.95], approx=True)
    else:
        q = exact_percentiles(v, ["day"], "v", [0.5, 0.95], weight_col="w")
    return (base.join(q.drop("n"), "day", "left")
                .select("day", "departures", F.round("avg", digits).alias("avg_delay_s"),
                        F.round("p0", digits).alias("p50_delay_s"),
                        F.round("p1", digits).alias("p95_delay_s"), "cancelled"))


def ship_density(ships: DataFrame, cell_deg: float = 1.0, boxes=None, as_of=None,
                 window: str | None = "7 days", exact_distinct: bool = True) -> DataFrame:
    """Messages and distinct ships per grid cell (optionally inside boxes
    and a trailing window). ``exact_distinct=False`` -> HyperLogLog."""
    from movelake.operators.filters import filter_bbox
    d = ships.select("timestamp", "mmsi", "latitude", "longitude")
    d = d.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if boxes:
        d = filter_bbox(d, boxes)
    if window is not None:
        d = d.where(F.col("timestamp") > as_column(as_of) - interval(window))
    distinct = (F.countDistinct("mmsi") if exact_distinct
                else F.approx_count_distinct("mmsi"))
    return (d.groupBy(F.floor(F.col("latitude") / cell_deg).cast("long").alias("cell_lat"),
                      F.floor(F.col("longitude") / cell_deg).cast("long").alias("cell_lon"))
             .agg(F.count(F.lit(1)).alias("messages"), distinct.alias("ships")))


def throughput_report(tables: dict, ts_col: str = "ingested_at", digits: int = 6) -> DataFrame:
    """Total rows, span, average rows/s, peak rows in one hour and in one
    minute, per table. Two-level aggregate: minute counts first (partial
    aggregation), then hour and totals from those small rows."""
    out = []
    for n, df in tables.items():
        m = (df.groupBy(F.date_trunc("minute", F.col(ts_col)).alias("minute"))
               .agg(F.count(F.lit(1)).alias("n"),
                    F.min(ts_col).alias("t0"), F.max(ts_col).alias("t1")))
        h = (m.groupBy(F.date_trunc("hour", "minute").alias("hour"))
              .agg(F.sum("n").alias("n"), F.max("n").alias("peak_min"),
                   F.min("t0").alias("t0"), F.max("t1").alias("t1")))
        tot = h.agg(F.sum("n").alias("rows"), F.max("n").alias("peak_hour_rows"),
                    F.max("peak_min").alias("peak_minute_rows"),
                    F.min("t0").alias("t0"), F.max("t1").alias("t1"))
        span = (F.unix_micros("t1") - F.unix_micros("t0")) / F.lit(1_000_000.0)
        out.append(tot.select(
            F.lit(n).alias("table"), F.col("rows").cast("long").alias("rows"),
            F.round(span, digits).alias("span_seconds"),
            F.round(F.when(span > 0, F.col("rows") / span), digits).alias("avg_rows_per_s"),
            F.col("peak_hour_rows").cast("long").alias("peak_hour_rows"),
            F.col("peak_minute_rows").cast("long").alias("peak_minute_rows")))
    return union_all(out)


def fleet_totals(tables: dict, source_col: dict, key_col: dict,
                 exact_distinct: bool = True) -> DataFrame:
    """Rows and distinct movers per (table, source)."""
    out = []
    for n, df in tables.items():
        s = source_col.get(n)
        k = key_col[n]
        distinct = F.countDistinct(k) if exact_distinct else F.approx_count_distinct(k)
        out.append(df.groupBy(F.lit(n).alias("table"),
                              (F.col(s) if s else F.lit(None).cast("string")).alias("source"))
                     .agg(F.count(F.lit(1)).alias("rows"), distinct.alias("movers")))
    return union_all(out)


def counts_by_endpoint(df: DataFrame, keys=("source", "endpoint")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def fleet_rollup(tables: dict, source_col: dict, key_col: dict) -> DataFrame:
    """AGG-13 with subtotals: rows and distinct movers per (table, source),
    per table, and overall (ROLLUP). Movers are counted as (table, id), so
    ids of different tables never collide in the totals."""
    parts = []
    for n, df in tables.items():
        s = source_col.get(n)
        parts.append(df.select(F.lit(n).alias("table"),
                               (F.col(s) if s else F.lit(None).cast("string")).alias("source"),
                               F.concat_ws(":", F.lit(n), F.col(key_col[n]).cast("string")).alias("mover")))
    u = union_all(parts)
    return (u.rollup("table", "source")
             .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("mover").alias("movers"),
                  F.grouping_id().alias("level")))
