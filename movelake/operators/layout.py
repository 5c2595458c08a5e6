"""Table layout, compaction and retention (LAY-*).

A table is Parquet partitioned by ``chunk`` (the UTC day, or the 7-day
bucket for satellites, aligned to the Unix epoch like hypertable chunks).
Retention drops whole chunks; compaction rewrites a chunk segmented by the
table's segment column and sorted newest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from movelake.operators.aggregates import union_all
from movelake.operators.filters import as_column, interval
from movelake.operators.ledger import among, catalogue, filesystem, finish_swaps, swap
from movelake.schemas import CHUNK_DAYS, COMPACT_AFTER_DAYS, SEGMENT_BY


def chunk_of(ts, days: int = 1) -> Column:
    d = F.to_date(F.col(ts) if isinstance(ts, str) else ts)
    if days == 1:
        return d
    return F.date_from_unix_date((F.floor(F.unix_date(d) / days) * days).cast("int"))


def with_chunk(df: DataFrame, table: str, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("chunk", chunk_of(ts, CHUNK_DAYS[table]))


def chunk_counts(tables: dict) -> DataFrame:
    """LAY-1: rows per (table, chunk)."""
    return union_all([
        with_chunk(df, n).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(n).alias("table"), "chunk", "rows")
        for n, df in tables.items()])


def _chunk_end(table: str) -> Column:
    return F.date_add(F.col("chunk"), CHUNK_DAYS[table]).cast("timestamp")


def chunks_to_compact(tables: dict, as_of: dict) -> DataFrame:
    """LAY-3: chunks whose end is at least N days before ``as_of``."""
    out = []
    for n, df in tables.items():
        cut = as_column(as_of[n]) - interval(f"{COMPACT_AFTER_DAYS[n]} days")
        c = with_chunk(df, n).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
        out.append(c.where(_chunk_end(n) <= cut).select(F.lit(n).alias("table"), "chunk", "rows"))
    return union_all(out)


def retention_filter(df: DataFrame, table: str, as_of, days: int | None) -> DataFrame:
    """Rows that survive dropping every chunk that ends before as_of - days."""
    if days is None:
        return df
    c = with_chunk(df, table)
    return c.where(_chunk_end(table) > as_column(as_of) - interval(f"{days} days")).drop("chunk")


def retention_summary(tables: dict, as_of: dict, days: dict) -> DataFrame:
    """LAY-4: rows and chunks kept / dropped per table (unset days = keep)."""
    out = []
    for n, df in tables.items():
        d = days.get(n)
        c = with_chunk(df, n).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
        keep = (F.lit(True) if d is None
                else _chunk_end(n) > as_column(as_of[n]) - interval(f"{d} days"))
        c = c.withColumn("keep", keep)
        out.append(c.agg(
            F.sum(F.when(F.col("keep"), F.col("rows")).otherwise(0)).cast("long").alias("rows_kept"),
            F.sum(F.when(~F.col("keep"), F.col("rows")).otherwise(0)).cast("long").alias("rows_dropped"),
            F.count_if(F.col("keep")).alias("chunks_kept"),
            F.count_if(~F.col("keep")).alias("chunks_dropped"))
            .select(F.lit(n).alias("table"), "rows_kept", "rows_dropped", "chunks_kept", "chunks_dropped"))
    return union_all(out)


def compact(df: DataFrame, table: str, partitions: int | None = None) -> DataFrame:
    """LAY-2: rows clustered by (chunk, segment) and sorted newest first,
    ready to be written with zstd. Range partitioning on (chunk, segment,
    timestamp) keeps each segment's rows together in file order while a hot
    segment (one source with a third of a day's rows) is split across
    several tasks by time instead of landing in one."""
    seg = SEGMENT_BY.get(table)
    d = with_chunk(df, table)
    keys = ["chunk"] + ([seg] if seg else [])
    order = [*keys, F.col("timestamp").desc()]
    d = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    return d.sortWithinPartitions(*order)


def recent_rows(rows: DataFrame, table: str, key: str, as_of, within: str, n: int) -> DataFrame:
    """LAY-5: the newest ``n`` rows of each ``key`` in the ``within`` before
    ``as_of``, newest first (``rank``). The chunk filter prunes directories, the
    time filter row groups of sorted files; each task keeps at most ``n`` rows of
    a key before the exchange."""
    from movelake.operators.windows import top_n_per_group
    start = as_column(as_of) - interval(within)
    new = rows.where((F.col("chunk") >= chunk_of(start, CHUNK_DAYS[table])) & (F.col("timestamp") > start))
    return top_n_per_group(new, [key], [F.col("timestamp").desc(), F.col("ingested_at").desc()], n)


# --- maintenance jobs on a stored table ------------------------------------------

def list_chunks(spark, path: str) -> list[str]:
    """Chunk partition values present under ``path`` (one directory listing;
    the number of chunks is the number of days, not of rows)."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("chunk="):
            out.append(name[len("chunk="):])
    return sorted(out)


def drop_chunks(spark, path: str, table: str, as_of, days: int | None) -> list[str]:
    """LAY-4 retention: delete every chunk directory whose chunk ends at or
    before ``as_of - days``. Chunk-granular like hypertable retention;
    unset ``days`` keeps everything. ``as_of`` is a date/datetime/ISO text."""
    import datetime as dt
    if days is None:
        return []
    a = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    cutoff = a.replace(tzinfo=None) - dt.timedelta(days=days)
    width = CHUNK_DAYS[table]
    fs, base = filesystem(spark, path)
    dropped = []
    for c in list_chunks(spark, path):
        end = dt.datetime.fromisoformat(c) + dt.timedelta(days=width)
        if end <= cutoff:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, f"chunk={c}"), True)
            dropped.append(c)
    return dropped


def compact_chunks(spark, path: str, table: str, as_of, partitions: int | None = None, at_once: int = 31) -> list[str]:
    """LAY-2 + LAY-3: rewrite the chunks due for compaction (ended at least
    the table's compaction age before ``as_of``) clustered by segment and
    sorted newest first. Only chunks that are raw or dirty, by the chunk
    catalogue: a second run rewrites nothing, a late row makes its chunk due
    again. A run that stops halfway is finished by the next (or by any
    ``compact_chunks``), and readers see every row once at any time; a query
    that began before a swap ends may find a file gone and has to be run again.
    ``at_once`` chunks are rewritten by one Spark job."""
    import datetime as dt
    import uuid
    from movelake.operators.sinks import read_table
    a = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    cutoff = a.replace(tzinfo=None) - dt.timedelta(days=COMPACT_AFTER_DAYS[table])
    finish_swaps(spark, path)
    last = (cutoff - dt.timedelta(days=CHUNK_DAYS[table])).date()
    due = sorted(str(r.chunk) for r in catalogue(spark, path).where(F.col("chunk") <= F.lit(last)).where("state != 'compacted'").collect())
    for i in range(0, len(due), at_once):
        chunks = due[i:i + at_once]

        def rewritten(files: list[str]) -> DataFrame:
            rows = read_table(spark, path, table).where(F.col("chunk").isin(chunks) & among(files))  # files that come meanwhile stay as they are
            return compact(rows.drop("chunk"), table, partitions)

        swap(spark, path, rewritten, chunks, uuid.uuid4().hex[:12])
    return due
