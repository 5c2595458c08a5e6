"""Table writers (SNK-*): fixed schema, point geometry, ``ingested_at`` at
write time, column defaults, chunk partitioning, rows-written metric,
idempotent append.

Writes go to a path under the shared folder the session names; Parquet
with zstd, partitioned by ``chunk`` so retention and time filters prune
whole directories.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from movelake.functions.rules import make_point
from movelake.operators import ledger
from movelake.operators.filters import as_column
from movelake.operators.layout import with_chunk
from movelake.schemas import TABLES

GEOM_TABLES = {"flights", "ships", "vehicle_positions"}
# LAY-6: vehicle files are clustered by 1-degree cell inside each chunk, so
# Parquet min/max statistics on latitude/longitude let bounding-box filters
# skip row groups (the role of the spatial index).
CELL_CLUSTERED = {"vehicle_positions"}
BOOL_DEFAULT_FALSE = {"departures": ["cancelled", "platform_changed"]}


def prepare(df: DataFrame, table: str, as_of=None) -> DataFrame:
    """Rows in the table's column order; geom from lon/lat (NULL if either
    is NULL; vehicles always have both); ``ingested_at`` defaults to
    ``as_of`` or the statement's current_timestamp(); FALSE defaults."""
    schema = TABLES[table]
    now = as_column(as_of) if as_of is not None else F.current_timestamp()
    cols = []
    for f in schema.fields:
        if f.name == "geom":
            c = make_point(F.col("longitude"), F.col("latitude"))
        elif f.name == "ingested_at":
            c = (F.coalesce(F.col("ingested_at"), now) if "ingested_at" in df.columns else now)
        elif f.name in BOOL_DEFAULT_FALSE.get(table, []):
            c = F.coalesce(F.col(f.name), F.lit(False)) if f.name in df.columns else F.lit(False)
        elif f.name in df.columns:
            c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _within(table: str) -> tuple:
    """Order of the rows inside a chunk's files."""
    return (F.floor("latitude"), F.floor("longitude"), "timestamp") if table in CELL_CLUSTERED else ("timestamp",)


def append(df: DataFrame, path: str, table: str, as_of=None, metrics_path: str | None = None,
           max_records_per_file: int = 5_000_000, writer: str | None = None, batch: int | str | None = None,
           many_chunks: bool = True) -> int:
    """Append a batch; returns rows written (0 for an empty batch, no files
    touched). The count comes from an Observation on the write itself, not
    a second pass over the data.

    With ``writer`` and ``batch`` the rows are written once under that name,
    however often the job is run again (0 rows then).

    ``many_chunks`` (a backfill, a table of many days) writes range partitions,
    as many as the session's shuffle has; the input is then computed twice, so
    keep it (``persist``) if it is dear. Without it (a day's load, a
    micro-batch) the input is computed once and Spark sizes the tasks."""
    t0 = time.time()
    conf = df.sparkSession.conf
    tasks = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                or conf.get("spark.sql.shuffle.partitions", "200")) if many_chunks else None
    rows = with_chunk(prepare(df, table, as_of), table)
    if writer is not None:
        entry = ledger.publish(rows, path, writer, batch, _within(table), table, max_records_per_file, tasks)
        n = entry["rows"] if entry["new"] else 0
    else:
        # Each task holds whole chunks or, of a very large one, a part. Observed
        # after the exchange, so that a sampler's rows are not counted.
        obs = Observation(f"write_{table}")
        rows = ledger.arranged(rows, *_within(table), tasks=tasks).observe(obs, F.count(F.lit(1)).alias("n"))
        (rows.write.mode("append").partitionBy("chunk")
             .option("compression", "zstd").option("maxRecordsPerFile", max_records_per_file)
             .parquet(path))
        n = int(obs.get.get("n", 0) or 0)
    if metrics_path is not None and (writer is None or n):
        record_metrics(df.sparkSession, metrics_path, table, n, time.time() - t0)
    return n


def record_metrics(spark: SparkSession, path: str, table: str, rows: int, elapsed_s: float) -> None:
    """SNK-9: one metrics row per written batch, appended to ``ingest_metrics``."""
    m = spark.createDataFrame([(table, int(rows), float(elapsed_s))],
                              "table string, rows long, elapsed_s double")
    m.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """SRC-16: read a stored table with its fixed schema (plus ``chunk``),
    without the files that an unfinished compaction is replacing."""
    from pyspark.sql import types as T
    schema = T.StructType(TABLES[table].fields + [T.StructField("chunk", T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    gone = ledger.hidden(spark, path)
    return df.where(~ledger.among(gone)) if gone else df


def append_idempotent(batch: DataFrame, target: DataFrame, key=("source", "icao24", "timestamp"),
                      chunk_col: str = "chunk", clock_col: str = "ingested_at") -> DataFrame:
    """SNK-10 / JOIN-3: rows of ``batch`` whose key is not in the batch
    already (dropDuplicates) nor in ``target``. The target is pruned to the
    batch's chunk range by scalar subqueries, so only the touched partitions are
    read and nothing runs before the result is asked for.

    A key with a NULL names no row: such rows are the same only if all
    columns but ``clock_col`` are, NULLs being equal, in the batch and against
    the target alike. So none is lost, and a retry adds none again."""
    key = list(key)
    lo, hi = batch.agg(F.min(chunk_col)).scalar(), batch.agg(F.max(chunk_col)).scalar()
    t = target.where(F.col(chunk_col).between(lo, hi))
    unnamed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    named = (batch.where(~unnamed).dropDuplicates(key)
             .join(t.where(~unnamed).select(*key, chunk_col), key + [chunk_col], "left_anti"))
    rest = [c for c in batch.columns if c != clock_col]
    seen = t.where(unnamed).select(*[F.col(c).alias(f"_t_{c}") for c in rest if c in t.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in rest if c in t.columns])
    return named.select(*batch.columns).unionByName(batch.where(unnamed).dropDuplicates(rest).join(seen, same, "left_anti"))


def unnest_columns(df: DataFrame, array_cols, names=None) -> DataFrame:
    """SNK-8: parallel column arrays -> rows (UNNEST of zipped arrays)."""
    names = names or list(array_cols)
    z = F.arrays_zip(*[F.col(c).alias(n) for c, n in zip(array_cols, names)])
    keep = [c for c in df.columns if c not in array_cols]
    return df.select(*keep, F.inline(z))
