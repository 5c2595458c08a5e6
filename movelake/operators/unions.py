"""Set operations (SET-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.functions.rules import ntz
from movelake.operators.aggregates import union_all

MOVER_ID = {"flights": "icao24", "ships": "mmsi", "vehicle_positions": "vehicle_id"}


def all_positions(tables: dict) -> DataFrame:
    """(kind, id, ts, lat, lon) of every positioned row of every mover table.
    A plain UNION ALL: no shuffle, each input keeps its own partitions."""
    return union_all([
        df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
          .select(F.lit(kind).alias("kind"), F.col(MOVER_ID[kind]).alias("id"),
                  ntz("timestamp").alias("ts"), F.col("latitude").alias("lat"),
                  F.col("longitude").alias("lon"))
        for kind, df in tables.items()])
