"""Data-quality checks (DQ-*) and dead-letter handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.operators.aggregates import union_all


def geom_consistency(tables: dict) -> DataFrame:
    """Per table: rows, NULL geoms, rows missing a coordinate, and violations
    of 'geom is NULL iff a coordinate is NULL' (expected 0)."""
    out = []
    for n, df in tables.items():
        g = F.col("geom").isNull()
        c = F.col("latitude").isNull() | F.col("longitude").isNull()
        out.append(df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(g).alias("geom_null"),
                          F.count_if(c).alias("coord_null"),
                          F.count_if(g != c).alias("violations"))
                     .select(F.lit(n).alias("table"), "rows", "geom_null", "coord_null",
                             "violations"))
    return union_all(out)


def dropped_counts(rejected: DataFrame) -> DataFrame:
    """DQ-2: dropped records per (source, reason)."""
    return rejected.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("rows"))
