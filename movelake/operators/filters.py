"""Row filters (FLT-*). All are Column predicates, so Catalyst pushes them
to the Parquet scan; time filters also add the ``chunk`` predicate when the
table is laid out by chunk, which Catalyst cannot derive from a filter on
``ingested_at``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from movelake.functions.geo import haversine_km


def as_column(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.to_timestamp(F.lit(x))
    if isinstance(x, dt.datetime):
        return F.lit(x)
    raise TypeError(f"unsupported as_of: {x!r}")


def latest(df: DataFrame, col: str = "ingested_at") -> Column:
    """max(col) of ``df`` as a scalar subquery (one value per query, like
    NOW() is one value per statement)."""
    return df.agg(F.max(col)).scalar()


def interval(expr: str) -> Column:
    return F.expr(f"INTERVAL {expr}")


def filter_has_position(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def filter_required_keys(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def filter_trailing(df: DataFrame, as_of, window: str = "5 minutes",
                    col: str = "ingested_at") -> DataFrame:
    """``col > as_of - window`` (strict, like ``> NOW() - INTERVAL``). Chunks
    follow the event time, which can lie any time before ingestion, so they
    cannot prune a range of ``ingested_at`` without losing late rows; Parquet
    statistics of ``col`` do that."""
    return df.where(F.col(col) > as_column(as_of) - interval(window))


def filter_time_range(df: DataFrame, start, end, col: str = "ingested_at") -> DataFrame:
    """Dashboard range: ``start <= col <= end`` (inclusive both ends)."""
    return df.where(F.col(col).between(as_column(start), as_column(end)))


def filter_bbox(df: DataFrame, boxes, lat="latitude", lon="longitude") -> DataFrame:
    """Keep rows inside any of the boxes ``((lat_min, lon_min), (lat_max, lon_max))``.
    A short box list is an OR of range predicates (pushed to Parquet)."""
    cond = None
    for (la0, lo0), (la1, lo1) in boxes:
        c = (F.col(lat).between(min(la0, la1), max(la0, la1))
             & F.col(lon).between(min(lo0, lo1), max(lo0, lo1)))
        cond = c if cond is None else cond | c
    return df.where(cond)


def filter_sources(df: DataFrame, enabled, col: str = "source") -> DataFrame:
    return df.where(F.col(col).isin(list(enabled)))


def filter_within_km(df: DataFrame, lat0: float, lon0: float, km: float,
                     lat="latitude", lon="longitude") -> DataFrame:
    """Exact radius filter with a cheap latitude band first (prunes row groups)."""
    band = km / 111.0 + 0.1
    return (df.where(F.col(lat).between(lat0 - band, lat0 + band))
              .where(haversine_km(F.col(lat), F.col(lon), F.lit(lat0), F.lit(lon0)) <= km))
