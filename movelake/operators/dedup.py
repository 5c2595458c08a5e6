"""First-wins de-duplication (DED-*).

All variants are a hash aggregate ``min_by(struct(row), order)`` grouped by
the key: partial aggregation collapses duplicates on each mapper before the
shuffle, so a hot key never ships more than one row per mapper. Group keys
treat NULLs as equal, like the reference's hash-set keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from movelake.functions.rules import coord_cell, whole_second


def first_wins(df: DataFrame, keys, order, drop_null_keys=()) -> DataFrame:
    """Keep, per key, the row with the smallest ``order`` (a column or a list
    of columns compared left to right). Output keeps ``df``'s columns."""
    cols = df.columns
    if drop_null_keys:
        for k in drop_null_keys:
            df = df.where(F.col(k).isNotNull())
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    named = [c.alias(f"_k{i}") for i, c in enumerate(key_cols)]
    ords = order if isinstance(order, (list, tuple)) else [order]
    ocol = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}")
                      for i, o in enumerate(ords)])
    row = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*named).agg(F.min_by(row, ocol).alias("_r"))
              .select(*[F.col("_r")[c].alias(c) for c in cols]))


def ping_key(mmsi="mmsi", lat="latitude", lon="longitude", ts="timestamp") -> list[Column]:
    """DED-1 key: (id, round(lat*1e5), round(lon*1e5), whole second)."""
    return [F.col(mmsi), coord_cell(F.col(lat)), coord_cell(F.col(lon)), whole_second(F.col(ts))]


def dedup_pings(pings: DataFrame, order: str = "seq", batch_col: str | None = None) -> DataFrame:
    """DED-1: collapse near-duplicate ship pings within one batch (the whole
    input when ``batch_col`` is None, like the one-shot collection)."""
    keys = ([F.col(batch_col)] if batch_col else []) + ping_key()
    return first_wins(pings, keys, order)


def dedup_aircraft(flights: DataFrame, cycle_col: str = "cycle_ts", order=("seq", "pos"),
                   id_col: str = "icao24") -> DataFrame:
    """DED-2: one row per (cycle, icao24), first endpoint/position wins,
    NULL ids dropped."""
    return first_wins(flights, [cycle_col, id_col], list(order), drop_null_keys=[id_col])


def dedup_orbits(elements: DataFrame, order: str = "category_idx") -> DataFrame:
    """DED-4: one row per (norad_id, epoch), first category wins."""
    return first_wins(elements, ["norad_id", "epoch"], order)


def dedup_pings_stream(stream: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """DED-5: cross-batch de-dup on a stream, state bounded by the watermark."""
    k = stream.select("*", *[c.alias(f"_dk{i}") for i, c in enumerate(ping_key())])
    return (k.withWatermark("timestamp", watermark)
             .dropDuplicatesWithinWatermark([f"_dk{i}" for i in range(4)])
             .drop(*[f"_dk{i}" for i in range(4)]))
