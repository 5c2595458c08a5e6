"""Ship message frames -> ``ships`` (SRC-8), batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.sources import payloads

SHIP_DOC = ("MessageType string, "
            "MetaData struct<MMSI long, ShipName string, latitude double, longitude double>")
SHIP_COLS = ["timestamp", "mmsi", "ship_name", "latitude", "longitude", "message_type"]


def norm_ship_messages(frames: DataFrame, keep_seq: bool = True) -> DataFrame:
    """Frames without MetaData or that fail to parse are dropped; MMSI
    integer -> text; the name is kept as received (not trimmed);
    ``timestamp`` is the frame's receive time (``cycle_ts``)."""
    p = payloads.accepted(payloads.parse(frames, SHIP_DOC))
    p = p.where(F.col("doc.MetaData").isNotNull())
    cols = [F.col("cycle_ts").alias("timestamp"),
            F.col("doc.MetaData.MMSI").cast("string").alias("mmsi"),
            F.col("doc.MetaData.ShipName").alias("ship_name"),
            F.col("doc.MetaData.latitude").alias("latitude"),
            F.col("doc.MetaData.longitude").alias("longitude"),
            F.col("doc.MessageType").alias("message_type")]
    if keep_seq:
        cols.append(F.col("seq"))
    return p.select(*cols)
