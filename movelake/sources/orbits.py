"""Orbital-element documents -> ``satellites`` (SRC-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.functions import rules as R
from movelake.sources import payloads

ELEMENT = ("NORAD_CAT_ID int, OBJECT_NAME string, EPOCH string, MEAN_MOTION double, "
           "ECCENTRICITY double, INCLINATION double, TLE_LINE1 string, TLE_LINE2 string")
ORBIT_DOC = f"elements array<struct<{ELEMENT}>>"
SAT_COLS = ["timestamp", "norad_id", "name", "epoch", "mean_motion", "inclination", "eccentricity",
            "tle_line1", "tle_line2"]


def _wrapped(landed: DataFrame) -> DataFrame:
    # The API serves a bare array; wrap it so the corrupt-record column works.
    if payloads.CORRUPT in landed.columns:
        return landed  # parsed already
    return landed.withColumn("body", F.concat(F.lit('{"elements":'), F.col("body"), F.lit("}")))


def missing_required():
    return F.exists("doc.elements", lambda x: x["NORAD_CAT_ID"].isNull() | x["OBJECT_NAME"].isNull())


def norm_orbital_elements(landed: DataFrame, lenient_time: bool = False, keep_category: bool = False
                          ) -> DataFrame:
    """A category document with any element missing its id or name is
    rejected whole; epoch from strict RFC 3339 else NULL; no de-dup across
    categories."""
    p = payloads.accepted(payloads.parse(_wrapped(landed), ORBIT_DOC))
    p = p.where(~missing_required())
    x = p.select("endpoint", "cycle_ts", F.explode("doc.elements").alias("s"))
    cols = [F.col("cycle_ts").alias("timestamp"),
            F.col("s.NORAD_CAT_ID").alias("norad_id"), F.col("s.OBJECT_NAME").alias("name"),
            R.rfc3339_to_ts(F.col("s.EPOCH"), lenient_time).alias("epoch"),
            F.col("s.MEAN_MOTION").alias("mean_motion"), F.col("s.INCLINATION").alias("inclination"),
            F.col("s.ECCENTRICITY").alias("eccentricity"),
            F.col("s.TLE_LINE1").alias("tle_line1"), F.col("s.TLE_LINE2").alias("tle_line2")]
    if keep_category:
        cols.append(F.col("endpoint").alias("category"))
    return x.select(*cols)


def parse_orbits(landed: DataFrame) -> DataFrame:
    return payloads.parse_all(_wrapped(landed), ORBIT_DOC)


def rejected_orbits(landed: DataFrame) -> DataFrame:
    return payloads.rejected(_wrapped(landed), ORBIT_DOC, (missing_required(), "missing_required"))
