"""Departure boards -> ``departures`` (SRC-9 ... SRC-11).

Three feeds, three sets of rules (kept separate on purpose): delay units,
time formats, platform-change and cancelled rules all differ. The station
name comes from the feed's station list by a join on the endpoint id (JOIN-2),
a broadcast one while Spark finds the list small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.functions import rules as R
from movelake.sources import payloads
from movelake.sources.dims import STATION_PREFIX

DEPARTURE_COLS = ["timestamp", "station_id", "station_name", "trip_id", "line_name", "direction",
                  "planned_time", "actual_time", "delay_seconds", "cancelled", "platform_planned",
                  "platform_actual", "platform_changed"]

CH_DOC = ("stationboard array<struct<stop struct<departureTimestamp long, delay int, platform string, "
          "prognosis struct<platform string, departure string>>, name string, category string, "
          "number string, to string>>")
BE_DOC = ("departures struct<departure array<struct<station string, time string, delay string, "
          "canceled string, vehicle string, platform string, platforminfo struct<normal string>>>>")
AT_DOC = ("departures array<struct<tripId string, direction string, line struct<name string>, "
          "when string, plannedWhen string, delay int, platform string, plannedPlatform string>>")


def _with_station(rows: DataFrame, stations: DataFrame, prefix: str) -> DataFrame:
    j = rows.join(stations, "endpoint", "left")
    return j.withColumn("station_id", R.station_key(prefix, F.col("endpoint")))


def norm_departures_ch(landed: DataFrame, stations: DataFrame, lenient_time: bool = False) -> DataFrame:
    """SRC-9: entries without ``stop`` dropped; planned from Unix seconds;
    actual from strict RFC 3339; delay minutes * 60; line name rule;
    platform change null-safe; trip_id NULL; cancelled FALSE."""
    p = payloads.accepted(payloads.parse(landed, CH_DOC))
    x = p.select("endpoint", "cycle_ts", F.explode("doc.stationboard").alias("e"))
    x = x.where(F.col("e.stop").isNotNull())
    planned_p, actual_p = F.col("e.stop.platform"), F.col("e.stop.prognosis.platform")
    rows = x.select(
        "endpoint", F.col("cycle_ts").alias("timestamp"),
        F.lit(None).cast("string").alias("trip_id"),
        R.line_name(F.col("e.category"), F.col("e.number"), F.col("e.name")).alias("line_name"),
        F.col("e.to").alias("direction"),
        R.seconds_to_ts(F.col("e.stop.departureTimestamp")).alias("planned_time"),
        R.rfc3339_to_ts(F.col("e.stop.prognosis.departure"), lenient_time).alias("actual_time"),
        R.minutes_to_seconds(F.col("e.stop.delay")).alias("delay_seconds"),
        F.lit(False).alias("cancelled"),
        planned_p.alias("platform_planned"), actual_p.alias("platform_actual"),
        R.platform_changed_ch(planned_p, actual_p).alias("platform_changed"))
    return _with_station(rows, stations, STATION_PREFIX["ch"]).select(*DEPARTURE_COLS)


def norm_departures_be(landed: DataFrame, stations: DataFrame) -> DataFrame:
    """SRC-10: every value is text; time = Unix seconds text; delay text in
    seconds (digits only); cancelled = '1'; trip and line = vehicle;
    platform_actual only when changed; actual_time NULL."""
    p = payloads.accepted(payloads.parse(landed, BE_DOC))
    x = p.select("endpoint", "cycle_ts", F.explode("doc.departures.departure").alias("d"))
    changed = R.platform_changed_be(F.col("d.platforminfo.normal"))
    rows = x.select(
        "endpoint", F.col("cycle_ts").alias("timestamp"),
        F.col("d.vehicle").alias("trip_id"), F.col("d.vehicle").alias("line_name"),
        F.col("d.station").alias("direction"),
        R.seconds_to_ts(F.when(F.col("d.time").rlike(R.INT_TEXT), F.col("d.time").try_cast("long")))
         .alias("planned_time"),
        F.lit(None).cast("timestamp").alias("actual_time"),
        R.int_text(F.col("d.delay")).alias("delay_seconds"),
        R.cancelled_flag(F.col("d.canceled")).alias("cancelled"),
        F.col("d.platform").alias("platform_planned"),
        F.when(changed, F.col("d.platform")).alias("platform_actual"),
        changed.alias("platform_changed"))
    return _with_station(rows, stations, STATION_PREFIX["be"]).select(*DEPARTURE_COLS)


def norm_departures_at(landed: DataFrame, stations: DataFrame, lenient_time: bool = False) -> DataFrame:
    """SRC-11: camelCase keys; RFC 3339 times; delay seconds passed through;
    platform changed only when both present and different; every record kept."""
    p = payloads.accepted(payloads.parse(landed, AT_DOC))
    x = p.select("endpoint", "cycle_ts", F.explode("doc.departures").alias("d"))
    rows = x.select(
        "endpoint", F.col("cycle_ts").alias("timestamp"),
        F.col("d.tripId").alias("trip_id"), F.col("d.line.name").alias("line_name"),
        F.col("d.direction").alias("direction"),
        R.rfc3339_to_ts(F.col("d.plannedWhen"), lenient_time).alias("planned_time"),
        R.rfc3339_to_ts(F.col("d.when"), lenient_time).alias("actual_time"),
        F.col("d.delay").alias("delay_seconds"),
        F.lit(False).alias("cancelled"),
        F.col("d.plannedPlatform").alias("platform_planned"),
        F.col("d.platform").alias("platform_actual"),
        R.platform_changed_at(F.col("d.plannedPlatform"), F.col("d.platform")).alias("platform_changed"))
    return _with_station(rows, stations, STATION_PREFIX["at"]).select(*DEPARTURE_COLS)
