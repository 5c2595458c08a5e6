"""Per-field rules of the feeds as pure Column expressions (no UDFs).

Each function takes and returns ``Column`` so Catalyst keeps them inside
whole-stage codegen. Names follow the rule they implement; where Spark's
built-in differs from the feed semantics the guard is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Variant type names that count as a JSON number, and the
# strict RFC 3339 timestamp shape (an offset with a colon, or Z, is required).
NUMERIC_VARIANT = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
RFC3339 = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}"
           r"([.][0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$")
INT_TEXT = r"^[+-]?[0-9]+$"
# The Unicode White_Space characters a text trim removes
# (ASCII tab, LF, VT, FF, CR, space; NEL; NBSP; ogham space; U+2000..U+200A;
# line and paragraph separators; narrow NBSP; medium math space; ideographic
# space). The ASCII separators U+001C..U+001F are not whitespace here.
WHITESPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680"
              + "".join(chr(c) for c in range(0x2000, 0x200B))
              + "\u2028\u2029\u202f\u205f\u3000")
SRID_WGS84 = 4326
# Unix seconds accepted by the timestamp rules: year 1 .. 9999.
MIN_UNIX_SECONDS = -62135596800
MAX_UNIX_SECONDS = 253402300799


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- variant cells (mixed number / string JSON values) ----------------------

def variant_is_number(v) -> Column:
    return F.coalesce(F.schema_of_variant(_c(v)).rlike(NUMERIC_VARIANT), F.lit(False))


def variant_is_string(v) -> Column:
    return F.coalesce(F.schema_of_variant(_c(v)) == F.lit("STRING"), F.lit(False))


def variant_number(v) -> Column:
    """JSON number -> double; any other JSON type (including a numeric
    string) -> NULL. ``try_variant_get`` alone would cast "35000"."""
    v = _c(v)
    return F.when(variant_is_number(v), F.try_variant_get(v, "$", "double"))


def variant_string(v) -> Column:
    v = _c(v)
    return F.when(variant_is_string(v), F.try_variant_get(v, "$", "string"))


def variant_bool(v) -> Column:
    v = _c(v)
    return F.when(F.schema_of_variant(v) == F.lit("BOOLEAN"),
                  F.try_variant_get(v, "$", "boolean"))


# -- SCL-1 / SCL-2: altitude and ground flag of the shared aircraft feeds ---

def altitude_shared(alt_baro, alt_geom) -> Column:
    """Numeric ``alt_baro``, else ``alt_geom``."""
    return F.coalesce(variant_number(alt_baro), _c(alt_geom).cast("double"))


def on_ground_shared(alt_baro) -> Column:
    """``alt_baro == 'ground'`` when it is a string; NULL when numeric/missing."""
    return F.when(variant_is_string(alt_baro),
                  F.try_variant_get(_c(alt_baro), "$", "string") == F.lit("ground"))


# -- SCL-1b / SCL-2b: private feeder ladder ---------------------------------

def altitude_private(alt_baro, alt_geom) -> Column:
    v = _c(alt_baro)
    return (F.when(variant_is_number(v), F.try_variant_get(v, "$", "double"))
            .when(variant_string(v) == F.lit("ground"), F.lit(0.0))
            .otherwise(_c(alt_geom).cast("double")))


def on_ground_private(altitude) -> Column:
    return F.coalesce(_c(altitude) == F.lit(0.0), F.lit(False))


# -- text rules ---------------------------------------------------------------

def trim_all(s) -> Column:
    """Trim every Unicode whitespace character (Spark ``trim`` strips spaces
    only). A blank string stays '' (not NULL)."""
    return F.btrim(_c(s), F.lit(WHITESPACE))


def line_name(category, number, name) -> Column:
    cat, num = _c(category), _c(number)
    return (F.when(cat.isNotNull() & num.isNotNull(), F.concat_ws(" ", cat, num))
            .when(cat.isNotNull(), cat)
            .otherwise(_c(name)))


def station_key(prefix: str, station) -> Column:
    return F.concat(F.lit(prefix), _c(station).cast("string"))


def id_text(x) -> Column:
    return _c(x).cast("string")


# -- time rules ---------------------------------------------------------------

def seconds_to_ts(s) -> Column:
    """Unix seconds -> timestamp; out of range -> NULL (Spark would throw)."""
    s = _c(s).cast("long")
    return F.when(s.between(MIN_UNIX_SECONDS, MAX_UNIX_SECONDS), F.timestamp_seconds(s))


def rfc3339_to_ts(s, lenient: bool = False) -> Column:
    """Strict RFC 3339 text -> UTC timestamp, else NULL. ``lenient`` also
    accepts what Spark's parser accepts (no offset, ``+0200``)."""
    s = _c(s)
    # RFC 3339 allows lower-case 't' and 'z'; Spark's parser wants upper case
    parsed = F.try_to_timestamp(F.upper(s))
    if lenient:
        return parsed
    return F.when(s.rlike(RFC3339), parsed)


def int_text(s) -> Column:
    """Integer text as the feeds' parser reads it: optional sign, digits only,
    within int32; anything else -> NULL."""
    s = _c(s)
    return F.when(s.rlike(INT_TEXT), s.try_cast("int"))


def minutes_to_seconds(m) -> Column:
    """delay minutes * 60; int32 overflow -> NULL."""
    return F.try_multiply(_c(m).cast("int"), F.lit(60))


def entity_time(entity_ts, feed_ts, fallback) -> Column:
    """Entity time if present (0 is kept), else feed time if > 0, else the
    collector's clock."""
    e, f = _c(entity_ts).cast("long"), _c(feed_ts).cast("long")
    return F.coalesce(seconds_to_ts(e), F.when(f > 0, seconds_to_ts(f)), _c(fallback))


def whole_second(ts) -> Column:
    return F.unix_seconds(_c(ts))


def latency_ms(ingested_at, ts) -> Column:
    """EXTRACT(EPOCH FROM (ingested_at - ts)) * 1000, microsecond exact."""
    return (F.unix_micros(_c(ingested_at)) - F.unix_micros(_c(ts))) / F.lit(1000.0)


def latency_seconds(ingested_at, ts) -> Column:
    return (F.unix_micros(_c(ingested_at)) - F.unix_micros(_c(ts))) / F.lit(1_000_000.0)


def utc_day_text(ts) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd")


def ntz(c) -> Column:
    """timestamp -> timestamp_ntz with the same UTC wall clock (output form)."""
    return _c(c).cast("timestamp_ntz")


# -- delay / platform rules -------------------------------------------------

def platform_changed_ch(planned, actual) -> Column:
    """actual present and different from planned (NULL planned differs)."""
    a = _c(actual)
    return a.isNotNull() & ~_c(planned).eqNullSafe(a)


def platform_changed_be(normal) -> Column:
    return F.coalesce(_c(normal) != F.lit("1"), F.lit(False))


def platform_changed_at(planned, actual) -> Column:
    return F.coalesce(_c(planned) != _c(actual), F.lit(False))


def cancelled_flag(canceled) -> Column:
    return F.coalesce(_c(canceled) == F.lit("1"), F.lit(False))


# -- geo scalar rules -------------------------------------------------------

def make_point(lon, lat) -> Column:
    lon, lat = _c(lon), _c(lat)
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"),
                           F.lit(SRID_WGS84).alias("srid")))


def coord_cell(x, scale: float = 1e5) -> Column:
    """round(x * 1e5) as bigint: half away from zero, like the feed's key."""
    return F.round(_c(x) * F.lit(scale)).cast("long")


def widen_float(x) -> Column:
    return _c(x).cast("float").cast("double")
