"""Field rules and their traps (SCL-*)."""

import datetime as dt

from pyspark.sql import functions as F

from movelake.functions import rules as R

UTC = dt.timezone.utc


def _one(spark, expr, ddl="x string", value=None):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first().r


def test_altitude_and_ground_shared(spark):
    cases = {'35000': (35000.0, None), '"ground"': (12.0, True), '"35000"': (12.0, False),
             'null': (12.0, None), '"other"': (12.0, False)}
    for text, (alt, ground) in cases.items():
        df = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v"))
        r = df.select(R.altitude_shared(F.col("v"), F.lit(12.0)).alias("a"),
                      R.on_ground_shared(F.col("v")).alias("g")).first()
        assert (r.a, r.g) == (alt, ground), text
    df = spark.createDataFrame([(None,)], "v variant")
    r = df.select(R.altitude_shared(F.col("v"), F.lit(None)).alias("a"),
                  R.on_ground_shared(F.col("v")).alias("g")).first()
    assert (r.a, r.g) == (None, None)


def test_altitude_private_ladder(spark):
    for text, (alt, ground) in {'0': (0.0, True), '"ground"': (0.0, True), '"x"': (7.0, False),
                                '1200.5': (1200.5, False)}.items():
        df = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("v"))
        a = R.altitude_private(F.col("v"), F.lit(7))
        r = df.select(a.alias("a"), R.on_ground_private(a).alias("g")).first()
        assert (r.a, r.g) == (alt, ground), text


def test_trim_all_whitespace_blank_is_empty(spark):
    assert _one(spark, R.trim_all(F.col("x")), value=" \tDLH12\r\n") == "DLH12"
    assert _one(spark, R.trim_all(F.col("x")), value=" \t ") == ""
    assert _one(spark, R.trim_all(F.col("x")), value=None) is None
    assert _one(spark, R.trim_all(F.col("x")), value="\u00a0\u3000AB1\u2009") == "AB1"
    assert _one(spark, R.trim_all(F.col("x")), value="\x1fAB1") == "\x1fAB1"


def test_rfc3339_strict_and_lenient(spark):
    exp = dt.datetime(2026, 4, 19, 10, 0)
    strict = {"2026-04-19T12:00:00+02:00": exp, "2026-04-19T10:00:00Z": exp,
              "2026-04-19t10:00:00z": exp, "2026-04-19 10:00:00Z": exp,
              "2026-04-19T12:00:00+0200": None, "2026-04-19T10:00:00": None, "garbage": None}
    for text, want in strict.items():
        got = _one(spark, R.ntz(R.rfc3339_to_ts(F.col("x"))), value=text)
        assert got == want, text
    assert _one(spark, R.ntz(R.rfc3339_to_ts(F.col("x"), lenient=True)),
                value="2026-04-19T10:00:00") == exp


def test_seconds_out_of_range_is_null(spark):
    assert _one(spark, R.seconds_to_ts(F.col("x")), "x long", 10**15) is None
    assert _one(spark, R.ntz(R.seconds_to_ts(F.col("x"))), "x long", 0) == dt.datetime(1970, 1, 1)


def test_int_text_and_delay_overflow(spark):
    for text, want in {"60": 60, "-120": -120, "+5": 5, " 60 ": None, "6a": None,
                       "99999999999": None, None: None}.items():
        assert _one(spark, R.int_text(F.col("x")), value=text) == want, text
    assert _one(spark, R.minutes_to_seconds(F.col("x")), "x int", 3) == 180
    assert _one(spark, R.minutes_to_seconds(F.col("x")), "x int", -2) == -120
    assert _one(spark, R.minutes_to_seconds(F.col("x")), "x int", 40_000_000) is None
    assert _one(spark, R.minutes_to_seconds(F.col("x")), "x int", None) is None


def test_platform_rules(spark):
    df = spark.createDataFrame([(None, "7"), ("7", "7"), ("7", "8"), ("7", None)], "p string, a string")
    ch = [r.c for r in df.select(R.platform_changed_ch(F.col("p"), F.col("a")).alias("c")).collect()]
    at = [r.c for r in df.select(R.platform_changed_at(F.col("p"), F.col("a")).alias("c")).collect()]
    assert ch == [True, False, True, False]
    assert at == [False, False, True, False]
    be = spark.createDataFrame([("1",), ("0",), (None,)], "n string")
    assert [r.c for r in be.select(R.platform_changed_be(F.col("n")).alias("c")).collect()] == [False, True, False]


def test_entity_time_ladder(spark):
    now = dt.datetime(2026, 4, 19, 12, 0, tzinfo=UTC)
    rows = [(None, 1745064000, now), (0, 1745064000, now), (None, 0, now), (1000, 0, now)]
    df = spark.createDataFrame(rows, "e long, f long, c timestamp")
    got = [r.t for r in df.select(R.ntz(R.entity_time(F.col("e"), F.col("f"), F.col("c"))).alias("t")).collect()]
    assert got == [dt.datetime(2025, 4, 19, 12, 0), dt.datetime(1970, 1, 1),
                   dt.datetime(2026, 4, 19, 12, 0), dt.datetime(1970, 1, 1, 0, 16, 40)]


def test_float_widening(spark):
    assert _one(spark, R.widen_float(F.col("x")), "x double", 52.52) == 52.52000045776367


def test_coord_cell_half_away_from_zero(spark):
    vals = spark.createDataFrame([(-2.5e-5,), (0.5e-5,), (50.0000004,), (50.00002,)], "x double")
    assert [r.c for r in vals.select(R.coord_cell(F.col("x")).alias("c")).collect()] == [-3, 1, 5000000, 5000002]


def test_make_point_null_aware(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "lon double, lat double")
    got = [r.p for r in df.select(R.make_point(F.col("lon"), F.col("lat")).alias("p")).collect()]
    assert got[0].srid == 4326 and got[0].lon == 1.0 and got[1] is None
