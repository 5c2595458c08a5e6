"""Distributed exact percentile_cont vs Spark's percentile and a brute force."""

import random

import pytest

from pyspark.sql import functions as F

from movelake.operators.quantiles import exact_percentiles, interval

PS = [0.0, 0.5, 0.95, 0.99, 1.0]


def _brute(values, p):
    v = sorted(values)
    pos = p * (len(v) - 1)
    lo, hi = int(pos // 1), int(-(-pos // 1))
    return v[lo] + (v[hi] - v[lo]) * (pos - lo)


def test_matches_brute_force_with_hot_group_and_ties(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(3000)]        # hot group, many ties
    rows += [("cold", rnd.random() * 1000) for _ in range(37)]
    rows += [("one", 5.0)]
    rows += [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in exact_percentiles(df, ["g"], "x", PS, steps=7).collect()}
    for g in ("hot", "cold", "one"):
        vals = [x for k, x in rows if k == g and x is not None]
        assert got[g].n == len(vals)
        for i, p in enumerate(PS):
            assert abs(got[g][f"p{i}"] - _brute(vals, p)) < 1e-9, (g, p)


def test_matches_spark_percentile(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.rand(3) * 100).alias("x"))
    mine = {r.g: [r.p0, r.p1, r.p2] for r in exact_percentiles(df, ["g"], "x", [0.5, 0.95, 0.99]).collect()}
    ref = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.5), F.lit(0.95),
                                                                          F.lit(0.99))).alias("q")).collect()}
    for g, vals in ref.items():
        assert all(abs(a - b) < 1e-9 for a, b in zip(mine[g], vals))


def test_latency_percentiles_keeps_empty_table_row(spark):
    import datetime as dt
    from movelake.operators.aggregates import latency_percentiles
    t0 = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)
    rows = [(t0, t0 + dt.timedelta(milliseconds=ms)) for ms in (100, 200, 300, 400)]
    f = spark.createDataFrame(rows, "timestamp timestamp, ingested_at timestamp")
    empty = f.limit(0)
    got = {r.table: r for r in latency_percentiles({"flights": f, "ships": empty}, window=None).collect()}
    assert got["flights"].samples == 4 and got["flights"].p50_ms == 250.0
    assert got["ships"].samples == 0 and got["ships"].p99_ms is None


def test_global_percentile_of_nothing_is_one_null_row(spark):
    df = spark.createDataFrame([], "x double")
    rows = exact_percentiles(df, [], "x", [0.99]).collect()
    assert len(rows) == 1 and rows[0].p0 is None and rows[0].n == 0


def test_weighted_input_equals_expanded_rows(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("a", 2.0, 6), ("b", 7.0, 2), ("b", 9.0, 1)]
    w = spark.createDataFrame(rows, "g string, x double, w long")
    flat = spark.createDataFrame([(g, x) for g, x, n in rows for _ in range(n)], "g string, x double")
    got = {r.g: (r.n, r.p0, r.p1) for r in exact_percentiles(w, ["g"], "x", [0.5, 0.9], weight_col="w").collect()}
    want = {r.g: (r.n, r.p0, r.p1) for r in exact_percentiles(flat, ["g"], "x", [0.5, 0.9]).collect()}
    assert got == want


def test_approx_path_close_to_exact(spark):
    from movelake.operators.aggregates import delay_trend, latency_percentiles
    from movelake.sources import standin
    sf = "/root/testdata/sf0.001"
    t = {"flights": standin.flights(spark, sf)}
    ex = latency_percentiles(t, window=None).first()
    ap = latency_percentiles(t, window=None, approx=True).first()
    assert ap.samples == ex.samples
    for c in ("p50_ms", "p95_ms", "p99_ms"):
        assert abs(ap[c] - ex[c]) <= 0.02 * abs(ex[c]) + 1.0, c
    d = standin.departures(spark, sf)
    a = delay_trend(d, days=None, approx=True)
    e = delay_trend(d, days=None)
    assert a.columns == e.columns and a.count() == e.count()


@pytest.mark.parametrize("setting", ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"])
def test_same_result_whatever_the_planner_reuses(spark, setting):
    x = (F.hash("id") / 7).alias("x")  # negative values, no repeats to speak of
    df = spark.range(0, 60_000, 1, 16).select((F.col("id") % 3).alias("g"), x)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        got = {r.g: [r[f"p{i}"] for i in range(len(PS))] for r in exact_percentiles(df, ["g"], "x", PS).collect()}
    finally:
        spark.conf.set(setting, before)
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, PS))).alias("q")).collect()}
    for g, q in want.items():
        assert got[g] == pytest.approx(q, rel=1e-12)


def test_intervals_never_fall(spark):
    rnd = random.Random(11)
    values = sorted([0.0, -0.0, float("inf"), float("-inf"), 1e300, -1e300, 5e-324]
                    + [rnd.choice((1, -1)) * rnd.random() * 10 ** rnd.randint(-9, 18) for _ in range(2000)]) + [float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "n long, x double").select("n", interval(F.col("x")).alias("i"))
    got = [r.i for r in df.orderBy("n").collect()]
    assert got == sorted(got)


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "g string, x double")
    assert {(r.g, r.p0, r.n) for r in exact_percentiles(df, ["g"], "x", [0.5]).collect()} == {(None, 2.0, 2), ("a", 5.0, 1)}
