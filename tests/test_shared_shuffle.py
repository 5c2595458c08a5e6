"""Documents of several feeds come from rows that are shuffled once, as they
are stored: texts are made after the shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from movelake import jobs
from movelake.operators import aggregates as agg
from movelake.plans import catalog
from movelake.sources import landed, payloads

BOARDS = ("board_ch", "board_be", "board_at")
AT = dt.datetime(2026, 4, 19, 12, 0, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables; some lines and events come twice."""
    path = str(tmp_path_factory.mktemp("tables"))
    i, day = F.col("id"), F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") % 5 * 86400)
    pick = lambda *v: F.get(F.array(*map(F.lit, v)), (i % len(v)).cast("int"))
    rows = {
        "nation": spark.range(3).select(i.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), i).alias("n_name")),
        "customer": spark.range(9).select(i.alias("c_custkey"), (i % 3).cast("int").alias("c_nationkey"), pick("MACHINERY", "HOUSEHOLD", "BUILDING", "AUTOMOBILE").alias("c_mktsegment")),
        "orders": spark.range(600).select(i.alias("o_orderkey"), (i % 9).alias("o_custkey"), day.alias("o_orderdate")),
        "lineitem": spark.range(2400).union(spark.range(40)).select((i % 600).alias("l_orderkey"), (i * 7).alias("l_partkey"), (i % 4 + 1).cast("int").alias("l_linenumber"),
                                             (i % 50 + 1).cast("double").alias("l_quantity"), pick("N", "R", "A").alias("l_returnflag"), pick("O", "F").alias("l_linestatus"), day.alias("l_shipdate")),
        "events": spark.range(900).union(spark.range(20)).select(i.alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + i * 20).alias("ts"), (i % 50).alias("user_id"),
                                          pick("view", "click", "signup", "purchase", "error").alias("event_type"), (i % 97 / 2).alias("value")),
        "part": spark.range(200).select(i.alias("p_partkey"), F.lit("x").alias("p_name"), (i % 50).cast("int").alias("p_size"), (i / 10).alias("p_retailprice")),
    }
    for name, df in rows.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan):
    return [line for line in plan.split("\n") if "- Exchange hashpartitioning(" in line and "REPARTITION" in line]


def test_boards_share_one_shuffle_of_stored_rows(spark, sf):
    plan = final_plan(agg.union_all([jobs.left_out(f, catalog.LANDINGS[f](spark, sf)) for f in BOARDS]))
    assert len(shuffles(plan)) == 1
    assert len(shuffles(final_plan(agg.union_all([jobs.FEEDS[f][2](catalog.LANDINGS[f](spark, sf)) for f in BOARDS])))) == 1


@pytest.mark.parametrize("feed", [f for f in catalog.LANDINGS if f not in ("ship_frames", "orbits", "gtfs_rt")])
def test_texts_are_made_after_the_shuffle(spark, sf, feed):
    plan = catalog.LANDINGS[feed](spark, sf)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(", 1)
    assert "ToJson" in above and "ToJson" not in below and "MapInArrow" not in plan


def test_all_rejects_are_written_at_once(spark, sf, monkeypatch):
    written, real = [], payloads.dead_letter
    monkeypatch.setattr(payloads, "dead_letter", lambda rejects, path: (written.append(rejects), real(rejects, path))[1])
    got = catalog.q_dead_letter_all(spark, sf)
    assert len(written) == 1
    want = [r for f, land in catalog.LANDINGS.items() for r in jobs.FEEDS[f][2](land(spark, sf)).select("source", "endpoint", "seq", "status", "reason").collect()]
    assert sorted(got.select("source", "endpoint", "seq", "status", "reason").collect()) == sorted(want)
    assert {r.source for r in want} >= {*BOARDS, "gtfs_rt", "orbits", *landed.FEEDS}


@pytest.mark.parametrize("dealt", [False, True])
def test_documents_of_many_records(spark, dealt):
    """Longer than a block and than a block of blocks, equal orders, null keys."""
    sizes = {("a", 0, AT): 1, ("a", 1, AT): landed.BLOCK, ("b", 1, AT): landed.BLOCK + 1, ("b", 0, None): 3, (None, 0, AT): landed.BLOCK ** 2 * 2 + 5}
    rows = [(i, e, 100, ts, p, k // 2, f"r{k * 7919 % 1000}") for i, ((e, p, ts), n) in enumerate(sizes.items()) for k in range(n)]
    r = spark.createDataFrame(rows, "endpoint_idx int, endpoint string, cycle_no long, cycle_ts timestamp, page long, event_id long, rec string").repartition(3)
    r = r.repartition(2, "page") if dealt else r
    d = landed.documents(r, "s", "ac", dealt=dealt)
    want = {}
    for i, e, _, ts, p, k, rec in sorted(rows, key=lambda x: (x[0], x[5], x[6])):
        want.setdefault((e, i * 1_000_000_000 + p), []).append(rec)
    got = {(x.endpoint, x.seq): x.body and x.body.split('"ac":')[1] for x in d.collect()}
    assert len(got) == d.count() == len(sizes)
    assert {k: v for k, v in got.items() if v} == {k: f"[{','.join(v)}]}}" for k, v in want.items() if len(v) != 3}
