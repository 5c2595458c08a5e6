"""Radius filter and point-in-region pairs against a brute-force haversine."""

import math

from pyspark.sql import functions as F

from movelake.operators.filters import filter_within_km
from movelake.operators.joins import within_regions
from movelake.sources import dims


def _hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6371.0 * math.asin(math.sqrt(a))


def _points(spark):
    pts = [(i, -89.5 + (i * 37 % 1790) / 10.0, -179.5 + (i * 101 % 3590) / 10.0) for i in range(3000)]
    return pts, spark.createDataFrame(pts, "id long, latitude double, longitude double")


def test_filter_within_km(spark):
    pts, df = _points(spark)
    got = {r.id for r in filter_within_km(df, 50.0, 10.0, 800.0).collect()}
    want = {i for i, la, lo in pts if _hav(la, lo, 50.0, 10.0) <= 800.0}
    assert got == want and want


def test_within_regions_matches_brute_force(spark):
    pts, df = _points(spark)
    radius = dims.REGION_RADIUS_NM * dims.NM_KM
    got = {(r.id, r.region_idx) for r in within_regions(df, dims.region_grid(spark), radius)
           .select("id", "region_idx").collect()}
    want = {(i, k) for i, la, lo in pts for k, (_, rla, rlo) in enumerate(dims.REGION_GRID)
            if _hav(la, lo, float(rla), float(rlo)) <= radius}
    assert got == want and want
    # the New Zealand point reaches across the antimeridian
    nz = [k for k, (n, _, _) in enumerate(dims.REGION_GRID) if n == "newzealand"][0]
    assert _hav(-41.0, -179.9, -41.0, 175.0) < radius < _hav(-41.0, -178.5, -41.0, 175.0)
    far = spark.createDataFrame([(1, -41.0, -179.9), (2, -41.0, -178.5)],
                                "id long, latitude double, longitude double")
    hits = within_regions(far, dims.region_grid(spark), radius).where(F.col("region_idx") == nz)
    assert [r.id for r in hits.collect()] == [1]
