"""Joins a Spark user needs to reach the reference's results (JOIN-*).

JOIN-1 is a distance (theta) join rewritten as an equi-join: each region
centre is expanded to the 1-degree cells its radius can touch (a fixed,
small table, broadcast), positions carry their own cell, the equi-join on
the cell finds candidates and the exact haversine predicate keeps true
matches. No cross join, no all-pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.functions.geo import haversine_km
from movelake.sources import dims

KM_PER_DEG_LAT = 111.19


def region_cells(regions: DataFrame, radius_km: float) -> DataFrame:
    """(region_idx, region, r_lat, r_lon, cell_lat, cell_lon) for every
    1-degree cell within ``radius_km`` of a region centre (wrapping at the
    antimeridian). Size is bounded by the region list, not by data."""
    dlat = radius_km / KM_PER_DEG_LAT + 0.05
    lat_lo = F.floor(F.greatest(F.col("r_lat") - dlat, F.lit(-90.0)))
    lat_hi = F.floor(F.least(F.col("r_lat") + dlat, F.lit(89.999999)))
    far_lat = F.least(F.abs(F.col("r_lat")) + dlat, F.lit(89.9))
    dlon = F.least(F.lit(dlat) / F.cos(F.radians(far_lat)), F.lit(180.0))
    lon_lo = F.floor(F.col("r_lon") - dlon)
    lon_hi = F.floor(F.col("r_lon") + dlon)
    cells = (regions
             .withColumn("cell_lat", F.explode(F.sequence(lat_lo.cast("int"), lat_hi.cast("int"))))
             .withColumn("cell_lon_raw", F.explode(F.sequence(lon_lo.cast("int"), lon_hi.cast("int")))))
    wrapped = F.pmod(F.col("cell_lon_raw") + 180, F.lit(360)) - 180
    return (cells.withColumn("cell_lon", wrapped).drop("cell_lon_raw")
                 .dropDuplicates(["region_idx", "cell_lat", "cell_lon"]))


def within_regions(points: DataFrame, regions: DataFrame, radius_km: float,
                   lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Every (point, region) pair with distance <= radius_km."""
    cells = F.broadcast(region_cells(regions, radius_km))
    p = (points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
               .withColumn("cell_lat", F.floor(F.col(lat)).cast("int"))
               .withColumn("cell_lon", (F.pmod(F.floor(F.col(lon)) + 180, F.lit(360)) - 180).cast("int")))
    j = p.join(cells, ["cell_lat", "cell_lon"])
    return (j.withColumn("distance_km", haversine_km(F.col(lat), F.col(lon), F.col("r_lat"), F.col("r_lon")))
             .where(F.col("distance_km") <= radius_km)
             .drop("cell_lat", "cell_lon"))


def first_region(points: DataFrame, regions: DataFrame, radius_km: float, keep=None) -> DataFrame:
    """Each covered point with the first region (grid order) within
    ``radius_km``. Map-side only: every 1-degree cell carries the sorted
    array of its candidate regions (a broadcast table bounded by the region
    grid); each point joins its one cell row, the exact haversine test runs
    as an array ``filter``, and the first survivor wins. Points are never
    shuffled."""
    cells = (region_cells(regions, radius_km)
             .groupBy("cell_lat", "cell_lon")
             .agg(F.array_sort(F.collect_list(F.struct("region_idx", "r_lat", "r_lon"))).alias("cands")))
    p = (points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
               .withColumn("cell_lat", F.floor(F.col("latitude")).cast("int"))
               .withColumn("cell_lon", (F.pmod(F.floor(F.col("longitude")) + 180, F.lit(360)) - 180).cast("int")))
    j = p.join(F.broadcast(cells), ["cell_lat", "cell_lon"])
    hit = F.filter("cands", lambda c: haversine_km(F.col("latitude"), F.col("longitude"),
                                                   c["r_lat"], c["r_lon"]) <= radius_km)
    out = j.withColumn("_hit", hit).where(F.size("_hit") > 0)
    cols = [c for c in (keep or points.columns)]
    return out.select(*cols, F.get("_hit", 0)["region_idx"].alias("region_idx"))


def region_coverage(spark, positions: DataFrame, point_key, mover_col: str) -> DataFrame:
    """JOIN-1 / FLT-10: per grid region, positions and distinct movers it
    covers when the first covering region wins."""
    regions = dims.region_grid(spark)
    radius = dims.REGION_RADIUS_NM * dims.NM_KM
    fr = first_region(positions, regions, radius, keep=list(point_key))
    return (fr.groupBy("region_idx")
              .agg(F.count(F.lit(1)).alias("positions"), F.countDistinct(mover_col).alias("movers"))
              .join(F.broadcast(regions.select("region_idx", "region")), "region_idx")
              .select("region", "positions", "movers"))


def attach_station_names(df: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """JOIN-2: endpoint id -> station name. The station list is feed
    configuration (tens of rows), which Spark broadcasts by its size."""
    return df.join(stations, key, "left")

