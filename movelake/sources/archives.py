"""Static-archive catalogue (SRC-14, DED-3).

Archives land as files, one per feed per UTC day; a second fetch of the
same day replaces the first. The catalogue lists them with the binaryFile
source (content column pruned, only metadata read) and keeps the latest
file per (feed, day). Contents are not parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: archive file name pattern, {feed}_{yyyymmdd}.zip.
ARCHIVE_NAME = r"([^/]+)_([0-9]{8})\.zip$"


def archive_catalogue(spark: SparkSession, root: str, pattern: str = ARCHIVE_NAME,
                      glob: str | None = "*.zip") -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root).select("path", "modificationTime", "length")
    files = files.select(F.regexp_extract("path", pattern, 1).alias("feed"),
                         F.regexp_extract("path", pattern, 2).alias("day_text"),
                         "path", "modificationTime", "length").where(F.col("feed") != "")
    latest = files.groupBy("feed", "day_text").agg(
        F.max_by(F.struct("path", "length", "modificationTime"),
                 F.struct("modificationTime", "path")).alias("f"),
        F.count(F.lit(1)).alias("fetches"))
    return latest.select("feed", F.to_date("day_text", "yyyyMMdd").alias("day"),
                         F.col("f.path").alias("path"), F.col("f.length").alias("bytes"),
                         F.col("f.modificationTime").alias("fetched_at"), "fetches")
