"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from movelake.session import bound_arrow_batches, scratch_path, ship_package

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of one block of Spark's bitmap functions.
BLOCK = 32768


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def whole(c: str | Column) -> Column:
    """Text with null as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone. ``lower`` would change other alphabets too, so it
    serves only texts of ASCII alone, where it is much faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once per row: inside nested
    lambdas an inlined expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, and any
    executor can be lost afterwards. Unlike ``checkpoint()`` it computes df
    once and keeps columns. An aggregate that is joined back to the rows it
    came from is written first as well: AQE splits a hot key only where both
    sides of the join are plain exchanges."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Ships the package to Python workers and bounds Arrow batches by bytes
    (unless the session already does), so that long texts fit a worker."""
    bound_arrow_batches(spark, 8 << 20)
    ship_package(spark)


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A table of fixed size (bits / 8 bytes at most, whatever the input) in
    which the bit of every key is set; for prefilters whose false hits cost
    work but never change a result. Built by partial aggregation."""
    at = F.pmod(F.col(key), F.lit(bits)) + 1
    return (keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bm_block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bm_bits")))


def with_hit(df: DataFrame, key: Column, bm: DataFrame, bits: int, hit: str) -> DataFrame:
    """df with boolean ``hit`` (a name that df has not): key's bit is set. No shuffle of df: the bitmap
    is broadcast, which its fixed size allows."""
    at, block, held, at_hit = (fresh(df, n) for n in ("bm_at", "bm_block", "bm_bits", "bm_hit"))
    keyed = df.withColumn(at, F.pmod(key, F.lit(bits)) + 1)
    blocks = F.broadcast(bm.select(F.col("bm_block").alias(block), F.col("bm_bits").alias(held)))
    out = keyed.join(blocks, F.bitmap_bucket_number(at) == F.col(block), "left")
    pos = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(held, (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (pos % 8).cast("int"))) != 0
    return out.withColumn(at_hit, F.coalesce(bit, F.lit(False))).drop(at, block, held).withColumnRenamed(at_hit, hit)
