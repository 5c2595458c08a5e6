"""Exact de-duplication by progressive refinement: length, then prefix hash,
then full hash; only DataFrame functions.

1. One scan gives each text's length and the hash of its first characters (a
   narrow table). Lengths that occur once are settled.
2. Among the others, (length, prefix hash) pairs that occur once are settled.
3. The second scan hashes whole texts, but only where the pair's bit is set in
   a bitmap of fixed size (2 MiB by default), so no text is shuffled and a
   false hit merely costs a hash. Groups of (length, full hash) are the result.

All groupings are sums with map-side partial aggregation, so a group with a
third of all rows shuffles one row per task; the result's join back to rows is
a plain left join whose hot keys AQE splits.

Defined cases: a null text is an empty one; all empty texts are one group. A
null id sorts below all others. Where rows repeat an id and a text, one of
them stays. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.llm.common import ascii_lower, bitmap, whole, with_hit, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64,
                bits: int = 1 << 24, digest_all: bool = False) -> DataFrame:
    """One row per row of docs: id, keep_id (largest id of the group), group_size,
    kept, sha256 (of the normalised text; null where refinement settled the row
    before the full hash, unless ``digest_all``)."""
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    pair = (F.octet_length("text").alias("len"),  # normalising keeps the length
            F.xxhash64(ascii_lower(F.substring("text", 1, prefix))).alias("pre"))

    narrow = written(texts.select(*pair), "dedup-narrow")
    lengths = narrow.groupBy("len").count().where("count > 1")
    pairs = (with_hit(narrow, F.col("len"), bitmap(lengths, "len", bits), bits, "again").where("again")
             .groupBy("len", "pre").count().where("count > 1").select(F.xxhash64("len", "pre").alias("key")))

    scan = with_hit(texts.select("id", "text", *pair), F.xxhash64("len", "pre"), bitmap(pairs, "key", bits), bits, "open")
    full = F.sha2(ascii_lower(F.col("text")), 256)
    hashed = written(scan.select("id", F.monotonically_increasing_id().alias("rid"), "len", "open",
                                 (full if digest_all else F.when(F.col("open"), full)).alias("sha256")), "dedup-hashed")

    # a settled row joins nothing; its own key keeps nulls from meeting in one task
    keyed = hashed.withColumn("key", F.coalesce("sha256", F.concat(F.lit("-"), F.col("rid"))))
    groups = written(hashed.where("open").groupBy(F.col("sha256").alias("key"), "len")
                     .agg(F.max(F.struct("id", "rid")).alias("top"), F.count("*").alias("n")).where("n > 1"), "dedup-groups")
    joined = keyed.join(groups, ["key", "len"], "left")
    alone = F.col("top").isNull()
    return joined.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("top.rid"))).alias("kept"), "sha256")
