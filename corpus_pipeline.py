"""A training corpus from ``documents``: quality rules, exact and near
de-duplication, removal of repeated passages, packing into sequences.

Each stage works on all that the one before kept. Exact and near
de-duplication leave one row of each group, also where rows repeat a doc_id or
have none.

Defined cases, for every stage: a null text is an empty one (quality drops it);
texts of any length are read whole; of equal or near texts the row of the
largest (exact) or smallest (near) doc_id stays, null last; rows that repeat
doc_id and text leave one; an empty table leaves an empty one; extra columns
come along under any name up to the packing, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movelake.llm import packing, quality
from movelake.llm.common import ascii_lower, bitmap, fresh, table, whole, with_hit, written
from movelake.llm.exact_dedup import exact_dedup
from movelake.llm.queries import packing_digest, tokenizer
from movelake.llm.simhash import fingerprints, near_duplicates
from movelake.llm.substring_dedup import substring_dedup

BITS = 1 << 24


def _touched(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose doc_id may be among ids, and the others, which no shuffle moves."""
    key = F.xxhash64("doc_id")
    hit = fresh(docs, "hit")
    marked = with_hit(docs, key, bitmap(ids.select(F.xxhash64("id").alias("key")), "key", BITS), BITS, hit)
    return marked.where(F.col(hit)).drop(hit), marked.where(~F.col(hit)).drop(hit)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    near, rest = _touched(docs, ids)
    return rest.unionByName(near.join(ids, near["doc_id"].eqNullSafe(ids["id"]), "left_anti"))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ordered = quality.plan_cascade(docs, quality.rules())
    by = fresh(docs, "rejected_by")
    return quality.cascade(docs, ordered, by).where(F.col(by).isNull()).drop(by)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = written(exact_dedup(docs, digest_all=True).select("id", "kept", "sha256"), "pipeline-exact")
    state = written(rows.groupBy("id").agg(F.max("kept").alias("any"), F.min("kept").alias("all")).where("not all"), "pipeline-exact-ids")
    out = _without(docs, state.where("not any").select("id"))
    split = state.where("any").select("id")  # ids of which some rows stay and some go
    if split.isEmpty():
        return out
    near, rest = _touched(out, split)
    stay = rows.where("kept").select("id", "sha256")
    sha = fresh(near, "sha")
    near = near.withColumn(sha, F.sha2(ascii_lower(whole("text")), 256))
    near = (near.join(stay, near["doc_id"].eqNullSafe(stay["id"]) & (near[sha] == stay["sha256"]), "left_semi")
            .dropDuplicates(["doc_id", sha]).drop(sha))
    return rest.unionByName(near)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = written(near_duplicates(docs, shingle=3, distance=2).select("id", "fp", "root"), "pipeline-near")
    # one row of each component stays: of the smallest id, null last, and of its rows there one of the smallest fingerprint
    best = written(rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("top")).select("top.id", "top.fp"), "pipeline-near-best")
    counts = rows.select("id", F.lit(1).alias("n"), F.lit(0).alias("k")).unionByName(best.select("id", F.lit(0).alias("n"), F.lit(1).alias("k")))
    state = written(counts.groupBy("id").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where("k < n"), "pipeline-near-ids")
    out = _without(docs, state.where("k = 0").select("id"))
    split = state.where("k > 0").select("id")  # ids of which some rows stay and some go
    if split.isEmpty():
        return out
    near, rest = _touched(out, split)
    rid = fresh(near, "rid")
    near = written(near.withColumn(rid, F.monotonically_increasing_id()), "pipeline-near-rows")
    pairs = near.select("doc_id", rid).join(fingerprints(near, 3, id_col=rid).withColumnRenamed("id", rid), rid)
    stay = (pairs.join(best, pairs["doc_id"].eqNullSafe(best["id"]) & (pairs["fp"] == best["fp"]), "left_semi")
            .groupBy("doc_id", "fp").agg(F.min(rid).alias(rid)))
    return rest.unionByName(near.join(stay.select(rid), rid, "left_semi").drop(rid).select(*rest.columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring_dedup(docs, window=20, carry=tuple(docs.columns))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("carried.text"))
    columns = {c: F.col("carried")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("carried.n_chars"))
    return out.select(*[c.alias(n) for n, c in columns.items()])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing_digest(packing.pack(packing.tokenize(docs, tokenizer("word_bpe_49k.json"), end_id=1), window=2048))


STAGES = [("quality rules", filter_quality), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("substring dedup", drop_repeated_passages), ("packing", pack_sequences)]

#: Packing places pieces by an iterative fit; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
