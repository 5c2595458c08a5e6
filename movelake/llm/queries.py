"""Registered queries of the subpackage: thin digests of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from movelake.llm import bpe, embedding_dedup, filter_audit, packing, quality, ranked_search, toxicity, url_filter, warc
from movelake.llm.common import table
from movelake.llm.exact_dedup import exact_dedup
from movelake.llm.simhash import near_duplicates
from movelake.llm.substring_dedup import substring_dedup
from movelake.llm.token_counts import count_tokens
from movelake.session import scratch_path

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = substring_dedup(table(spark, sf, "documents"), window=20)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf, "pages"), path)
    return warc.read_warc(spark, path).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"))


@register
def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = exact_dedup(table(spark, sf, "documents"), digest_all=True)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


@register
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    tokens = packing.tokenize(table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return packing_digest(packing.pack(tokens, window=2048))


def packing_digest(out: DataFrame) -> DataFrame:
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@register
def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return (url_filter.filter_urls(table(spark, sf, "pages"), rules)
            .select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict"))


def held_out(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


@register
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    out = toxicity.score(table(spark, sf, "documents"), labels)
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ordered = quality.plan_cascade(docs, quality.rules(counted=True), prepared=quality.with_counts)
    judged = quality.cascade(quality.with_counts(docs), ordered)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


@register
def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    out = bpe.encode(table(spark, sf, "documents"), path, round_trip=True)
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = count_tokens(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@register
def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    out = near_duplicates(table(spark, sf, "documents"), shingle=3, distance=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@register
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


@register
def op11_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(table(spark, sf, "embeddings"), threshold=0.95)
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@register
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    out = ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)
    return out.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


@register
def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(filter_audit.mask_counts(table(spark, sf, "documents"), table(spark, sf, "labels")))
