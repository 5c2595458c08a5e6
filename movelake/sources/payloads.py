"""Landed payload handling shared by all normalisation jobs.

``landed(source, endpoint, cycle_ts, seq, status, body)`` holds one HTTP
response or stream frame per row. Only 2xx responses are parsed (SRC-15);
a document that does not parse cleanly against its feed's schema is
rejected whole, like a strict deserialiser would, and routed to the dead
letter (DQ-1) with its reason (DQ-2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CORRUPT = "_corrupt"
LANDED_KEYS = ["source", "endpoint", "cycle_ts", "seq"]


def landed_ok(landed: DataFrame) -> DataFrame:
    """SRC-15: successful responses only; a failed endpoint never fails its
    siblings (rows are independent)."""
    return landed.where(F.col("status").between(200, 299))


def parse_all(landed: DataFrame, schema_ddl: str, body: str = "body") -> DataFrame:
    """Every landed row, 2xx bodies parsed against ``schema_ddl``; adds ``doc``
    (the parsed struct, NULL for a failed response) and ``_corrupt`` (the raw
    text when the document failed to parse or had a wrong-typed field)."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ddl = f"{schema_ddl}, {CORRUPT} string"
    ok = F.when(F.col("status").between(200, 299), F.col(body))
    # Spark takes a filter below a projection by repeating its expressions, so
    # that each condition on ``doc`` would parse the body again. It takes none
    # below a generator: an array of one document is parsed once.
    doc = F.inline(F.array(F.struct(F.from_json(ok, ddl, opts).alias("doc"))))
    return landed.select("*", doc).withColumn(CORRUPT, F.col(f"doc.{CORRUPT}"))


def parse(landed: DataFrame, schema_ddl: str, body: str = "body") -> DataFrame:
    """The 2xx part of ``parse_all``. Rows that are parsed already (by
    ``parse_all``, kept by a job that needs both the rows and the rejects) are
    taken as they are."""
    if CORRUPT in landed.columns:
        return landed_ok(landed)
    return parse_all(landed_ok(landed), schema_ddl, body)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull() & F.col("doc").isNotNull())


def reject_reason(extra_reject=None):
    """Why a document (of ``parse_all``) yields no rows, NULL if it does:
    ``http_status`` (non-2xx), ``corrupt`` (parse/type failure), or a feed rule
    ``extra_reject`` = (Column over doc, reason)."""
    reason = (F.when(~F.coalesce(F.col("status").between(200, 299), F.lit(False)), F.lit("http_status"))
              .when(F.col(CORRUPT).isNotNull() | F.col("doc").isNull(), F.lit("corrupt")))
    return reason if extra_reject is None else reason.when(extra_reject[0], F.lit(extra_reject[1]))


def rejected(landed: DataFrame, schema_ddl: str, extra_reject=None) -> DataFrame:
    """Every landed document that yields no rows, with its reason, in one pass
    (over documents that are parsed already, if ``landed`` holds such)."""
    p = landed if CORRUPT in landed.columns else parse_all(landed, schema_ddl)
    return (p.withColumn("reason", reject_reason(extra_reject)).where(F.col("reason").isNotNull())
             .select(*LANDED_KEYS, "status", "body", "reason"))


def dead_letter(rejects: DataFrame, path: str) -> int:
    """DQ-1: append rejected documents as JSON lines for replay; returns the
    number written (counted on the write itself)."""
    from pyspark.sql import Observation
    obs = Observation("dead_letter")
    (rejects.observe(obs, F.count(F.lit(1)).alias("n"))
            .write.mode("append").option("compression", "gzip")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path))
    return int(obs.get.get("n", 0) or 0)


def read_dead_letter(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema("source string, endpoint string, cycle_ts timestamp, seq long, status int, body string, reason string")
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path))


def left_out(parsed: DataFrame, records: dict, extra_reject=None) -> DataFrame:
    """DQ-2: (source, level, reason, rows) of all that yields no rows, in one
    pass: documents by reject reason, and the records of accepted documents that
    a feed's rules leave out (``records`` counts them in a parsed document)."""
    reason = reject_reason(extra_reject)
    names = ["http_status", "corrupt", *([extra_reject[1]] if extra_reject and extra_reject[1] != "corrupt" else [])]
    counts = [F.struct(F.lit("document").alias("level"), F.lit(k).alias("reason"), F.count_if(F.col("reject") == k).alias("rows")) for k in names]
    counts += [F.struct(F.lit("record").alias("level"), F.lit(k).alias("reason"),
                        F.coalesce(F.sum(F.when(F.col("reject").isNull(), c)), F.lit(0)).cast("long").alias("rows")) for k, c in records.items()]
    return (parsed.withColumn("reject", reason).groupBy("source").agg(F.array(*counts).alias("counts"))
            .select("source", F.inline("counts")).where("rows > 0"))
