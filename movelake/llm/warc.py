"""WARC archives: written by Spark's text writer, read by boundary-chain
verification; only DataFrame functions.

Writing: of records with equal payloads of at least ``least`` bytes, the one
with the smallest id is a response, the others revisit it. Payload digests are
compared as narrow rows; html is shuffled only for rows whose digest's bit is
set in a bitmap (fixed size) of repeated digests. Each task writes records as
text lines ended by the two line breaks that end a record.

Reading: files are split at will. Every occurrence of the version line starts a
candidate record, also one inside a payload. Each task emits its candidates
with their lengths; sums of lengths give each candidate's offset, and its
header's Content-Length the offset of its successor. Pointer jumping from
offset 0 of every file (successors of successors, doubled each round) keeps
the candidates reachable from there, and no others. A payload that holds a
version line itself was cut there and is put together from its candidates.

Defined cases: a null payload is an empty one; null ids are written empty and
read as null, and never the smallest; rows that repeat the smallest id are all
responses; line breaks in URLs are percent-encoded; an empty table gives no
record. Records after a damaged header, or past a truncated file's end, are
unreachable and not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from movelake.llm.common import bitmap, whole, with_hit, written

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BITS = 1 << 24


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least: int = 100, date: str = "1970-01-01T00:00:00Z", records_per_file: int = 100_000) -> None:
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), whole(payload_col).alias("payload"))
    digest, n = F.sha2("payload", 256), F.octet_length("payload")
    narrow = written(given.select("id", digest.alias("digest"), n.alias("n")).where(F.col("n") >= least), "warc-digests")
    groups = written(narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "warc-groups")

    scan = given.withColumn("digest", digest).withColumn("n", n)
    bm = bitmap(groups.select(F.xxhash64("digest").alias("key")), "key", BITS)
    marked = with_hit(scan, (F.xxhash64("digest")), bm, BITS, "hit")
    alone = marked.where(~F.col("hit") | (F.col("n") < least)).withColumn("first", F.lit(None).cast(given.schema["id"].dataType))
    shared = marked.where(F.col("hit") & (F.col("n") >= least)).join(groups, "digest", "left")
    rows = alone.unionByName(shared)

    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    uri = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit(VERSION), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", urn("id")),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Refers-To", urn("first")), line("WARC-Profile", F.lit(REVISIT)))).otherwise(""),
        line("Content-Type", F.lit("text/html")), F.lit("Content-Length: "), F.when(again, F.lit("0")).otherwise(F.col("n").cast("string")),
        F.lit(END), F.when(again, "").otherwise(F.col("payload")))
    (rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path))


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1), F.lit(""))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between version lines, with file, block and order in it."""
    return (spark.read.option("lineSep", VERSION).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
            .withColumn("nr", F.monotonically_increasing_id()).withColumn("n", F.octet_length("value").cast("long")))


def _with_offsets(chunks: DataFrame) -> DataFrame:
    """chunks with ``off``: where their version line starts (negative: none before them)."""
    step = len(VERSION)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    c = chunks.withColumn("here", F.coalesce(F.sum(F.col("n") + step).over(before(Window.partitionBy("file", "block").orderBy("nr"))), F.lit(0)))
    blocks = chunks.groupBy("file", "block").agg(F.sum(F.col("n") + step).alias("s"))
    base = blocks.select("file", "block", F.coalesce(F.sum("s").over(before(Window.partitionBy("file").orderBy("block"))), F.lit(0)).alias("base"))
    return c.join(base, ["file", "block"]).withColumn("off", F.col("base") + F.col("here") - step).drop("base", "here")


def _headed(chunks: DataFrame) -> DataFrame:
    head = F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1))
    return (chunks.withColumn("head", head).withColumn("length", _field(F.col("head"), "Content-Length").cast("long"))
            .withColumn("at", F.octet_length("head") + len(END)))


def _body(value: Column) -> Column:
    return F.substring(value.cast("binary"), (F.col("at") + 1).cast("int"), F.col("length").cast("int"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate: file, off, next (offset of the successor, null if the
    header is none), header fields, length, and digest where the payload holds
    no version line (``complete``). Payloads stay with their task."""
    c = _headed(_chunks(spark, path))
    complete = F.coalesce(F.col("n") >= F.col("at") + F.col("length"), F.lit(False))
    urn = lambda name: F.nullif(F.regexp_extract(_field(F.col("head"), name), r"^<urn:page:(.*)>$", 1), F.lit(""))
    c = c.select("file", "block", "nr", "n", "at", "length", complete.alias("complete"),
                 F.when(complete, F.sha2(_body(F.col("value")), 256)).alias("digest"),
                 _field(F.col("head"), "WARC-Type").alias("type"), urn("WARC-Record-ID").alias("id"), urn("WARC-Refers-To").alias("refers_to"),
                 _field(F.col("head"), "WARC-Payload-Digest").alias("stated"), _field(F.col("head"), "WARC-Target-URI").alias("uri"))
    c = _with_offsets(written(c, "warc-candidates")).where("off >= 0")
    return written(c.withColumn("next", F.col("off") + len(VERSION) + F.col("at") + F.col("length") + len(END)), "warc-offsets")


def reachable(found: DataFrame, rounds: int = 64) -> DataFrame:
    """(file, off) of the candidates on the chain from offset 0, by pointer jumping."""
    state = written(found.select("file", "off", "next", (F.col("off") == 0).alias("kept")), "warc-chain")
    kept = state.where("kept").count()
    for _ in range(rounds):
        jump = state.select("file", F.col("off").alias("next"), F.col("next").alias("onward"))
        marks = state.where("kept").select("file", F.col("next").alias("off"), F.lit(True).alias("mark"))
        state = written(state.join(marks, ["file", "off"], "left").join(jump, ["file", "next"], "left")
                        .select("file", "off", F.col("onward").alias("next"), (F.col("kept") | F.coalesce("mark", F.lit(False))).alias("kept")), "warc-chain")
        before, kept = kept, state.where("kept").count()
        if kept == before:
            return state.where("kept").select("file", "off")
    raise RuntimeError(f"warc: chain not settled after {rounds} rounds")


def payloads(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """file, off, payload (binary) of the given records, put together from all
    candidates between a record and its successor. Reads only their files."""
    files = records.select("file").distinct()
    parts = _with_offsets(_chunks(spark, path).join(files, "file", "left_semi")).where("off >= 0")
    starts = records.select("file", F.col("off").alias("start"), (F.col("next") - len(END)).alias("stop"))
    inside = parts.join(starts, (parts["file"] == starts["file"]) & (parts["off"] >= F.col("start")) & (parts["off"] < F.col("stop"))).drop(parts["file"])
    whole_ = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("off", "value"))), lambda x: x["value"]), VERSION)
    back = _headed(inside.groupBy("file", F.col("start").alias("off"), "stop").agg(whole_.alias("value")))
    return back.select("file", "off", _body(F.col("value")).alias("payload"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under path: file, off, id, type, refers_to, uri,
    payload_bytes and payload_digest of the payload itself, and both of the
    record it revisits for a revisit."""
    found = candidates(spark, path)
    records = written(found.join(reachable(found), ["file", "off"]), "warc-records")
    split = records.where(~F.col("complete"))
    if not split.isEmpty():
        again = payloads(spark, path, split).where(F.octet_length("payload") > 0).select("file", "off", F.sha2("payload", 256).alias("joined"))
        records = records.join(again, ["file", "off"], "left").withColumn("digest", F.coalesce("digest", "joined")).drop("joined")
    own = records.select("file", "off", "id", "type", "refers_to", "uri", "length", "digest", "stated")
    revisits = own.where("type = 'revisit'")
    # by id and stated digest, as rows may repeat an id; by id alone where a revisit states none
    sources = written(own.where("type = 'response'").join(revisits.select(F.col("refers_to").alias("id")).distinct(), "id", "left_semi")
                      .groupBy(F.col("id").alias("refers_to"), F.coalesce("stated", F.concat(F.lit("sha256:"), F.col("digest"))).alias("stated"))
                      .agg(F.min(F.struct("length", "digest")).alias("source")), "warc-sources")
    by_id = sources.groupBy("refers_to").agg(F.min("source").alias("source"))
    plain = own.where("type != 'revisit'").withColumn("source", F.lit(None).cast(sources.schema["source"].dataType))
    both = (plain.unionByName(revisits.where("stated is not null").join(sources, ["refers_to", "stated"], "left"))
            .unionByName(revisits.where("stated is null").join(by_id, "refers_to", "left")))
    return both.select("file", "off", "id", "type", "refers_to", "uri",
                       F.coalesce("source.length", "length").alias("payload_bytes"), F.coalesce("source.digest", "digest").alias("payload_digest"))
