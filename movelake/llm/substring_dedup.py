"""Duplicate passages by an index of all text: the windows that start earlier elsewhere.

Not a greedy Lempel-Ziv parse: what goes is decided window by window; the
``factors`` given are those windows joined, not longest matches.

A window is ``window`` consecutive words of one document; a word goes if it is
in a window whose words also start earlier (smaller id, or same id and earlier).

* Blocks. Each window is governed by the smallest hash among its k-word grams
  (leftmost of equals), so equal windows are governed alike. Consecutive
  windows governed by one gram form a phrase: at most ``window - k + 1``
  windows, found without looking at any other document.
* Index. Phrases whose gram occurs once anywhere cannot repeat; grams are
  counted over all text, and those that repeat pass on through a bitmap of
  fixed size (a false hit only adds work). The others are indexed by (gram,
  hash of the phrase's words): the reference holds each phrase once, with its
  earliest place.
* Factors. A phrase that is not its reference's earliest copies it whole:
  neighbouring phrases with one source and displacement form one factor.
* Boundaries. Where phrases differ but share a gram (a passage's edges), the
  reference phrases' windows are compared one by one, each against its
  earliest place; they become factors too.

All groupings are minima and counts with map-side partial aggregation, joined
back by plain joins whose hot keys AQE splits; a phrase that a third of all
documents hold is one reference row. Texts are shuffled only for documents that
have a factor (again by bitmap). Keys are two 64-bit hashes (gram and window,
or gram and phrase).

Defined cases: a null or empty text has no words; rows without an id have no
place in the order and stay whole. Rows that repeat an id with another text are
documents of their own, in the order of their texts' hashes; rows that repeat id
and text are one document laid over itself, so neither removes the other. Texts
shorter than a window stay whole; texts of any length are read whole, one at a
time. Extra columns are not read unless carried, under whatever name. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from movelake.llm import pieces
from movelake.llm.common import BLOCK, bitmap, python_ready, whole, with_hit, written

#: Odd multipliers of the window hash and of the gram hash.
_D = 0x9E3779B97F4A7C15
_G = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_D, -1, 1 << 64)
GRAM_BITS = 1 << 27
ID_BITS = 1 << 24


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    return (h ^ h >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.multiply.accumulate(out)


def phrases(texts: list[str], window: int, k: int) -> tuple[np.ndarray, ...]:
    """For all phrases of the texts: text number, first window (word number in
    its text), number of windows, gram hash, phrase hash; and all their
    windows' hashes one after the other."""
    import xxhash

    words = [t.encode().split() for t in texts]
    n = np.array([len(w) for w in words], "i8")
    flat = [x for w in words for x in w]
    empty = np.zeros(0, "i8")
    if len(flat) < window:
        return empty, empty, empty, empty.astype("u8"), empty.astype("u8"), empty.astype("u8")
    h = np.fromiter(map(xxhash.xxh64_intdigest, flat), "u8", len(flat))
    of = np.repeat(np.arange(len(texts)), n)
    begin = np.cumsum(n) - n

    grams = np.zeros(len(h) - k + 1, "u8")
    for j, c in enumerate(_powers(_G, k)):
        grams += h[j:len(grams) + j] * c
    grams = _mix(grams)
    span = window - k + 1
    starts = np.flatnonzero(of[:len(h) - window + 1] == of[window - 1:])
    if not len(starts):
        return empty, empty, empty, empty.astype("u8"), empty.astype("u8"), empty.astype("u8")
    least = np.empty(len(h) - window + 1, "u8")
    least[:] = grams[:len(least)]
    at = np.zeros(len(least), "i8")
    for j in range(1, span):  # leftmost smallest gram of every window
        g = grams[j:len(least) + j]
        less = g < least
        np.copyto(least, g, where=less)
        at[less] = j
    centre = starts + at[starts]

    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(h * _powers(_D, len(h)))])
    back = _powers(_INVERSE, len(h) + 1)
    windows = _mix((sums[starts + window] - sums[starts]) * back[starts])

    first = np.flatnonzero(np.diff(centre, prepend=-1))
    count = np.diff(first, append=len(starts))
    s = starts[first]
    inside = (centre[first] - s).astype("u8")
    phrase = _mix((sums[s + count + window - 1] - sums[s]) * back[s] + inside * np.uint64(_G) + count.astype("u8"))
    return of[s], s - begin[of[s]], count, grams[centre[first]], phrase, windows


def _gram_counts(given: DataFrame, window: int, k: int, batch_bytes: int) -> DataFrame:
    def run(batches):
        for _, texts in pieces.by_bytes(batches, "text", batch_bytes):
            gram, n = np.unique(phrases(texts, window, k)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view("i8")), pa.array(n.astype("i8"))], ["gram", "n"])

    return given.select("text").mapInArrow(run, "gram long, n long")


def _open_phrases(given: DataFrame, window: int, k: int, batch_bytes: int, bits, with_windows: bool) -> DataFrame:
    """Phrases whose gram's bit is set."""
    def run(batches):
        seen = np.frombuffer(bits.value, "u1")
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            of, start, count, gram, phrase, windows = phrases(texts, window, k)
            bit = gram & np.uint64(8 * len(seen) - 1)
            hit = (seen[(bit >> np.uint64(3)).astype("i8")] >> (bit & np.uint64(7)).astype("u1") & 1).astype(bool)
            row = pa.array(of[hit])
            columns = [pa.array(gram[hit].view("i8")), pa.array(phrase[hit].view("i8")), batch.column(0).take(row), batch.column(1).take(row),
                       pa.array(start[hit].astype("i4")), pa.array(count[hit].astype("i4"))]
            if with_windows:
                ends = np.cumsum(count[hit])
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype("i4")),
                                                        pa.array(windows[np.repeat(hit, count)].view("i8"))))
            yield pa.RecordBatch.from_arrays(columns, ["gram", "phrase", "id", "h", "start", "n", "windows"][:len(columns)])

    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"gram long, phrase long, id {kind}, h long, start int, n int" + ", windows array<long>" * with_windows)


def _repeated_bits(given: DataFrame, window: int, k: int, batch_bytes: int, n_bits: int):
    """Broadcast bitmap (n_bits / 8 bytes) of grams that occur twice or more."""
    repeated = _gram_counts(given, window, k, batch_bytes).groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    bits = np.zeros(n_bits // 8, "u1")
    for r in bitmap(repeated, "gram", n_bits).toLocalIterator():  # one block at a time
        at = (r["bm_block"] - 1) * (BLOCK // 8)
        bits[at:at + BLOCK // 8] = np.frombuffer(bytes(r["bm_bits"]), "u1")
    return given.sparkSession.sparkContext.broadcast(bits.tobytes())


def copied(given: DataFrame, window: int, k: int, batch_bytes: int) -> DataFrame:
    """id, h, start, n, source_id, source_start: runs of windows that start
    earlier elsewhere. given: id, h (hash of the text), text."""
    bits = _repeated_bits(given, window, k, batch_bytes, GRAM_BITS)
    open_ = _open_phrases(given, window, k, batch_bytes, bits, with_windows=True)
    index = written(open_.groupBy("gram", "phrase").agg(F.min(F.struct("id", "h", "start")).alias("first"), F.count("*").alias("c"),
                                                        F.first("windows").alias("windows")), "rlz-index")

    several = written(index.groupBy("gram").count().where("count > 1").select("gram"), "rlz-several")
    edges = index.join(several, "gram", "left_semi").select("gram", "first", F.posexplode("windows").alias("i", "w"))
    edges = edges.select("gram", "w", F.struct("first.id", "first.h", (F.col("first.start") + F.col("i")).alias("start")).alias("place"))
    earliest = written(edges.groupBy("gram", "w").agg(F.min("place").alias("source"), F.count("*").alias("c")).where("c > 1").drop("c"), "rlz-edges")
    single = (edges.join(earliest, ["gram", "w"]).where("place != source")
              .select("place.id", "place.h", "place.start", F.lit(1).alias("n"), F.col("source.id").alias("source_id"), F.col("source.start").alias("source_start")))

    reference = index.where("c > 1").select("gram", "phrase", "first")
    again = (_open_phrases(given, window, k, batch_bytes, bits, with_windows=False).join(reference, ["gram", "phrase"])
             .where(F.struct("id", "h", "start") != F.col("first"))
             .select("id", "h", "start", "n", F.col("first.id").alias("source_id"), F.col("first.start").alias("source_start")))
    return again.unionByName(single)


def _factors(runs: list[dict], window: int) -> list[dict]:
    """Runs in order of start, neighbours with one source and displacement joined."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: r["start"]):
        if out and out[-1]["source_id"] == r["source_id"] and out[-1]["start"] + out[-1]["length"] - window + 1 == r["start"] \
                and r["start"] - out[-1]["start"] == r["source_start"] - out[-1]["source_start"]:
            out[-1]["length"] += r["n"]
        else:
            out.append({"start": r["start"], "length": r["n"] + window - 1, "source_id": r["source_id"], "source_start": r["source_start"]})
    return out


def substring_dedup(docs: DataFrame, window: int = 20, k: int = 6, id_col: str = "doc_id", text_col: str = "text",
                    batch_bytes: int = 2 << 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, n_words, n_removed, kept (the words that stay, joined by one space) and
    factors (start, length in words, source_id, source_start) per row of docs;
    ``carry``: columns of docs that come along, as one struct ``carried``."""
    python_ready(docs.sparkSession)
    carried = F.struct(*carry) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"), carried.alias("carried")).withColumn("h", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    runs = copied(rows.select("id", "h", "text").where("id is not null"), window, k, batch_bytes)
    # a set, so that rows which repeat id and text add nothing to their document's runs
    by_doc = written(runs.groupBy("id", "h").agg(F.collect_set(F.struct("start", "n", "source_id", "source_start")).alias("runs")), "rlz-runs")

    key = F.xxhash64("id", "h")
    marked = with_hit(rows, key, bitmap(by_doc.select(key.alias("key")), "key", ID_BITS), ID_BITS, "hit")
    plain = marked.where("not hit").select("id", "text", "carried", F.lit(None).cast(by_doc.schema["runs"].dataType).alias("runs"))
    both = plain.unionByName(marked.where("hit").join(by_doc, ["id", "h"], "left").select("id", "text", "carried", "runs"))

    factor = f"array<struct<start:int,length:int,source_id:{kind},source_start:int>>"
    out_kind = f"id {kind}, n_words long, n_removed long, kept string, factors {factor}, carried {rows.schema['carried'].dataType.simpleString()}"
    schema = to_arrow_schema(StructType.fromDDL(out_kind))

    def run(batches):
        for whole_batch in batches:
            for batch, texts in pieces.by_bytes([whole_batch], "text", batch_bytes):
                n, removed, kept, factors = [], [], [], []
                for text, found in zip(texts, batch.column(3).to_pylist()):
                    words = text.encode().split()
                    n.append(len(words))
                    if found:
                        edge = np.zeros(len(words) + 1, "i8")
                        for r in found:
                            edge[r["start"]] += 1
                            edge[r["start"] + r["n"] + window - 1] -= 1
                        gone = np.cumsum(edge[:-1]) > 0
                        removed.append(int(gone.sum()))
                        words = [words[i] for i in np.flatnonzero(~gone)]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words).decode())
                    factors.append(_factors(found or [], window))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                                                  pa.array(factors, schema.field("factors").type), batch.column(2)], schema=schema)

    return both.mapInArrow(run, out_kind)
