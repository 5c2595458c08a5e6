"""SimHash near-duplicates by anchor-point covering.

A fingerprint's bits are the majority of its shingles' hash bits. Two blocks of
23 bits are each covered by the perfect binary Golay code: every block value is
within 3 of exactly one codeword. A pair of codewords is an anchor; a
fingerprint's home is the anchor within radius 3 in both blocks. Fingerprints
that differ in at most t bits spread these over the blocks, so each lies within
(3 + i, 3 + j), i + j <= t, of the other's home. Every distinct fingerprint is
replicated to all those anchors (61 on average for t = 2) and compared, per
anchor, with the fingerprints at home there.

Anchors where more than ``crowd`` distinct fingerprints are at home (one large
group of near copies) are split by a second pair of codewords, over bits 18 to
63, in the same way: of two fingerprints within t bits each lies in reach of the
other's second home too, so they meet under (anchor, second anchor). That is
exact for any t; what is still together there agrees in all 64 bits but for a
few, and is joined as rows, never gathered.

Equal fingerprints are one node from the start, so copies add no pairs. The
links' components are found by alternating stars.

Defined cases: null, empty and blank texts have fingerprint 0, linked like any
other; fewer words than a shingle count as one shingle; null ids are passed
over when the smallest id is sought (null if there is no other); repeated rows
are each returned; an empty table gives an empty result. Texts of any length
are read whole, in chunks of shingles; columns other than id and text are not
read and may have any name.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from movelake.llm import pieces
from movelake.llm.common import bitmap, python_ready, whole, with_hit, written
from movelake.llm.components import components

#: Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101
N, RADIUS = 23, 3
#: First bit of the second pair of blocks: the last two blocks of a fingerprint.
SECOND = 64 - 2 * N
HIT_BITS = 1 << 24


def fingerprint(text: str, shingle: int, seed: int = 42, chunk: int = 1 << 16) -> int:
    """As a signed 64-bit integer."""
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII blanks alone
    if not words:
        return 0
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, "i8")
    grams = map(b" ".join, zip(*(words[i:] for i in range(k))))
    for at in range(0, n, chunk):
        m = min(chunk, n - at)
        h = np.fromiter((digest(next(grams), seed) for _ in range(m)), "<u8", m)
        ones += np.unpackbits(h.view("u1").reshape(m, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 4 << 20) -> DataFrame:
    """id, fp (signed 64 bits) per row."""
    python_ready(docs.sparkSession)

    def run(batches):
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], ["id", "fp"])

    given = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, fp long")


def _remainder(v: np.ndarray) -> np.ndarray:
    """Syndrome: v modulo the generator polynomial."""
    v = v.copy()
    for bit in reversed(range(N - 11)):
        v ^= np.where(v >> (bit + 11) & 1, GOLAY << bit, 0)
    return v


@lru_cache
def _errors(t: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For level 0..t, (patterns, first, number) by syndrome: level 0 has the
    pattern of weight <= 3, level i those of weight 3 + i."""
    every = np.arange(1 << N, dtype="i8")
    weight = np.bitwise_count(every)
    out = []
    for level in range(t + 1):
        p = every[weight <= RADIUS] if level == 0 else every[weight == RADIUS + level]
        s = _remainder(p)
        order = np.argsort(s, kind="stable")
        n = np.bincount(s, minlength=1 << 11)
        out.append((p[order], np.cumsum(n) - n, n))
    return out


def anchors(fp: np.ndarray, t: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for all anchors in reach, of the two blocks from
    bit ``first``; the first len(fp) are homes."""
    mask = (1 << N) - 1
    a, b = fp >> first & mask, fp >> first + N & mask
    sa, sb = _remainder(a), _remainder(b)
    levels, at, found = _errors(t), [], []
    for i in range(t + 1):
        for j in range(t + 1 - i):
            (pa_, fa, na), (pb, fb, nb) = levels[i], levels[j]
            n = na[sa] * nb[sb]
            row = np.repeat(np.arange(len(fp)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            x = a[row] ^ pa_[fa[sa[row]] + k // nb[sb[row]]]
            y = b[row] ^ pb[fb[sb[row]] + k % nb[sb[row]]]
            at.append(row)
            found.append(x << N | y)
    return np.concatenate(at), np.concatenate(found)


def _replicated(rows_df: DataFrame, t: int, name: str = "anchor", first: int = 0, rows: int = 20_000) -> DataFrame:
    """Each row (fp and other longs) once per anchor of fp in reach (t = 0: its home)."""
    kept = rows_df.columns

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                row, anchor = anchors(part.column("fp").to_numpy(zero_copy_only=False), t, first)
                for k in range(0, len(row), 500_000):
                    some = pa.array(row[k:k + 500_000])
                    yield pa.RecordBatch.from_arrays([c.take(some) for c in part.columns] + [pa.array(anchor[k:k + 500_000])], [*kept, name])

    return rows_df.mapInArrow(run, ", ".join(f"{c} long" for c in [*kept, name]))


def _meeting(homes: DataFrame, reach: DataFrame, at: list[str], t: int) -> DataFrame:
    """Links (a, b), a < b, of fingerprints that meet at home and in reach."""
    far = F.bit_count(F.col("h.fp").bitwiseXOR(F.col("r.fp")))
    same = [F.col(f"h.{c}") == F.col(f"r.{c}") for c in at]
    return (reach.alias("r").join(homes.alias("h"), reduce(and_, same, far <= t) & (F.col("h.fp") < F.col("r.fp")))
            .select(F.col("h.fp").alias("a"), F.col("r.fp").alias("b")))


def _in_reach(rows_df: DataFrame, key: Column, homes: DataFrame, home_key: Column) -> DataFrame:
    """rows_df less (most of) what meets no home: before any shuffle."""
    return with_hit(rows_df, key, bitmap(homes.select(home_key.alias("key")), "key", HIT_BITS), HIT_BITS, "hit").where("hit").drop("hit")


def links(nodes: DataFrame, t: int = 2, crowd: int = 64) -> DataFrame:
    """Links (a, b) between all pairs of distinct fingerprints that differ in
    at most t bits."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = nodes.select("fp").repartition(tasks)  # one row becomes many: few small files must not mean few tasks
    homes = written(_replicated(fps, 0), "simhash-homes")
    crowded = written(homes.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "simhash-crowded")
    reach = _in_reach(_replicated(fps, t), F.col("anchor"), homes, F.col("anchor"))
    if crowded.isEmpty():
        return _meeting(homes, reach, ["anchor"], t)

    found = _meeting(homes.join(crowded, "anchor", "left_anti"), reach, ["anchor"], t)
    both = F.xxhash64("anchor", "second")
    split = written(_replicated(homes.join(crowded, "anchor").select("fp", "anchor"), 0, "second", SECOND), "simhash-second-homes")
    again = _replicated(reach.join(crowded, "anchor").select("fp", "anchor"), t, "second", SECOND)
    return found.unionByName(_meeting(split, _in_reach(again, both, split, both), ["anchor", "second"], t))


def near_duplicates(docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp, component (smallest id of all reachable rows) and root (its
    component's smallest fingerprint, also where ids are null or repeat) per row."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    roots = components(links(nodes, distance))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    of = written(named.join(lows, "root").select("fp", "component", "root"), "simhash-components")
    return rows.join(of, "fp").select("id", "fp", "component", "root")
