"""Embedding near-duplicates by iterative quantisation.

A rotation is learnt on a bounded sample (principal axes, then alternating
signs and Procrustes steps) so that the signs of a rotated vector make a
balanced binary code. Codes are cut into substrings, each the key of one Hamming
table; width and number of tables follow from the number of distinct vectors
(about ``load`` in a bucket) and from the recall wanted at the threshold. More
bits than dimensions come from further rotations, learnt from other starts.

Retrieval moves codes alone: within a bucket, vectors that have another within
the code distance are marked. Only those take their original vectors to the
bucket for the cosines. A pair is counted in the first table that both share, so
links are counted once without ever being listed: a bucket gives, per vector, a
number of links and one neighbour towards its connected neighbours' first. A
bucket of more than ``block`` vectors is split and its blocks meet in pairs, in
tasks of their own.

Equal vectors are one node with a number from the start (told apart by two
64-bit hashes), so copies make no pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, not even with equal ones; vectors of different
lengths do not link. Rows without an id count as links of others but are never
the smallest id (null if there is no other) and are not kept. Rows that repeat
an id are each returned; equal rows link with each other. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from movelake.llm.common import python_ready, written
from movelake.llm.components import components


def learn(sample: np.ndarray, rotations: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, one matrix per rotation): ``(x - mean) @ matrix > 0`` is a code."""
    mean = sample.mean(0)
    centred = sample - mean
    axes = np.linalg.eigh(centred.T @ centred)[1]
    projected, rng, d = centred @ axes, np.random.default_rng(seed), sample.shape[1]
    out = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(rounds):
            signs = np.where(projected @ r > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(signs.T @ projected)
            r = vt.T @ u.T
        out.append(axes @ r)
    return mean, np.concatenate(out, axis=1)


def tables_for(n: int, threshold: float, recall: float, load: int) -> tuple[int, int]:
    """(width, number) of substrings: a pair at the threshold shares a bit with
    probability p and a substring with p ** width."""
    width = max(4, math.ceil(math.log2(max(n, 2) / load)))
    p = 1 - math.acos(threshold) / math.pi
    return width, math.ceil(math.log(1 - recall) / math.log(1 - p ** width))


def unit(column: pa.Array, d: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros to length d."""
    values, offsets = column.flatten().to_numpy(zero_copy_only=False).astype("f8"), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), d))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _codes(classes: DataFrame, d: int, mean: np.ndarray, matrix: np.ndarray, width: int, tables: int, words: int) -> DataFrame:
    """(node, words, keys): the code's first 64 * words bits, and each table's substring."""
    powers = 1 << np.arange(width, dtype="i8")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                bits = (unit(part.column(1), d) - mean) @ matrix[:, :width * tables] > 0
                keys = bits.reshape(len(bits), tables, width) @ powers
                padded = np.zeros((len(bits), 64 * words), "?")
                used = min(bits.shape[1], 64 * words)
                padded[:, :used] = bits[:, :used]
                code = np.packbits(padded, axis=1, bitorder="little").view("<i8")
                lists = lambda x: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype="i4") * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists(code), lists(keys.astype("i8"))], ["node", "words", "keys"])

    return classes.select("node", "v").mapInArrow(run, "node long, words array<long>, keys array<long>")


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """members (t, key, node, ..) of buckets of two and more, by pairs of blocks
    (lo, hi), with ``mine``, the block a row is from."""
    sizes = written(members.groupBy("t", "key").agg(F.count("*").alias("size")).where("size > 1"), "embeddings-buckets")
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = members.join(sizes, ["t", "key"]).withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("size", "blocks", "other"))


def _matrix(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(dtype, copy=False)


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    mine = table.column("mine").to_numpy()
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    a, b = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
    return a, b, lo == hi


def _near(code: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> np.ndarray:
    far = np.zeros((len(a), len(b)), "i4")
    for w in range(code.shape[1]):
        far += np.bitwise_count(code[a, w][:, None] ^ code[b, w][None, :])
    near = far <= radius
    if same:
        np.fill_diagonal(near, False)
    return near


def _marked(buckets: DataFrame, radius: int, block: int) -> DataFrame:
    """(t, key, node) of vectors with another within the radius in their bucket."""
    def run(table: pa.Table) -> pa.Table:
        code = _matrix(table, "words", "u8")
        a, b, same = _sides(table)
        near = _near(code, a, b, same, radius)
        hit = np.unique(np.concatenate([a[near.any(axis=1)], b[near.any(axis=0)]]))
        return table.select(["t", "key", "node"]).take(pa.array(hit))

    return _dealt(buckets, block).groupBy("t", "key", "lo", "hi").applyInArrow(run, "t int, key long, node long").distinct()


def _linked(members: DataFrame, d: int, radius: int, threshold: float, block: int) -> DataFrame:
    """(node, links, root): links counted in a bucket, and a node that the
    node reaches by them, the smallest in this bucket."""
    def run(table: pa.Table) -> pa.Table:
        a, b, same = _sides(table)
        node, copies, t = table.column("node").to_numpy(), table.column("n").to_numpy(), table.column("t")[0].as_py()
        keys, column = _matrix(table, "keys", "i8"), table.column("v").combine_chunks()
        x, sizes = unit(column, d), np.diff(column.offsets.to_numpy())
        cosine = x[a] @ x[b].T
        link = _near(_matrix(table, "words", "u8"), a, b, same, radius) & (cosine >= threshold - 1e-9) & (sizes[a][:, None] == sizes[b][None, :])
        i, j = np.nonzero(link & (cosine < threshold + 1e-9))  # too close to the threshold: alike in either order
        link[i, j] = (x[a[i]] * x[b[j]]).sum(axis=1) >= threshold
        for u in range(t):
            link &= keys[a, u][:, None] != keys[b, u][None, :]  # counted in table u
        links = np.zeros(len(node), "i8")
        links[a] += link @ copies[b]
        if not same:
            links[b] += copies[a] @ link
        root, top = node.copy(), np.iinfo("i8").max
        while True:
            before = root.copy()
            root[a] = np.minimum(root[a], np.where(link, root[b][None, :], top).min(axis=1, initial=top))
            root[b] = np.minimum(root[b], np.where(link, root[a][:, None], top).min(axis=0, initial=top))
            if (root == before).all():
                break
        some = links > 0
        return pa.table({"node": node[some], "links": links[some], "root": root[some]})

    return _dealt(members, block).groupBy("t", "key", "lo", "hi").applyInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = 0.99,
                    sample: int = 20_000, sample_values: int = 4_000_000, load: int = 128, block: int = 1024, words: int = 4) -> DataFrame:
    """id, n_links, component (smallest id reachable by links, itself included)
    and kept (id = component) per row. The rotation is learnt on at most
    ``sample`` distinct vectors (``sample_values`` components), those of the
    smallest hashes."""
    spark = vectors.sparkSession
    python_ready(spark)
    v = F.col(vec_col)
    v = v if dict(vectors.dtypes)[vec_col] == "array<float>" else v.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.coalesce(~F.exists("v", bad) & F.exists("v", lambda x: x != 0), F.lit(False))
    given = (vectors.select(F.col(id_col).alias("id"), v.alias("v"))
             .select("id", "v", usable.alias("usable"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2")))
    alone = given.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.col("id").isNotNull().alias("kept"))

    classes = written(given.where("usable").groupBy("h1", "h2").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.any_value("v").alias("v"))
                      .withColumn("node", F.monotonically_increasing_id()), "embeddings-classes")
    count, d = classes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    found = linked_classes(classes, count, d, threshold, recall, sample, sample_values, load, block, words)
    links = written(found, "embeddings-links")
    roots = components(links.where("node != root"), "node", "root")

    named = (classes.select("node", "h1", "h2", "low", "n").join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    named = written(named, "embeddings-named")
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    of = written(named.join(lows, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component"), "embeddings-of")
    out = given.where("usable").select("id", "h1", "h2").join(of, ["h1", "h2"])
    return out.select("id", "n_links", "component", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept")).unionByName(alone)


def linked_classes(classes: DataFrame, count: int, d: int, threshold: float, recall: float, sample: int, sample_values: int, load: int, block: int, words: int) -> DataFrame:
    """(node, links, root) of the distinct vectors that link, by bucket."""
    spark = classes.sparkSession
    if count < 2:
        return spark.createDataFrame([], "node long, links long, root long")
    width, tables = tables_for(count, threshold, recall, load)
    rows = classes.select("v", "h1", "h2").orderBy("h1", "h2").limit(min(sample, max(2, sample_values // d))).select("v").toArrow()
    mean, matrix = learn(unit(rows.column("v").combine_chunks(), d), -(-width * tables // d))
    coded = written(_codes(classes, d, mean, matrix, width, tables, words), "embeddings-codes")
    bits = min(64 * words, width * tables)
    flip = math.acos(threshold) / math.pi
    radius = math.ceil(bits * flip + 4 * math.sqrt(bits * flip * (1 - flip)))

    buckets = coded.select("node", "words", F.posexplode("keys").alias("t", "key"))
    marked = written(_marked(buckets, radius, block), "embeddings-marked")
    members = marked.join(coded, "node").join(classes.select("node", "n", "v"), "node")
    return _linked(members, d, radius, threshold, block)
