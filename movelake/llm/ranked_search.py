"""Ranked lexical search, term-at-a-time and document-at-a-time combined.

Documents become postings of the queries' terms, written once; document counts
and lengths come from all of them. The search runs where the postings lie: a
task reads its documents in blocks of bounded postings and builds each block's
lists. For an item, the lists of few documents are summed term by term into
accumulators. These then act as one list, bounded by their largest sum, beside
the long lists in a document-at-a-time search: lists are ordered by bound, those
that together cannot reach the k-th best score so far bring no candidates, and
are looked up by binary search for the candidates alone, largest bound first,
while a candidate can still reach that score. Each task gives its k best per
item; nothing else is shuffled, so no term, item or document makes a hot task.

Queries are collected in rounds of about ``most_pairs`` (item, term) pairs; a
larger query table takes more rounds over the documents, with the same result.

Defined cases: null or empty texts have no terms and are neither counted nor
found; an item without terms or without a hit gives no rows. Rows that repeat an
id, of documents or items, are each taken by themselves. Equal scores rank by
ascending id, null last. Texts are read whole, in pieces of about 1 MB. Extra
columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from movelake.llm.common import python_ready, whole, written

#: A-Z lower-cased, all other ASCII but letters and digits blank; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256))


def terms(text: str, piece: int = 1 << 20) -> Counter:
    """Terms (UTF-8) with their number of occurrences."""
    data, out, at = text.encode().translate(_FOLD), Counter(), 0
    while at < len(data):
        to = data.find(b" ", at + piece)
        to = len(data) if to < 0 else to
        out.update(data[at:to].split(b" "))
        at = to + 1
    out.pop(b"", None)
    return out


def _queries(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(q, item, terms): a row per row of items."""
    given = items.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).alias("item"), whole(text_col).alias("text"))

    def run(batches):
        for b in batches:
            found = [sorted(terms(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.binary()))], ["q", "item", "terms"])

    return given.mapInArrow(run, f"q long, item {given.schema['item'].dataType.simpleString()}, terms array<binary>")


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: n terms in all, and
    those of the vocabulary by number with their occurrences."""
    given = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))

    def run(batches):
        for b in batches:
            at, n, found, tfs = [], [], [], []
            for i, t in enumerate(b.column(1)):
                count = terms(t.as_py())
                if count:
                    hits = [(vocabulary[w], c) for w, c in count.items() if w in vocabulary]
                    at.append(i)
                    n.append(count.total())
                    found.append([h[0] for h in hits])
                    tfs.append([h[1] for h in hits])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["id", "n", "terms", "tfs"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, n long, terms array<int>, tfs array<long>")


class Block:
    """Lists of one block: documents (positions by ascending id) and w * impact by term."""

    def __init__(self, rows: list[pa.RecordBatch], weight: np.ndarray, count: int, length: int):
        t = pa.Table.from_batches(rows).combine_chunks()
        ids, n = t.column("id").to_pylist(), t.column("n").to_numpy()
        lists = t.column("terms").combine_chunks()
        offsets = lists.offsets.to_numpy()
        term, tf = lists.flatten().to_numpy(), t.column("tfs").combine_chunks().flatten().to_numpy()
        by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        place = np.empty(len(ids), "i4")
        place[by_id] = np.arange(len(ids), dtype="i4")
        self.ids, self.size = [ids[i] for i in by_id], len(ids)
        m = 100 - 90 + (90 * n * count) // max(length, 1)
        sizes = np.diff(offsets)
        docs = np.repeat(place, sizes)
        value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
        order = np.lexsort((docs, term))
        term, self.docs, self.value = term[order], docs[order], value[order]
        first = np.flatnonzero(np.diff(term, prepend=-1))
        self.lists = {int(x): (int(a), int(b)) for x, a, b in zip(term[first], first, np.append(first[1:], len(term)))}
        most = np.maximum.reduceat(self.value, first) if len(first) else first
        self.most = dict(zip(term[first].tolist(), most.tolist()))

    def best(self, wanted: list[int], k: int, floor: int, short: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best documents with a score of floor or more."""
        few, found = [], []
        for x in wanted:
            if self.most.get(x, 0) > 0:
                a, b = self.lists[x]
                (few if b - a <= short else found).append((self.docs[a:b], self.value[a:b], self.most[x]))
        if few:  # term at a time
            d, v = np.concatenate([x[0] for x in few]), np.concatenate([x[1] for x in few])
            order = np.argsort(d, kind="stable")
            d, v = d[order], v[order]
            first = np.flatnonzero(np.diff(d, prepend=-1))
            v = np.add.reduceat(v, first)
            found.append((d[first], v, int(v.max())))
        found.sort(key=lambda x: x[2])
        reach = np.cumsum([x[2] for x in found])  # of the lists up to this one together
        top, score = np.empty(0, "i4"), np.empty(0, "i8")
        for at in range(0, self.size, span):  # document at a time, a range together
            needed = int(np.searchsorted(reach, floor, "left"))
            if needed == len(found):
                break  # no document can reach the k-th best any more
            cut = [(x, *np.searchsorted(x[0], (at, at + span))) for x in found[needed:]]
            docs = np.unique(np.concatenate([x[0][a:b] for x, a, b in cut]))
            sums = np.zeros(len(docs), "i8")
            for x, a, b in cut:
                sums[np.searchsorted(docs, x[0][a:b])] += x[1][a:b]
            for i in range(needed - 1, -1, -1):
                stay = sums + reach[i] >= floor
                docs, sums = docs[stay], sums[stay]
                where = np.minimum(np.searchsorted(found[i][0], docs), len(found[i][0]) - 1)
                sums += np.where(found[i][0][where] == docs, found[i][1][where], 0)
            stay = sums >= floor
            top, score = np.concatenate([top, docs[stay]]), np.concatenate([score, sums[stay]])
            order = np.lexsort((top, -score))[:k]
            top, score = top[order], score[order]
            if len(top) == k:
                floor = max(floor, int(score[-1]))
        return top, score


def _blocks(batches, most_docs: int, most_postings: int) -> Iterator[list[pa.RecordBatch]]:
    held, docs, entries = [], 0, 0
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy()
        at = 0
        while at < batch.num_rows:
            to = min(batch.num_rows, at + most_docs - docs, max(at + 1, int(np.searchsorted(ends, ends[at] + most_postings - entries, "right")) - 1))
            held.append(batch.slice(at, to - at))
            docs, entries, at = docs + to - at, entries + int(ends[to] - ends[at]), to
            if docs >= most_docs or entries >= most_postings:
                yield held
                held, docs, entries = [], 0, 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           most_pairs: int = 1_000_000, block_docs: int = 16_384, block_postings: int = 2_000_000, short: int = 512, span: int = 4096) -> DataFrame:
    """item, rank, id, score: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    python_ready(spark)
    queries = written(_queries(items, item_col, text_col), "search-queries")
    pairs = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = max(1, -(-pairs // most_pairs))
    found = [_round(docs, queries.where(F.pmod(F.xxhash64("q"), F.lit(rounds)) == r), k, id_col, text_col, block_docs, block_postings, short, span)
             for r in range(rounds)]
    all_found = found[0]
    for f in found[1:]:
        all_found = all_found.unionByName(f)
    by = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = all_found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.join(queries.select("q", "item"), "q").select("item", "rank", "id", "score")


def _round(docs, queries, k, id_col, text_col, block_docs, block_postings, short, span) -> DataFrame:
    asked = queries.select("q", "terms").collect()
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in asked for t in r.terms}))}
    table = written(postings(docs, vocabulary, id_col, text_col), "search-postings")
    count, length = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(max(1, len(vocabulary)), "i8")
    for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # as many rows as terms asked for
        weight[r.t] = math.floor(1000 * math.log((2 * count + 2) / (2 * r["count"] + 1)))
    wanted = [(r.q, [vocabulary[bytes(t)] for t in r.terms]) for r in asked]
    id_type = table.schema["id"].dataType

    def run(batches):
        kept: dict[int, list] = {}
        kind = None
        for rows in _blocks(batches, block_docs, block_postings):
            kind = rows[0].column(0).type
            block = Block(rows, weight, count, length)
            for q, ts in wanted:
                have = kept.get(q, [])
                top, score = block.best(ts, k, have[-1][0] if len(have) == k else 1, short, span)
                if len(top):
                    have = have + [(int(s), block.ids[d]) for d, s in zip(top, score)]
                    kept[q] = sorted(have, key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
        if kept:
            out = [(q, i, s) for q, have in kept.items() for s, i in have]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], kind),
                                              pa.array([x[2] for x in out], pa.int64())], ["q", "id", "score"])

    return table.mapInArrow(run, f"q long, id {id_type.simpleString()}, score long")
