"""How filters interact: what each removes in every order they could be applied.

A document's mask holds the filters that it fails. Orders are numbered
lexicographically (Lehmer rank). A document goes at step j exactly in the orders
that begin with j - 1 filters it passes and then one that it fails; the orders
with a given beginning are one interval of ranks. So each mask adds its counts
to a difference array at the interval's start and takes them off at its end, and
a prefix sum over the ranks gives the removals of every order: 840 intervals for
five filters, whatever the number of documents. Documents are only counted by
(part, mask).

Copies are found by a 256-bit digest of the text; every copy fails but the rows
of the smallest id. Rows are counted by (digest, part) before copies meet, so a
hot text is summed on each mapper.

Defined cases: null texts are empty; empty texts have no words and no characters
(they fail filter A alone, and E as copies of each other). A null part is the
empty string. Rows without an id fail no copy test and make no other row fail
it. Rows that repeat id and text are each counted and do not fail for each
other. Of labels that repeat an id, any that says 1 counts. Texts of any length
are read whole. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from movelake.llm.common import whole, written
from movelake.llm.quality import words

#: The filters, in the order of the mask's bits; the last is the copy test.
FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def text_mask(text: Column, word_list: Column, min_words: int = 200, distinct_pct: int = 50, capital_pct: int = 3,
              symbols: str = "[#$%&*|]") -> Column:
    """Bits of the filters A-D that the text fails."""
    n = F.size(word_list)
    fails = [n < min_words, 100 * F.size(F.array_distinct(word_list)) < distinct_pct * n,
             100 * F.regexp_count(text, F.lit("[A-Z]")) > capital_pct * F.length(text), text.rlike(symbols)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, and
    how many of them are labelled quality = 1 and toxic = 1."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), whole(text_col).alias("text"))
    rows = (given.select("*", words(F.col("text")).alias("words"))
            .select("id", "part", text_mask(F.col("text"), F.col("words")).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")))
    rows = rows.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    one = lambda c: F.max((F.col(c) == 1).cast("long"))
    marks = (labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "quality", "toxic")
             .groupBy("id").agg(F.coalesce(one("quality"), F.lit(0)).alias("q"), F.coalesce(one("toxic"), F.lit(0)).alias("x")))
    rows = written(rows, "audit-rows")
    marked = rows.where("id is not null").join(marks, "id", "left").select(
        "id", "part", "mask", "digest", "n", (F.col("n") * F.coalesce("q", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("x", F.lit(0))).alias("toxic"))

    total = [F.sum(c).alias(c) for c in COUNTS]
    copies = written(marked.groupBy("digest", "part", "mask").agg(*total, F.min(F.struct("id", *COUNTS)).alias("top")), "audit-copies")
    first = copies.groupBy("digest").agg(F.min("top.id").alias("first"))
    stays = F.col("top.id") == F.col("first")
    own = [F.when(stays, F.col(f"top.{c}")).otherwise(0) for c in COUNTS]
    last = 1 << (len(FILTERS) - 1)
    both = F.array(F.struct(F.col("mask"), *[o.alias(c) for o, c in zip(own, COUNTS)]),
                   F.struct((F.col("mask") + last).alias("mask"), *[(F.col(c) - o).alias(c) for o, c in zip(own, COUNTS)]))
    named = copies.join(first, "digest").select("part", F.inline(both))
    nameless = rows.where("id is null").select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return named.unionByName(nameless).groupBy("part", "mask").agg(*total).where("n > 0")


def lehmer_rank(start: tuple[int, ...], k: int) -> int:
    """Rank of the first permutation of range(k) that begins with ``start``."""
    left, rank = list(range(k)), 0
    for x in start:
        at = left.index(x)
        left.pop(at)
        rank += at * factorial(len(left))
    return rank


def intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of the orders in which a
    document with that mask goes at that step."""
    out = []
    for mask in range(1, 1 << k):
        passed = [i for i in range(k) if not mask >> i & 1]
        for j in range(len(passed) + 1):
            for start in permutations(passed, j):
                for i in range(k):
                    if mask >> i & 1:
                        at = lehmer_rank((*start, i), k)
                        out.append((mask, j + 1, at, at + factorial(k - j - 1)))
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic)."""
    spark, k = counts.sparkSession, len(filters)
    counts = written(counts, "audit-counts")
    spans = spark.createDataFrame(intervals(k), "mask int, step int, since int, until int")
    orders = spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(permutations(filters))], "rank int, filter_order string")

    ends = F.array(F.struct(F.col("since").alias("rank"), *COUNTS), F.struct(F.col("until").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]))
    steps = counts.join(F.broadcast(spans), "mask").select("part", "step", F.inline(ends)).where(F.col("rank") < factorial(k))
    bit = lambda i: F.col("mask").bitwiseAND(F.lit(1 << i)) != 0
    of_part = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.coalesce(F.sum(F.when(bit(i), F.col("n"))), F.lit(0)) for i in range(k)]).alias("fails"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == 1 << i, F.col("n"))), F.lit(0)) for i in range(k)]).alias("alone"))
    zero = [F.lit(0).cast("long").alias(c) for c in COUNTS]
    grid = (of_part.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
            .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1))).alias("rank"), *zero))
    ends_summed = steps.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = ends_summed.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])

    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    full = (gone.join(F.broadcast(orders), "rank").join(of_part, "part")
            .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
            .withColumn("at", F.instr(F.lit(filters), F.col("letter")) - 1))
    return full.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.get("fails", F.col("at")) - F.col("n")).alias("redundant"), F.get("alone", F.col("at")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
