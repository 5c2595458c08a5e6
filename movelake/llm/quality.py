"""Quality rules as a short-circuit cascade; only DataFrame functions.

Each rule is a Column that is true where it rejects. ``plan_cascade`` measures
every rule alone on a bounded sample (seconds per row, share rejected) and
orders the rules by rejection per cost; ``cascade`` evaluates them as one CASE
expression, which stops at the first rule that rejects. The order decides only
which rule is named and what is computed, never whether a text is kept.

Defined cases: a null or empty text has no words and is rejected for it. Ties
in the order keep the order given. Repeated rows are judged alike. Texts of any
length are read whole. Extra columns pass through, but for those called like a
result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from movelake.llm.common import WORD, fresh, let, whole

SYMBOLS = r"[#*$%&|<>]"
BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def word_chars(word_list: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(word_list, "")).cast("long")


def n_of(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(characters)).cast("long")


def word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def n_dup_lines(text: Column) -> Column:
    return let(word_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(word_list: Column, k: int = 8) -> Column:
    """Words covered by k-word windows that occur twice or more in the text,
    first ones included (k: a power of two). Windows are compared by a 64-bit
    hash, doubled from word hashes; time and memory are linear in the text but
    for one sort where windows repeat."""
    def starts(hashes: Column) -> Column:
        def repeated(z: Column) -> Column:
            return F.transform(
                F.filter(z, lambda e, i: F.coalesce(F.get(z, i - 1)["h"] == e["h"], F.lit(False))
                         | F.coalesce(F.get(z, i + 1)["h"] == e["h"], F.lit(False))), lambda e: e["i"])

        pairs = F.zip_with(hashes, F.sequence(F.lit(1), F.size(hashes)), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.sort_array(let(F.sort_array(pairs), repeated))

    def covered(s: Column) -> Column:
        steps = F.transform(s, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(s, i + 1) - x, F.lit(k))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(starts(hashes), covered)).otherwise(0)

    def joined(step: int):  # hashes of windows twice as long; the last ones are padded and cut off below
        return lambda h: F.zip_with(h, F.slice(h, F.lit(1 + step), F.size(h)), lambda a, b: F.xxhash64(a, b))

    def hashed(w: Column) -> Column:
        h, step = F.transform(w, lambda x: F.xxhash64(x)), 1
        while step < k:
            h, step = let(h, joined(step)), 2 * step
        return F.when(F.size(w) > k, let(F.slice(h, F.lit(1), F.size(w) - (k - 1)), count)).otherwise(0)

    return let(word_list, hashed).cast("long")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, in
    place of columns of docs that are called so."""
    t, q = whole(text_col), fresh(docs, "q_words")
    w = F.col(q)
    counts = {"n_words": F.size(w).cast("long"), "word_chars": word_chars(w), "n_symbols": n_of(t, SYMBOLS), "n_dup_lines": n_dup_lines(t),
              "n_repeat_words": n_repeat_words(w)}
    return docs.withColumn(q, words(t)).select(*[c for c in docs.columns if c not in counts], *[c.alias(n) for n, c in counts.items()])


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def rules(text_col: str = "text", min_words: int = 20, max_repeat_pct: int = 30, symbol_pct: int = 25,
          dup_line_pct: int = 10, shout_pct: int = 50, chars_per_word: tuple[int, int] = (2, 30),
          counted: bool = False) -> list[Rule]:
    """Few words, repeated windows, symbols per word, repeated lines per word,
    exclamation marks per word, mean word length. The thresholds are far from
    plain prose, so that it is kept. ``counted``: take the columns of
    ``with_counts``; else each rule computes what it needs from the text."""
    t, c = whole(text_col), F.col
    w = words(t)
    n = c("n_words") if counted else F.regexp_count(t, F.lit(WORD)).cast("long")

    def length(chars: Column, n: Column) -> Column:
        return (chars < chars_per_word[0] * n) | (chars > chars_per_word[1] * n)

    return [
        Rule("few_words", n < min_words),
        Rule("repeated_windows", 100 * c("n_repeat_words") > max_repeat_pct * n if counted
             else let(w, lambda x: 100 * n_repeat_words(x) > max_repeat_pct * F.size(x))),
        Rule("symbols", 100 * (c("n_symbols") if counted else n_of(t, SYMBOLS)) > symbol_pct * n),
        Rule("duplicate_lines", 100 * (c("n_dup_lines") if counted else n_dup_lines(t)) > dup_line_pct * n),
        Rule("shouting", 100 * n_of(t, "!") > shout_pct * n),
        Rule("word_length", length(c("word_chars"), n) if counted else let(w, lambda x: length(word_chars(x), F.size(x)))),
    ]


def plan_cascade(docs: DataFrame, to_order: list[Rule], text_col: str = "text", sample_rows: int = 300,
                 max_chars: int = 20_000, repeat: int = 8, prepared: Callable[[DataFrame], DataFrame] | None = None) -> list[Rule]:
    """The rules by rejections per second, most first. The sample (at most
    ``sample_rows`` texts of at most ``max_chars`` characters, from the first
    partitions) is bounded whatever the table's size and is repeated so that a
    rule's time stands out from a job's; it steers the order alone. ``prepared``
    is what the table goes through before its rules run (as ``with_counts``): the
    sample goes through it untimed, so that the rules that will run are timed."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text")).where(F.length(text_col) <= max_chars).take(sample_rows)
    if not rows:
        return to_order
    sample = spark.createDataFrame([(r.text,) for r in rows], "text string").repartition(2).withColumnRenamed("text", text_col)
    sample = (prepared(sample) if prepared else sample).persist()

    def seconds(condition: Column) -> tuple[float, float]:
        began = time.perf_counter()
        n = (sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias(fresh(sample, "again")))
             .agg(F.avg(condition.cast("double"))).first()[0])
        return time.perf_counter() - began, n or 0.0

    seconds(F.lit(False))  # fills the cache
    empty = seconds(F.col(text_col).isNull())[0]
    rate = {}
    for r in to_order:
        cost, rejected = seconds(r.rejects)
        rate[r.name] = rejected / max(cost - empty, 1e-3)
    sample.unpersist()
    return sorted(to_order, key=lambda r: -rate[r.name])


def cascade(docs: DataFrame, ordered: list[Rule], out: str = "rejected_by") -> DataFrame:
    """docs with the first rejecting rule's name, null where the text is kept."""
    first = F.lit(None).cast("string")
    for r in reversed(ordered):
        first = F.when(r.rejects, F.lit(r.name)).otherwise(first)
    return docs.withColumn(out, first)
