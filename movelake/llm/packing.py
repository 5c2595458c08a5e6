"""Sequence packing by non-negative least squares over a length histogram.

1. Texts are tokenized once (tokenizers library, each distinct word of a batch
   once); ids are kept as binary in a table of the shared folder.
2. A document gives full windows and a remainder. Remainders are binned by
   length; the histogram (at most ``window / width`` numbers) goes to the
   driver. There every combination of up to three bins that fills a window is
   enumerated, repeat counts are solved by non-negative least squares against
   the histogram, rounded down, and cut back to what the histogram holds.
3. A remainder's rank in its bin (counts per writing task, then a rank within
   the task: no task sees a whole bin) names its combination and sequence.
4. Residuals: remainders beyond the counts are laid end to end and cut greedily
   into the gaps that binning leaves, then into windows; the last, partial
   window becomes sequences of power-of-two length. So nothing is padded.

Only the histogram and the list of combinations, both bounded by parameters,
are on the driver or broadcast. Positions on the two lines (residuals, gaps)
are prefix sums over task-sized groups, and the lines meet by equal blocks.

Defined cases: a null or empty text is one end id; ids of rows may be null or
repeat (pieces carry the row's own number ``rid``); an empty table gives none.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from movelake.llm import pieces
from movelake.llm.common import python_ready, whole, written

_KNOWN: dict[str, pieces.Known] = {}
#: Marks that end a run of letters; the tokenizer always splits there. An
#: apostrophe can start a contraction, "<" and "|" a special token.
_MARK = r"""[!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]"""
_MARKS = re.compile(rf"{_MARK}(?<=[^\W\d_].){_MARK}*(?=\s|$)", re.DOTALL)
#: Letters that normalise one by one (no combining signs among them).
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_PLAIN = re.compile(f"[{_LETTERS}]+").fullmatch
#: White space of Python alone, and the letter whose lower case holds a sign.
_WHOLE = re.compile("[\x1c-\x1f\u0130]")


def words(text: str) -> list[str]:
    """Parts that tokenize alone: the tokenizer drops white space, lower-cases,
    and splits letters from marks, so parts without these differ less often."""
    if _WHOLE.search(text):
        return [text]
    if "<|" not in text and text.isascii():
        text = text.lower()
    return _MARKS.sub(r" \g<0>", text).split()


def _shapes(t) -> dict[int, str]:
    """What the tokenizer's normaliser and pre-tokenizer make of each letter;
    empty if a run of letters is not simply the run of their shapes."""
    def cut(text: str) -> list[str]:
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text]

    letters = [c for c in map(chr, range(0x250)) if _PLAIN(c)]
    shapes = {ord(c): "".join(cut(c)) for c in letters}
    together = ["".join(shapes.values())]
    return shapes if cut("".join(letters)) == together and cut("".join(letters[::-1])) == ["".join([*shapes.values()][::-1])] else {}


def _ids(path: str) -> pieces.Known:
    """Ids of words, as little-endian 32-bit integers; one per worker process and tokenizer."""
    if path not in _KNOWN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation(), t.no_padding()
        shapes, merge = _shapes(t), t.model.tokenize
        special = sorted((i, a.content) for i, a in t.get_added_tokens_decoder().items())
        mark_id, mark = special[0] if special else (None, None)

        def one(new: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(new, add_special_tokens=False)]

        def many(new: list[str], group: int = 500) -> list[bytes]:
            """Words of plain letters go to the model at once; others, with a special token between
            them, which splits the text before all else, are one call's work."""
            if mark is None:
                return one(new)
            out: dict[str, bytes] = {w: np.array([x.id for x in merge(w.translate(shapes))], "<u4").tobytes()
                                     for w in new if shapes and _PLAIN(w)}
            plain = [w for w in new if w not in out and "<" not in w and "|" not in w]
            groups = [plain[i:i + group] for i in range(0, len(plain), group)]
            for words, e in zip(groups, t.encode_batch_fast([mark.join(g) for g in groups], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                raw, at = ids.tobytes(), [-1, *np.flatnonzero(ids == mark_id).tolist(), len(ids)]
                out.update((w, raw[4 * (a + 1):4 * b]) for w, a, b in zip(words, at, at[1:]))
            rest = [w for w in new if w not in out]
            out.update(zip(rest, one(rest)))
            return [out[w] for w in new]

        _KNOWN[path] = pieces.Known(many, 200_000)
    return _KNOWN[path]


def tokenize(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
             batch_bytes: int = 1 << 20) -> DataFrame:
    """id, ids: little-endian unsigned 32-bit ids with end_id last. The
    tokenizer drops white space, so the words of a text tokenize alone."""
    python_ready(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        known = _ids(path)
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            parts = [words(t) for t in texts]
            found = known.get(parts)
            rows = [b"".join(map(found.__getitem__, p)) + end for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["id", "ids"])

    given = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, ids binary")


def combinations(bins: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, of bin sizes that sum to bins; 0: unused."""
    a, b = np.meshgrid(np.arange(bins + 1), np.arange(bins + 1), indexing="ij")
    c = bins - a - b
    keep = (a <= b) & (b <= c)
    return np.stack([a[keep], b[keep], c[keep]], 1)


def solve(histogram: np.ndarray, combos: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts by accelerated projected gradient on |Ax - b|^2, x >= 0,
    A[i, j] being how often combination j holds bin i (index 0 is no bin)."""
    n = len(histogram)

    def ax(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, k], x, n) for k in range(3))
        out[0] = 0
        return out

    b = histogram.astype(float)
    b[0] = 0
    step = 1.0 / (3.0 * max(np.bincount(combos.ravel(), minlength=n)[1:].max(), 1))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        g = ax(y) - b
        to = np.maximum(y - step * sum(np.where(combos[:, k] > 0, g[combos[:, k]], 0) for k in range(3)), 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        x, y = to, to + (before - 1) / t * (to - x)
    return x


def plan(histogram: np.ndarray, width: int) -> list[tuple[int, int, int, int]]:
    """(bin, slot, first rank, copies) with combinations in order: copy m of
    combination j is sequence first[j] + m. Rounds down, keeps within the
    histogram, and gives up the last copies until the residual tokens surely
    fill all gaps."""
    bins = len(histogram) - 1
    combos = combinations(bins)
    counts = np.floor(solve(histogram, combos) + 1e-6).astype("i8")
    left = histogram.astype("i8").copy()
    chosen: list[list] = []
    for j in np.argsort(-counts, kind="stable"):
        if counts[j] <= 0:
            break
        used, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
        m = int(min(counts[j], (left[used] // times).min()))
        if m > 0:
            left[used] -= m * times
            chosen.append([m, combos[j][combos[j] > 0]])
    shortest = lambda bin_: (bin_ - 1) * width + 1
    gap = sum(m * len(c) * (width - 1) for m, c in chosen)
    spare = int(sum(n * shortest(i) for i, n in enumerate(left) if i))
    while gap > spare and chosen:
        m, c = chosen[-1]
        gives = sum(shortest(i) for i in c) + len(c) * (width - 1)
        k = int(min(m, -(-(gap - spare) // gives)))
        gap, spare = gap - k * len(c) * (width - 1), spare + k * int(sum(shortest(i) for i in c))
        chosen[-1][0] -= k
        if not chosen[-1][0]:
            chosen.pop()
    taken = np.zeros(bins + 1, "i8")
    slots, first = [], 0
    for m, c in chosen:
        for slot, i in enumerate(c):
            slots.append((int(i), slot, int(taken[i]), int(m), int(first)))
            taken[i] += m
        first += m
    return slots


def line(df: DataFrame, group: Column, order: list[str], amount: str, out: str) -> DataFrame:
    """df with ``out``: the sum of ``amount`` over all rows before, rows ordered
    by group and then ``order``. Only one sum per group meets in one task."""
    g = df.withColumn("g", group)
    sums = g.groupBy("g").agg(F.sum(amount).alias("s"))
    base = sums.select("g", F.coalesce(F.sum("s").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (g.withColumn("here", F.coalesce(F.sum(amount).over(w), F.lit(0))).join(base, "g")
            .withColumn(out, F.col("base") + F.col("here")).drop("g", "base", "here"))


def overlap(left: DataFrame, right: DataFrame, block: int) -> DataFrame:
    """Pairs whose intervals [u, u + u_len) and [v, v + v_len) meet, with the
    common part as at, part. Both are cut into blocks of the line, so the join
    has an equality and each row a bounded number of blocks."""
    def cut(df: DataFrame, at: str, length: str) -> DataFrame:
        return df.withColumn("b", F.explode(F.expr(f"sequence({at} div {block}, ({at} + {length} - 1) div {block})")))

    lo, hi = F.greatest("u", "v", F.col("b") * block), F.least(F.col("u") + F.col("u_len"), F.col("v") + F.col("v_len"), (F.col("b") + 1) * block)
    return (cut(left, "u", "u_len").join(cut(right, "v", "v_len"), "b").withColumn("at", lo).withColumn("part", hi - lo)
            .where("part > 0").drop("b"))


def pack(tokens: DataFrame, window: int = 2048, width: int = 16) -> DataFrame:
    """Pieces of ``tokenize``'s rows: rid, id, start, length, sequence_id, offset,
    ids (binary), doc_tokens. ``window`` is a power of two, ``width`` divides it."""
    spark = tokens.sparkSession
    rows = written(tokens.select("id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n"),
                                 F.monotonically_increasing_id().alias("rid")), "pack-tokens")
    docs = rows.select("rid", "n", F.shiftright("rid", 33).alias("task"),
                       F.expr(f"n div {window}").alias("full"), F.expr(f"n % {window}").alias("rest"))

    short = docs.where("rest > 0").withColumn("bin", F.expr(f"cast((rest + {width - 1}) div {width} as int)"))
    by_task = written(short.groupBy("task", "bin").count(), "pack-histogram")
    histogram = np.zeros(window // width + 1, "i8")
    for r in by_task.groupBy("bin").agg(F.sum("count").alias("n")).collect():  # one row per bin
        histogram[r["bin"]] = r["n"]
    slots = plan(histogram, width)
    n_combined = max((first + m for *_, m, first in slots), default=0)

    before = by_task.select("task", "bin", F.coalesce(F.sum("count").over(
        Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = (short.withColumn("here", F.row_number().over(Window.partitionBy("task", "bin").orderBy("rid")) - 1)
              .join(before, ["task", "bin"]).withColumn("rank", F.col("before") + F.col("here")))
    named = spark.createDataFrame(slots, "bin int, slot int, first_rank long, copies long, first_seq long")
    placed = (ranked.alias("r").join(F.broadcast(named).alias("s"), (F.col("r.bin") == F.col("s.bin")) & (F.col("rank") >= F.col("first_rank"))
                                     & (F.col("rank") < F.col("first_rank") + F.col("copies")), "left")
              .select("rid", "task", "n", "rest", "slot", (F.col("first_seq") + F.col("rank") - F.col("first_rank")).alias("seq")))
    placed = written(placed, "pack-placed")

    # the lines: residual remainders, and the gaps of combined sequences
    residual = line(placed.where("seq is null").select("rid", "task", "n", "rest"), F.col("task"), ["rid"], "rest", "u")
    residual = written(residual.select("rid", "n", "rest", "u", F.col("rest").alias("u_len")), "pack-residual")
    filled = placed.where("seq is not null").groupBy("seq").agg((window - F.sum("rest")).alias("v_len"), F.sum("rest").alias("used"))
    gaps = line(filled.where("v_len > 0"), F.expr("seq div 8192"), ["seq"], "v_len", "v")
    gaps = written(gaps.select("seq", "v", "v_len", "used"), "pack-gaps")
    gap_sum = gaps.agg(F.coalesce(F.sum("v_len"), F.lit(0))).first()[0]
    over = max(0, residual.agg(F.coalesce(F.sum("rest"), F.lit(0))).first()[0] - gap_sum)

    place = placed.where("seq is not null").withColumn(
        "offset", F.coalesce(F.sum("rest").over(Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = [place.select("rid", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"), "seq", "offset")]
    start = F.col("n") - F.col("rest") + F.col("at") - F.col("u")
    in_gaps = overlap(residual, gaps, 8 * window)
    parts.append(in_gaps.select("rid", start.alias("start"), F.col("part").alias("length"), "seq", (F.col("used") + F.col("at") - F.col("v")).alias("offset")))

    # what the gaps do not hold: whole windows, then powers of two
    rest = (residual.where(F.col("u") + F.col("u_len") > gap_sum)
            .withColumn("from", F.greatest(F.col("u") - gap_sum, F.lit(0))).withColumn("to", F.col("u") + F.col("u_len") - gap_sum))
    tail, sizes = over % window, []
    ends = [over - tail]
    for k in reversed(range(window.bit_length() - 1)):
        if tail >> k & 1:
            sizes.append(1 << k)
            ends.append(ends[-1] + (1 << k))
    bounds = F.array(*[F.lit(int(e)).cast("long") for e in ends])
    windows = F.expr(f"transform(sequence(from div {window}, (to - 1) div {window}), k -> k * {window})")
    cuts = F.array_sort(F.array_distinct(F.filter(F.concat(windows, bounds), lambda c: (c > F.col("from")) & (c < F.col("to")))))
    edges = F.concat(F.array("from"), cuts, F.array("to"))
    spans = rest.withColumn("edges", edges).select("rid", "n", "rest", "u", "edges", F.posexplode(F.slice("edges", F.lit(1), F.size("edges") - 1)).alias("i", "a"))
    a, whole_end = F.col("a"), over - over % window
    small = F.aggregate(bounds, F.lit(0).cast("long"), lambda s, e: s + F.when(e <= a, 1).otherwise(0))  # sequences of the tail up to a
    last_end = F.aggregate(bounds, F.lit(0).cast("long"), lambda s, e: F.when(e <= a, e).otherwise(s))
    in_tail = a >= whole_end
    n_windows = whole_end // window
    parts.append(spans.select(
        "rid", (F.col("n") - F.col("rest") + a + gap_sum - F.col("u")).alias("start"),
        (F.get("edges", F.col("i") + 1) - a).alias("length"),
        (n_combined + F.when(in_tail, n_windows + small - 1).otherwise(F.expr(f"a div {window}"))).alias("seq"),
        F.when(in_tail, a - last_end).otherwise(F.expr(f"a % {window}")).alias("offset")))

    base = n_combined + n_windows + len(sizes)
    many = line(docs.where("full > 0").select("rid", "task", "full"), F.col("task"), ["rid"], "full", "before")
    parts.append(many.select("rid", "before", F.posexplode(F.expr("sequence(0L, full - 1)")).alias("i", "k"))
                 .select("rid", (F.col("k") * window).alias("start"), F.lit(window).cast("long").alias("length"),
                         (base + F.col("before") + F.col("k")).alias("seq"), F.lit(0).cast("long").alias("offset")))
    pieces_ = parts[0]
    for p in parts[1:]:
        pieces_ = pieces_.unionByName(p)
    # cut inside a window where blocks of the line meet: pieces of one document that follow each other are one
    w = Window.partitionBy("seq", "rid").orderBy("start")
    new = F.coalesce((F.lag("start").over(w) + F.lag("length").over(w) != F.col("start"))
                     | (F.lag("offset").over(w) + F.lag("length").over(w) != F.col("offset")), F.lit(True))
    merged = (pieces_.withColumn("run", new.cast("int")).withColumn("run", F.sum("run").over(w))
              .groupBy("seq", "rid", "run").agg(F.min("start").alias("start"), F.sum("length").alias("length"), F.min("offset").alias("offset")))
    return (written(merged, "pack-pieces").join(rows, "rid")
            .select("rid", "id", "start", "length", F.col("seq").alias("sequence_id"), "offset", F.col("n").alias("doc_tokens"),
                    F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids")))
