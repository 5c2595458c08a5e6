"""Toxicity scores after noisy-channel deobfuscation.

* Language model: character trigrams of all documents' plain words, counted in
  Arrow batches and summed by Spark (one row per trigram of a small alphabet).
* Channel: a word of any length that holds a letter and any figure or sign, or
  a letter twice or more in a row, or Latin letters among look-alike letters of
  other alphabets, or single letters spaced out by any white space, becomes a
  lattice: each sign may be itself, a letter it looks like, or nothing, a run of
  one letter may be one or two, a look-alike may be the Latin letter. A star between
  letters is tried as a letter of its own as well. Viterbi decoding under the
  language model picks the restored word; words of plain letters have a single
  path and are not decoded. Distinct words are decoded once, and so are stretches
  of choices, which meet no other where two kept letters lie between.
* Classifier: on a sample of labelled rows (at most about ``most_rows``, taken
  by hash of the id) document frequencies of words and word beginnings give
  smoothed log-odds; what at least ``support`` toxic rows hold, however many
  there are, and reaches ``odds`` forms the lexicon (the ``most_words`` heaviest
  entries at most). It weighs its log-odds less their standard error, so that
  few rows weigh little. A text's evidence is the sum of its ``best`` strongest different
  words, mapped to a probability by a logistic curve fitted to the sample.

Rows learned from are the caller's choice; scores use texts alone.

Defined cases: null and empty texts have no evidence and get the curve's value
for none; labels that are null or of unknown ids are ignored, of repeated ones
the largest counts; without labels of both kinds every score is the share of
toxic ones (0 if there are none); repeated rows are scored alike. Columns other
than the id, text and label are not read and may have any name; texts of any
length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from movelake.llm import pieces
from movelake.llm.common import bitmap, python_ready, whole, with_hit, written

#: Letters that figures and signs look like.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
#: Cyrillic and Greek letters that look like Latin ones.
ALIKE = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
         "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Character classes of the model: 0 word edge, 1-26 a-z, 27 other letters; 28 marks figures and signs, which it does not count.
CLASSES, OTHER, NONE = 29, 27, 28
BITS = 1 << 24
_TRIM = ".,;:!?\"'()[]{}«»¿¡…-_*"


def classes(text: str) -> np.ndarray:
    """Class of every character of a lower-cased text."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    table = np.full(256, NONE, "u1")
    table[97:123] = np.arange(1, 27)
    table[[9, 10, 11, 12, 13, 32, *map(ord, ".,;:?\"'()")]] = 0
    table[0xC0:] = OTHER
    out = table[np.minimum(code, 255)]
    out[code > 255] = OTHER
    return out


def language_model(given: DataFrame, batch_bytes: int) -> np.ndarray:
    """log P(c | a, b) over CLASSES, from all texts."""
    def run(batches):
        for _, texts in pieces.by_bytes(batches, "text", batch_bytes):
            c = classes("\n".join(["", *texts, ""]).lower()).astype("i4")
            c = np.concatenate([[0], c])
            ok = (c[:-2] != NONE) & (c[1:-1] != NONE) & (c[2:] != NONE)
            n = np.bincount(((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:])[ok], minlength=CLASSES**3)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype("i4")), pa.array(n[at].astype("i8"))], ["gram", "n"])

    n = np.full(CLASSES**3, 0.1)
    for r in given.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():  # CLASSES ** 3 at most
        n[r["gram"]] += r["n"]
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(n / n.sum(2, keepdims=True)).astype("f4")


@lru_cache(1 << 14)
def _class(c: str) -> int:
    return int(classes(c)[0])


def is_mixed(word: str) -> bool:
    """Holds Latin letters and letters of other alphabets that look like Latin ones."""
    return not word.isascii() and any(c in LETTERS for c in word) and any(c in ALIKE for c in word)


def arcs(word: str, i: int, mixed: bool, looks: float = 0.7, skip: float = 1.0, sign: float = 9.0, star: float | None = None) -> list[tuple[str, float]]:
    """(letter or nothing, cost) for character i: what may stand behind it."""
    ch = word[i]
    if ch in LOOKS:
        return [(x, looks) for x in LOOKS[ch]] + [(ch, sign), ("", skip if ch in (word[i - 1:i], word[i + 1:i + 2]) else 12 * skip)]
    if ch == "*" and star is not None:
        return [(x, star) for x in LETTERS]
    if not ch.isalpha():
        return [(ch, sign), ("", skip)]
    if i > 1 and word[i - 2:i + 1] == 3 * ch:  # a run is one or two
        return [("", 0.0)]
    same = [(ALIKE[ch], looks), (ch, 0.0)] if mixed and ch in ALIKE else [(ch, 0.0)]
    if i and ch == word[i - 1]:
        return same + [("", 0.3 if word[i - 1:i + 2] == 3 * ch else 3 * skip)]
    return same


#: Figures that are word characters to a pattern, yet neither digits to it nor letters.
_FIGURES = "".join(c for c in map(chr, range(1 << 16)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
#: Letters of which every path holds one, unless they repeat; those beyond the first plane count as choices.
_KEPT = rf"[^\W\d_{_FIGURES}\U00010000-\U0010ffff]"
_SIGN = rf"(?!{_KEPT})."
_STRETCH = re.compile(rf"(?:{_SIGN}|(?<=(.))\1)(?:.?(?:{_SIGN}|(?<=(.))\2))*", re.S)

#: Stretches that are remembered: their length and number at most.
_SHORT, _MOST = 16, 100_000


def decode(word: str, model: np.ndarray, star: float | None = None, seen: dict | None = None) -> str:
    """The likeliest plain word behind a disguised one: Viterbi over a lattice
    whose states are the last two classes. With ``star``, each ``*`` is one
    letter of a-z at that cost, else a sign like others. Two kept letters leave
    one state, so stretches with two or more between are decoded apart, each
    with the two letters before and after it; ``seen`` holds those decoded."""
    if is_mixed(word):
        return likeliest(word, model, True, star)
    seen, parts, at = {} if seen is None else seen, [], 0
    for m in _STRETCH.finditer(word):
        start, end = m.span()
        before, after = min(start, 2), min(len(word) - end, 2)
        part = word[start - before:end + after]
        found = seen.get((part, star))
        if found is None:
            found = likeliest(part, model, False, star)
            if len(part) <= _SHORT:
                if len(seen) >= _MOST:
                    seen.clear()
                seen[part, star] = found
        parts += word[at:start], found[before:len(found) - after]
        at = end
    return "".join(parts) + word[at:]


def likeliest(word: str, model: np.ndarray, mixed: bool, star: float | None = None) -> str:
    """Viterbi over a whole word."""
    score_of = model.item
    paths = {(0, 0): (0.0, None)}  # score and chain of letters, last first
    for i in range(len(word)):
        choice = arcs(word, i, mixed, star=star)
        if len(choice) == 1 and not choice[0][0]:
            continue
        if len(choice) == 1 and len(paths) == 1:  # what all paths pay decides nothing
            ((_, b), (score, out)), = paths.items()
            paths = {(b, _class(choice[0][0])): (score, (out, choice[0][0]))}
            continue
        nxt: dict = {}
        for (a, b), (score, out) in paths.items():
            for x, cost in choice:
                if not x:
                    to, s, chain = (a, b), score - cost, out
                else:
                    c = _class(x)
                    to, s, chain = (b, c), score - cost + score_of(a, b, c), (out, x)
                if to not in nxt or s > nxt[to][0]:
                    nxt[to] = s, chain
        paths = nxt
    out = max(((score + score_of(a, b, 0), chain) for (a, b), (score, chain) in paths.items()), key=lambda x: x[0])[1]
    letters = []
    while out:
        out, x = out
        letters.append(x)
    return "".join(reversed(letters))


_LOOK = "".join(map(re.escape, LOOKS))
_LETTER = r"[^\W\d_]"
_HAS_LETTER, _RUN = re.compile(_LETTER), re.compile(rf"({_LETTER})\1")
_STAR = re.compile(r"\w\*+\w")
_EDGE = ".,;:?\"'()[]{}«»¿¡…"
_ONE = rf"[{re.escape(_EDGE)}]*(?:[^\W_]|[{_LOOK}])[{re.escape(_EDGE)}]*"
_SPACED = re.compile(rf"(?<!\S){_ONE}(?:\s+{_ONE}){{2,}}(?!\S)")
_BLANKS = re.compile(r"(\s+)")
#: 0 white space, 1 signs that may stand around a single letter, 2 others; the last for all above it.
_KIND = np.full(1 << 16, 2, "u1")
_KIND[[c for c in range(1 << 16) if chr(c).isspace()]] = 0
_KIND[[*map(ord, _EDGE)]] = 1


def spaced(texts: list[str]) -> list[list[str]]:
    """Per lower-cased text, the words behind runs of three single letters or
    more: of the whole run, and of its stretches between equal blanks."""
    out: list[list[str]] = [[] for _ in texts]
    kind = _KIND[np.minimum(np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), "<u4"), (1 << 16) - 1)]
    starts = np.flatnonzero((kind > 0) & (np.concatenate([[0], kind[:-1]]) == 0))
    if len(starts) < 3:
        return out
    one = np.add.reduceat(kind == 2, starts, dtype="i4") == 1
    ends = np.cumsum([len(t) + 1 for t in texts])
    for i in np.unique(np.searchsorted(ends, starts[:-2][one[:-2] & one[1:-1] & one[2:]], "right")).tolist():
        for m in _SPACED.finditer(texts[i]):
            parts = _BLANKS.split(m.group())
            letters, blanks = [x.strip(_EDGE) for x in parts[::2]], parts[1::2]
            cuts = [k for k in range(1, len(blanks)) if blanks[k] != blanks[k - 1]]
            for a, b in {(0, len(blanks)), *zip([0, *cuts], [*cuts, len(blanks)])}:
                word = "".join(letters[a:b + 1])
                if b - a > 1 and _HAS_LETTER.search(word):
                    out[i].append(word)
    return out


def _is_plain(word: str) -> bool:
    """A single path: nothing to decode."""
    return word.isalpha() and not _RUN.search(word) and not is_mixed(word)


def restored(word: str, model: np.ndarray, seen: dict | None = None) -> tuple[str, ...]:
    """What may stand behind a lower-cased word: with and without the signs at
    its ends decoded, if it holds a letter and any sign, figure, run or
    look-alike letter of another alphabet."""
    if _is_plain(word):
        return ()
    found = []
    for w in {word.strip(_EDGE), word.strip(_TRIM)}:
        if _is_plain(w) or not _HAS_LETTER.search(w):
            continue
        found.append(decode(w, model, seen=seen))
        if _STAR.search(w):
            found.append(decode(w, model, star=3.3, seen=seen))
    return tuple(found)


def restorer(model: np.ndarray) -> pieces.Known:
    """Distinct words are decoded once."""
    seen: dict = {}
    return pieces.Known(lambda new: [restored(w, model, seen) for w in new])


#: Per character, of which sort it is: 0 line end, 1 letters, 2 Latin ones, 3 letters that look like those, 4 signs of
#: ``_EDGE``, 5 others; the last for all above it.
_SORT = np.full(1 << 16, 5, "u1")
_SORT[[c for c in range(1 << 16) if chr(c).isalpha()]] = 1
_SORT[[*map(ord, LETTERS)]], _SORT[[*map(ord, ALIKE)]], _SORT[[*map(ord, _EDGE)]], _SORT[10] = 2, 3, 4, 0


def doubtful(words: list[str]) -> list[str]:
    """Words without white space that are more than plain letters between signs
    of ``_EDGE``: all those that ``restored`` finds something for, and a few more."""
    code = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), "<u4")
    sort = _SORT[np.minimum(code, (1 << 16) - 1)]
    ends = sort == 0
    letter = (sort > 0) & (sort < 4)
    odd = sort == 5
    odd[1:] |= letter[1:] & (code[1:] == code[:-1])
    found = np.logical_or.reduceat(odd, starts := np.flatnonzero(ends)[:-1])
    found |= np.add.reduceat(letter[1:] & ~letter[:-1], starts, dtype="i4") > 1  # signs between letters
    found |= np.logical_or.reduceat(sort == 2, starts) & np.logical_or.reduceat(sort == 3, starts)
    return [words[i] for i in np.flatnonzero(found).tolist()]


def word_sets(texts: list[str], known: pieces.Known) -> tuple[list[set[str]], set[str], dict[str, tuple[str, ...]]]:
    """Lower-cased words of each text and of all, and the words behind those that are disguised."""
    low = [t.lower() for t in texts]
    words = [set(t.split()).union(run) for t, run in zip(low, spaced(low))]
    every = set().union(*words)
    odd = doubtful([*every])  # plain words would push the decoded ones out of what is known
    found = known.get([odd])
    return words, every, {w: found[w] for w in odd if found[w]}


def features(words: set[str]) -> set[str]:
    """Words and their beginnings (marked by *)."""
    long = {x for w in words if len(x := w.strip(_TRIM)) > 2}
    return long.union(*({w[:k] + "*" for w in long if len(w) >= k} for k in (4, 5, 6)))


def heaviest(words: set[str], weights: dict[str, float]) -> dict[str, float]:
    """The largest weight among a word's features, for words that have one."""
    begins, of, out = {f[:3] for f in weights}, weights.get, {}  # a feature begins as its word does
    for word in words:
        w = word.strip(_TRIM)
        if w[:3] in begins and (v := max(of(w, 0.0), of(w[:4] + "*", 0.0), of(w[:5] + "*", 0.0), of(w[:6] + "*", 0.0))):
            out[word] = v
    return out


def lexicon(labelled: DataFrame, model, most_words: int, batch_bytes: int, support: int, odds: float) -> dict[str, float]:
    def run(batches):
        back = restorer(np.frombuffer(model.value, "f4").reshape((CLASSES,) * 3))
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            clean, toxic = n = Counter(), Counter()
            words, _, behind = word_sets(texts, back)
            for ws, y in zip(words, batch.column(1).to_pylist()):
                n[y].update(features(ws.union(*(behind[w] for w in behind.keys() & ws))))
            held = [*clean.keys() | toxic.keys()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), *(pa.array([x[f] for f in held], pa.int64()) for x in n)], ["f", "clean", "toxic"])

    totals = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    c, t = totals.get(0, 0), totals.get(1, 0)
    if not c or not t:
        return {}
    sums = labelled.select("text", "y").mapInArrow(run, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    weight = F.log((F.col("t") + 0.5) / (t + 1.0)) - F.log((F.col("c") + 0.5) / (c + 1.0))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))  # of the log-odds; the fewer rows, the larger
    kept = sums.where(F.col("t") >= support).where(weight >= odds).withColumn("w", weight - error).where("w > 0")
    return {r["f"]: float(r["w"]) for r in kept.orderBy(F.desc("w"), "f").limit(most_words).collect()}


def evidence(texts_df: DataFrame, model, lex, best: int, batch_bytes: int) -> DataFrame:
    """The given columns but text, with x: the summed log-odds of the text's strongest words."""
    rest = [c for c in texts_df.columns if c != "text"]

    def run(batches):
        back, weights = restorer(np.frombuffer(model.value, "f4").reshape((CLASSES,) * 3)), lex.value
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            words, every, behind = word_sets(texts, back)
            found = heaviest(every.union(*behind.values()), weights)
            brings = {w: xs for w in found.keys() | behind.keys() if (xs := {x for x in (w, *behind.get(w, ())) if x in found})}
            x = [sum(sorted((found[w] for w in set().union(*(brings[w] for w in brings.keys() & ws))), reverse=True)[:best]) for ws in words]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in rest] + [pa.array(x, pa.float64())], [*rest, "x"])

    kinds = ", ".join(f"`{c}` {texts_df.schema[c].dataType.simpleString()}" for c in rest)
    return texts_df.select(*rest, "text").mapInArrow(run, f"{kinds}, x double")


def curve(bins: list[tuple[float, int, int]], ridge: float = 1e-2, rounds: int = 50) -> tuple[float, float]:
    """a, b of P = 1 / (1 + exp(-a - b x)) for (x, label, rows), by Newton steps."""
    x, y, n = (np.array(v, float) for v in zip(*bins))
    z = np.stack([np.ones_like(x), x], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (n * (y - p)) - ridge * w
        h = (z * (n * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_rows: int = 30_000, most_words: int = 20_000, best: int = 3, support: int = 3, odds: float = 2.5,
          batch_bytes: int = 4 << 20) -> DataFrame:
    """id, score (0 to 1) per row of docs. ``labels``: only rows to learn from."""
    spark = docs.sparkSession
    python_ready(spark)
    given = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    model = spark.sparkContext.broadcast(language_model(given, batch_bytes).tobytes())

    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    share = min(1.0, most_rows / max(1, known.count()))
    sample = written(known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)), "toxic-labels")
    key = F.xxhash64("id")
    near = with_hit(given, key, bitmap(sample.select(key.alias("key")), "key", BITS), BITS, "hit").where("hit").drop("hit")
    labelled = written(near.join(sample, "id").select("text", "y"), "toxic-sample")

    lex = spark.sparkContext.broadcast(lexicon(labelled, model, most_words, batch_bytes, support, odds))
    seen = evidence(labelled, model, lex, best, batch_bytes).groupBy(F.round(F.col("x") * 4).alias("bin"), "y").count().collect()  # at most best * largest weight * 4 bins
    a, b = curve([(r["bin"] / 4, r["y"], r["count"]) for r in seen]) if {r["y"] for r in seen} == {0, 1} else (None, 0.0)
    if a is None:  # one kind of label, or none
        return given.select("id", F.lit(1.0 if seen and seen[0]["y"] == 1 else 0.0).alias("score"))
    x = evidence(given, model, lex, best, batch_bytes)
    return x.select("id", (1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("x"))))).alias("score"))
