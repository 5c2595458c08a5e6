"""Rows that repeat an id, columns called like internal ones, and the pipeline's
stages by rows."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from movelake.llm import quality
from movelake.llm.substring_dedup import substring_dedup

P = pytest.importorskip("public_tokenizers")
NAMES = ["id", "h", "text_", "_", "_hit", "hit", "bm_at", "bm_block", "bm_bits", "bm_hit", "_sha", "sha", "sha256", "_rid", "rid", "q_words", "words",
         "n_words", "word_chars", "n_symbols", "rejected_by", "_rejected", "carried", "kept", "key", "len", "pre", "open", "runs", "n", "start", "fp", "root"]


def brute(rows, window):
    """Kept words per row: places are (id, hash of the text, start)."""
    place = lambda i, t: (i, np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype("i8"))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, t), w in zip(rows, words):
        if i is not None:
            for s in range(len(w) - window + 1):
                g, at = tuple(w[s:s + window]), (*place(i, t), s)
                first[g] = min(at, first.get(g, at))
    out = []
    for (i, t), w in zip(rows, words):
        gone = set()
        if i is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s:s + window])] < (*place(i, t), s):
                    gone |= set(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def some(rows):
    return collections.Counter(rows)


def test_substring_dedup_of_repeated_ids(spark):
    r = random.Random(3)
    say = lambda n: " ".join(r.choice("abcdefghijklmnop") * r.randint(1, 5) for _ in range(n))
    a, b, long = say(60), say(60), say(100) + " x" * 60_000
    rows = [(1, a), (2, a), (2, "four words of text"), (2, b), (2, b[:40] + " " + a), (3, b), (3, b), (3, None), (4, say(10) + a[:90]), (None, a), (None, b),
            (5, long), (5, long + " y"), (6, long[:300]), (7, a + " " + a), (7, a), (8, "")]
    rows += [(9, say(15) + " " + a + " " + say(15)) for _ in range(12)] + [(10, a)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = some((x.id, x.n_words, x.n_removed, x.kept) for x in substring_dedup(docs, window=20).collect())
    assert got == some(brute(rows, 20))


def named(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return d.select("doc_id", "text", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def passages():
    r = random.Random(6)
    say = lambda n: " ".join(r.choice("abcdefghijklmnop") * r.randint(1, 5) for _ in range(n))
    shared = say(55)
    rows = [(i, say(40) + " " + (shared if i % 3 == 0 else say(55)) + "\n" + say(r.randint(0, 200))) for i in range(40)]
    rows += [(100, rows[4][1].upper()), (101, rows[5][1]), (101, rows[5][1]), (102, rows[6][1] + " more"), (None, rows[7][1]), (None, rows[7][1]), (None, say(70)),
             (103, rows[8][1]), (103, say(66)), (104, "few words"), (105, ""), (106, None), (107, "same words again " * 300), (108, "# $ % " * 60)]
    return rows


def test_no_operator_loses_or_stumbles_over_a_column(spark):
    docs = named(spark, passages())
    out = quality.with_counts(docs)
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert out.columns == [c for c in docs.columns if c not in counted] + counted
    out = substring_dedup(docs, carry=tuple(docs.columns))
    assert out.select("carried.*").columns == docs.columns
    assert out.where("carried._hit is distinct from concat('_hit:', id)").where("id is not null").count() == 0


def test_pipeline_stages_by_rows(spark, tmp_path):
    import corpus_pipeline as c
    from tokenizers import Tokenizer

    low = lambda t: "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")
    given, stage = named(spark, passages()), dict(c.STAGES)
    columns = given.columns

    def step(name, docs):
        stage[name](spark, docs, "").write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == columns
        for n in NAMES:
            assert out.where(F.col(f"`{n}`") != F.concat(F.lit(f"{n}:"), F.col("doc_id"))).count() == 0
        return out, [(x.doc_id, x.text) for x in out.select("doc_id", "text").collect()]

    docs, kept = step("quality rules", given)

    def good(t):
        w, lines = re.findall(r"[^\x20\x09-\x0D]+", t or ""), [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        again = {i + j for s in at.values() if len(s) > 1 for i in s for j in range(8)}
        n, chars = len(w), sum(map(len, w))
        return (n >= 20 and 100 * len(again) <= 30 * n and 100 * len(re.findall(r"[#*$%&|<>]", t)) <= 25 * n and 100 * (len(lines) - len(set(lines))) <= 10 * n
                and 100 * t.count("!") <= 50 * n and 2 * n <= chars <= 30 * n)

    assert some(kept) == some((i, t) for i, t in passages() if good(t)) and 40 < len(kept) < len(passages())

    docs, exact = step("exact dedup", docs)
    groups = collections.defaultdict(list)
    for i, t in kept:
        groups[low(t)].append(-1 if i is None else i)
    assert some((low(t), -1 if i is None else i) for i, t in exact) == some((t, max(ids)) for t, ids in groups.items())

    docs, near = step("near dedup", docs)
    prints = []
    for i, t in exact:
        w = low(t).split()
        h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]), 42) for k in range(len(w) - 2)]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    left, stay = set(range(len(exact))), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            new = {y for y in left if (prints[x] ^ prints[y]).bit_count() <= 2}
            left -= new
            todo += new
        stay.append(min((exact[g][0] is None, exact[g][0] or 0) for g in group))
    assert some((i is None, i or 0) for i, _ in near) == some(stay) and set(near) <= set(exact)

    docs, cut = step("substring dedup", docs)
    want = {}
    for (i, t), (_, _, gone, text) in zip(near, brute(near, 20)):
        want.setdefault(i, []).append(text if gone else t)
    assert some(cut) == some((i, t) for i, ts in want.items() for t in ts) and sum(len(t) for _, t in cut) < sum(len(t) for _, t in near)

    pieces = stage["packing"](spark, docs.where("doc_id is not null and doc_id != 103"), "").collect()
    tokens = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = {i: t for i, t in cut if i not in (None, 103)}
    by = collections.defaultdict(list)
    for x in pieces:
        by[x.doc_id].append(x)
    assert set(by) == set(texts)
    for i, ps in by.items():
        ids = np.array(tokens.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        ps.sort(key=lambda x: x.start)
        assert [x.start for x in ps] == [0, *np.cumsum([x.length for x in ps])[:-1]] and sum(x.length for x in ps) == len(ids) == ps[0].doc_tokens
        assert all(x.ids_crc32 == zlib.crc32(ids[x.start:x.start + x.length].tobytes()) for x in ps)
    rows = collections.defaultdict(list)
    for x in pieces:
        rows[x.sequence_id].append((x.offset, x.length))
    for r in rows.values():
        r.sort()
        assert [o for o, _ in r] == [0, *np.cumsum([n for _, n in r])[:-1]] and sum(n for _, n in r) <= 2048
