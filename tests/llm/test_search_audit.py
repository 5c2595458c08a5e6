"""Embedding near-duplicates, ranked search and the filter audit against brute
force, with nulls, empty and very long texts, ties, repeated rows, empty tables
and clashing column names."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from movelake.llm import embedding_dedup, filter_audit, queries, ranked_search

DOCS = "doc_id long, text string, lang string, id string, part int, mask int, digest int, n long, words string, rank int, q long, terms string, tfs int"
EXTRA = ("z", 1, 2, 3, 4, "w", 5, 6, "t", 7)


# --- embeddings -------------------------------------------------------------------
def brute(rows, threshold):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    link = {i: set() for i in range(len(rows))}
    for a, b in itertools.combinations(ok, 2):
        x, y = np.float32(rows[a][1]).astype("f8"), np.float32(rows[b][1]).astype("f8")
        if len(x) == len(y) and (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= threshold:
            link[a].add(b), link[b].add(a)
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = link[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((own, len(link[i]), low, own is not None and own == low))
    return out


def frame(spark, rows):
    kind = "vec_id long, embedding array<float>, id string, v int, node long, h1 long, h2 int, key int, t int, mine int, low int, component int"
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, 4, 5, 6, 7, 8, 9) for i, v in rows], kind).repartition(4)


def near(rng, x, cosine):
    y = rng.standard_normal(len(x))
    y -= (y @ x) * x / (x @ x)
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y)


@pytest.mark.parametrize("block", [1024, 8])
def test_embeddings_defined_cases(spark, block):
    rng = np.random.default_rng(3)
    base = [rng.standard_normal(16) for _ in range(60)]
    rows = [(i, x.tolist()) for i, x in enumerate(base)]
    rows += [(100 + i, near(rng, base[i], 0.999).tolist()) for i in range(0, 30)]
    rows += [(200 + i, near(rng, base[5], 0.998).tolist()) for i in range(40)]  # a crowd
    rows += [(300 + i, base[7].tolist()) for i in range(20)]  # equal ones
    rows += [(7, base[7].tolist()), (None, base[7].tolist()), (None, near(rng, base[59], 0.999).tolist()), (3, base[40].tolist())]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [0.0] * 16), (404, [float("nan")] + [1.0] * 15), (405, [None] + [1.0] * 15),
             (406, [float("inf")] + [1.0] * 15), (407, (base[9] * 1e30).tolist()), (408, base[9].tolist() + [0.0]), (409, (-base[9]).tolist()), (None, None)]
    got = [tuple(r) for r in embedding_dedup.near_duplicates(frame(spark, rows), block=block, recall=0.9999, load=16).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows, 0.95), key=key)


def test_embeddings_recall_at_the_threshold(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((1500, 48))
    rows = [(i, x.tolist()) for i, x in enumerate(base)] + [(2000 + i, near(rng, base[i], 0.9501 + 0.01 * rng.random()).tolist()) for i in range(1000)]
    x = np.float32([v for _, v in rows]).astype("f8")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = int((x @ x.T >= 0.95).sum()) - len(x)
    got = embedding_dedup.near_duplicates(frame(spark, rows), load=32)
    found = got.agg(F.sum("n_links")).first()[0]
    assert 0.95 * true <= found <= true


def test_no_embeddings(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, None), (2, [0.0])]):
        got = [tuple(r) for r in embedding_dedup.near_duplicates(frame(spark, rows)).collect()]
        assert sorted(got) == [(i, 0, i, True) for i, _ in rows]


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 24)) * np.linspace(3, 0.2, 24) + 1
    mean, matrix = embedding_dedup.learn(x, 2)
    share = ((x - mean) @ matrix > 0).mean(0)
    assert matrix.shape == (24, 48) and (abs(share - 0.5) < 0.1).all()
    assert np.allclose(matrix[:, :24].T @ matrix[:, :24], np.eye(24))


# --- ranked search ----------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def ranked(docs, items, k):
    found = [(i, Counter(low(t) for t in TERM.findall(x or ""))) for i, x in docs]
    found = [(i, c, c.total()) for i, c in found if c]
    n, length = len(found), sum(c[2] for c in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in found:
            m = 10 + (90 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in {low(t) for t in TERM.findall(text or "")} if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return out


def collection(seed=4, n=400):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "été", "漢字", "It", "It's", "x y", "a b", "Ω1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, r.choice([" ", "\n", ", "]).join(r.choices(vocabulary, weights, k=r.randint(0, 200)))) for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(None, docs[5][1]), (5, docs[5][1])]  # ties over id
    docs += [(2000, None), (2001, ""), (2002, "--- !!"), (2003, "w3 w299 " * 200_000), (2004, "x" * 3_000_000 + " w7")]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 40)))) for i in range(30)]
    return docs, items + [(50, None), (51, ""), (52, "zzz"), (53, docs[5][1]), (None, "w299 W7"), (3, "w1"), (3, "w1")]


@pytest.mark.parametrize("block_docs,block_postings,short,span", [(16_384, 2_000_000, 512, 4096), (64, 300, 3, 16), (100, 10_000, 0, 7)])
def test_ranked_search(spark, block_docs, block_postings, short, span):
    docs, items = collection()
    d = spark.createDataFrame([(i, t, "en", *EXTRA) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, item int, score int")
    got = ranked_search.search(d, q, k=10, block_docs=block_docs, block_postings=block_postings, short=short, span=span, most_pairs=100 if short == 3 else 10 ** 6)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(ranked(docs, items, 10), key=key)


def test_ranked_search_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b", "en", *EXTRA)], DOCS)
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(d.limit(0), q).count() == 0
    assert ranked_search.search(d, q.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in ranked_search.search(d, q).collect()] == [(1, 1, 1)]


# --- filter audit -----------------------------------------------------------------
def audited(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        rows.append((lang or "", fails, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                cut = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in rows if r[0] == part)
                out[part, order, step] = [len(left), len(cut), sum(r[1][f] for r in gone), alone, sum(r[2] for r in cut), sum(r[3] for r in cut)]
                shapley[f] += len(cut)
                gone += cut
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_filter_audit(spark):
    r = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)] + ["UPPER", "CAPS", "#", "a|b", "ünï"]
    docs = []
    for i in range(150):
        w = r.choices(vocabulary[:r.choice([20, 400])] + vocabulary[400:] * r.choice([0, 1]), k=r.choice([3, 150, 250, 400]))
        docs.append((i, r.choice([" ", "\n", " \t "]).join(w), r.choice(["en", "de", None, ""])))
    docs += [(200 + i, r.choice(docs)[1], r.choice(["en", "fr"])) for i in range(60)]
    docs += [(300, None, "en"), (301, "", "en"), (302, None, None), (303, "A" * 2_000_000, "en"), (304, "a b " * 500_000, "de")]
    docs += [docs[3], docs[3], (docs[3][0], docs[3][1], "fr"), (None, docs[3][1], "en"), (None, None, "de"), (3, "other", "en"), (9, docs[200][1], "en")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 260, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (999, 1, 1)]
    d = spark.createDataFrame([(i, t, lang, *EXTRA) for i, t, lang in docs], DOCS).repartition(4)
    x = spark.createDataFrame([(i, q, t, "a", 1) for i, q, t in labels], "doc_id long, quality int, toxic int, n string, id int")
    got = filter_audit.audit(filter_audit.mask_counts(d, x))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == audited(docs, labels)
    assert filter_audit.audit(filter_audit.mask_counts(d.limit(0), x)).count() == 0
    assert filter_audit.audit(filter_audit.mask_counts(d, x.limit(0))).agg(F.sum("good_lost")).first()[0] == 0


def test_intervals_are_lehmer_ranks():
    orders = list(itertools.permutations(range(4)))
    assert [filter_audit.lehmer_rank(p, 4) for p in orders] == list(range(24))
    for mask in range(1, 16):
        at = {}
        for m, step, since, until in filter_audit.intervals(4):
            if m == mask:
                at |= {rank: step for rank in range(since, until)}
        assert at == {k: next(j for j, f in enumerate(p, 1) if mask >> f & 1) for k, p in enumerate(orders)}


def test_registered_queries_have_the_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op11_embedding_dedup(spark, sf).dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert queries.op12_ranked_search(spark, sf).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert queries.op13_filter_audit(spark, sf).dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int")] + [
        (c, "bigint") for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
