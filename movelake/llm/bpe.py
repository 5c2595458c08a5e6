"""Byte-level BPE, speculate and verify.

For the words of a batch that were not met before: an Aho-Corasick automaton
of the vocabulary proposes the greedy longest match (speculation); then all
adjacent token pairs of all words are tested at once with numpy (verification).
A token sequence is the BPE result exactly if every token is its own result
and no pair would have merged across its boundary. Words that fail are merged
exactly, by rank.

Two tokens a, b: merges run in order of rank, so going back in time the later
made of the two border nodes is undone first. The border nodes that exist at
one time are thus met in turn; they merge if their rank is below that of the
merge that takes the left one, and not above that of the merge that takes the
right one (of equal merges the left one runs first).

Defined cases: null and empty texts have no tokens and decode to the empty
text; special strings in a text are their special token, as in the library's
default; rows may repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from movelake.llm import pieces
from movelake.llm.common import python_ready, whole

#: Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LAST = np.int64(1 << 40)
BREAK = "Ā"  # no byte
SHORT = 64  # longest word, in bytes, that is merged with many others at once


def byte_letters() -> dict[str, int]:
    """The letter of each byte in vocabulary files: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> tuple[dict, dict[bytes, int], np.ndarray]:
    """The file, ids of the vocabulary's byte strings, and every id's bytes (special tokens included)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    ids = {bytes(map(letters.__getitem__, t)): i for t, i in spec["model"]["vocab"].items()}
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    table = np.array([b""] * (1 + max([*ids.values(), *special.values()])), dtype=object)
    for b, i in (ids | special).items():
        table[i] = b
    return spec, ids, table


class Vocabulary:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        spec, ids, table = token_bytes(path)
        letters, n = byte_letters(), len(table)
        raw = lambda t: bytes(map(letters.__getitem__, t))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.rank, self.left, self.right = np.full(n, -1, "i8"), np.zeros(n, "i8"), np.zeros(n, "i8")
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = ids[raw(a)], ids[raw(b)], ids[raw(a + b)]
            self.merges.setdefault((x, y), (r, z))
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        keys = np.array([x << 32 | y for x, y in self.merges], "i8")
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_rank, self.key_result = (np.array([m[k] for m in self.merges.values()], "i8")[order] for k in (0, 1))
        self.lens = np.array([len(b) for b in table], "i8")
        self.words = regex.compile(PATTERN)
        self.known = pieces.Known(self.encode_words, 500_000)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.auto = ahocorasick.Automaton()
        for (b, i), own in zip(ids.items(), self.exact_many(list(ids))):
            if own == np.array([i], "<u4").tobytes():  # else never a result
                self.auto.add_word(b.decode("latin-1"), i)
        self.auto.make_automaton()

    def exact(self, word: bytes) -> list[int]:
        """Merges by rank, leftmost first, until none applies: a heap of pairs over a linked list."""
        out: list = [self.byte_id[b] for b in word]
        n = len(out)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merges[p], i, p) for i, p in enumerate(zip(out, out[1:])) if p in self.merges]
        heap = [(r, i, z, p) for r, z, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, z, (x, y) = heapq.heappop(heap)
            j = after[i]
            if out[i] != x or j >= n or out[j] != y:
                continue  # one of the two has been merged meanwhile
            out[i], out[j] = z, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (out[k], out[after[k]])) in self.merges:
                    r, z = self.merges[p]
                    heapq.heappush(heap, (r, k, z, p))
        return [t for t in out if t is not None]

    def exact_many(self, words: list[bytes]) -> list[bytes]:
        """The same for many short words at once: each round merges every word's lowest pair."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        of = np.repeat(np.arange(len(words)), sizes)
        t = np.array(self.byte_id, "i8")[np.frombuffer(b"".join(words), "u1")]
        done_of, done = [], []
        while len(t):
            r, z = self.pairs(t[:-1], t[1:])
            r[of[:-1] != of[1:]] = LAST
            r, z = np.append(r, LAST), np.append(z, 0)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            low = np.repeat(np.minimum.reduceat(r, first), np.diff(first, append=len(of)))
            over = low == LAST
            done_of.append(of[over])
            done.append(t[over])
            at = ~over & (r == low)
            at[1:] &= ~at[:-1] | (of[1:] != of[:-1])  # of overlapping equal pairs, the first of each run
            t = np.where(at, z, t)
            keep = ~over
            keep[1:] &= ~at[:-1]
            t, of = t[keep], of[keep]
        of, t = np.concatenate(done_of), np.concatenate(done)
        order = np.argsort(of, kind="stable")
        raw, ends = t[order].astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(of, minlength=len(words)))
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def pairs(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair's merge (LAST and 0 where there is none)."""
        key = x << 32 | y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        is_pair = self.keys[at] == key
        return np.where(is_pair, self.key_rank[at], LAST), np.where(is_pair, self.key_result[at], 0)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each adjacent pair, whether it stays as it is."""
        ok, at = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.astype("i8"), b.astype("i8")
        taken_x, taken_y = np.full(len(a), LAST), np.full(len(a), LAST)  # rank of the merge that takes the node
        while len(at):
            r, _ = self.pairs(x, y)
            merges = (r < taken_x) & (r <= taken_y) & (r < LAST)
            ok[at[merges]] = False
            go = ~merges & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            at, x, y, taken_x, taken_y = at[go], x[go], y[go], taken_x[go], taken_y[go]
            rx, ry = self.rank[x], self.rank[y]
            back_x = rx > ry
            taken_x, taken_y = np.where(back_x, rx, taken_x), np.where(back_x, taken_y, ry)
            x, y = np.where(back_x, self.right[x], x), np.where(back_x, y, self.left[y])
        return ok

    def speculate(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Greedy longest matches of each word, and which words they are right for."""
        ends = np.cumsum([len(w) + 1 for w in words])  # with the break
        found = list(self.auto.iter_long(BREAK.join(w.decode("latin-1") for w in words)))
        last, ids = np.array([e for e, _ in found], "i8"), np.array([i for _, i in found], "i8")
        of = np.searchsorted(ends, last, "right")
        near = of[1:] == of[:-1]
        good = np.ones(len(words), bool)
        covered = np.bincount(of, self.lens[ids], len(words)).astype("i8")
        good[covered != np.diff(ends, prepend=0) - 1] = False
        bad = np.flatnonzero(near)[~self.compatible(ids[:-1][near], ids[1:][near])]
        good[of[bad]] = False
        raw, cuts = ids.astype("<u4").tobytes(), (4 * np.searchsorted(of, np.arange(len(words) + 1))).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])], good

    def encode_pieces(self, new: list[str]) -> list[bytes]:
        """Token ids of each piece as little-endian 32-bit integers."""
        find = self.words.findall
        plan = [find(p) if "<" not in p or not self.marks else
                [w for q in self.marks.split(p) for w in ([q] if q in self.special else find(q))] for p in new]
        get = self.known.get(plan).__getitem__
        return [b"".join(map(get, p)) if len(p) > 1 else get(p[0]) for p in plan]

    def encode_words(self, names: list[str]) -> list[bytes]:
        """The same for words of the pattern, and special strings."""
        if not names:
            return []
        words = [w.encode() for w in names]
        out, good = self.speculate(words)
        failed = np.flatnonzero(~good).tolist()
        short = [i for i in failed if len(words[i]) <= SHORT]
        for i, t in zip(short, self.exact_many([words[i] for i in short])):
            out[i] = t
        for i in failed:
            if len(words[i]) > SHORT:
                out[i] = np.array(self.exact(words[i]), "<u4").tobytes()
        for i, w in enumerate(names):
            if w in self.special:
                out[i] = np.array([self.special[w]], "<u4").tobytes()
        return out


_VOCABULARY: dict[str, tuple[Vocabulary, pieces.Known]] = {}
_BYTES: dict[str, np.ndarray] = {}


def vocabulary(path: str) -> tuple[Vocabulary, pieces.Known]:
    """One per worker process and file."""
    if path not in _VOCABULARY:
        v = Vocabulary(path)
        _VOCABULARY[path] = v, pieces.Known(v.encode_pieces, 600_000)
    return _VOCABULARY[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 4 << 20,
           round_trip: bool = False) -> DataFrame:
    """id, ids (array of token ids) per row of docs; ``round_trip`` adds what
    ``decode`` makes of the ids, by the same task's worker."""
    python_ready(docs.sparkSession)

    def run(batches):
        _, known = vocabulary(path)
        table = _token_table(path)
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            parts = [pieces.cut(t) for t in texts]
            found = known.get(parts)
            rows = [b"".join(map(found.__getitem__, p)) for p in parts]
            offsets = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype("i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            columns = [batch.column(0), ids, *([_decoded(ids, table)] if round_trip else [])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][:len(columns)])

    given = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * round_trip)


def _token_table(path: str) -> np.ndarray:
    if path not in _BYTES:
        _BYTES[path] = token_bytes(path)[2]
    return _BYTES[path]


def _decoded(ids: pa.ListArray, table: np.ndarray) -> pa.Array:
    ends = ids.offsets.to_numpy()
    values = table[ids.values.to_numpy()]
    return pa.array([b"".join(values[a:b]).decode("utf-8", "replace") for a, b in zip(ends, ends[1:])], pa.string())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (id, ids) with ``decoded``: the tokens' bytes as UTF-8, invalid
    sequences replaced, special tokens included. Null ids decode to nothing."""
    python_ready(encoded.sparkSession)

    def run(batches):
        table = _token_table(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _decoded(batch.column(1), table)], ["id", "ids", "decoded"])

    given = encoded.select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")
