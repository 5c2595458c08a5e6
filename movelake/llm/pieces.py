"""Texts in Arrow batches of bounded bytes, cut into pieces that tokenize alone.

A piece is white space and the run of other characters after it. Before white
space that follows another character no pre-tokenizer pattern used here has a
match that goes on, so the tokens of a text are those of its pieces in order.
Python's white space also has U+001C to U+001F, which those patterns count as
symbols; texts that hold one stay whole.
"""

from __future__ import annotations

import ctypes
import re
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = re.compile(r"\s*\S+|\s+")
_UNSAFE = re.compile(r"[\x1c-\x1f]")


def cut(text: str) -> list[str]:
    return [text] if _UNSAFE.search(text) else _PIECE.findall(text)


def by_bytes(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about ``most`` bytes of text, with the texts (null: empty)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("i8"))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at), [x or "" for x in texts.slice(at, to - at).to_pylist()]
            at = to
        _give_back()


def _give_back() -> None:
    """Freed memory to the system: a worker lives on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


class Known:
    """Results by piece, at most ``limit`` of them (then it starts anew)."""

    def __init__(self, solve: Callable[[list[str]], Iterable], limit: int = 250_000):
        self.solve, self.limit, self.found = solve, limit, {}

    def get(self, texts: list[list[str]]) -> dict:
        wanted = set().union(*texts) if texts else set()
        new = [x for x in wanted if x not in self.found]
        if len(self.found) + len(new) > self.limit:
            self.found.clear()
            new = list(wanted)
        self.found.update(zip(new, self.solve(new)))
        return self.found
