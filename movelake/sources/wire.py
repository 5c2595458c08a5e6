"""Fields of many protobuf messages at once, as arrays.

``fields`` walks all messages in step: each round reads the next field of every
message that has one left, so the number of rounds is the largest number of
fields, not the number of messages. It expects bytes that a protobuf parser has
accepted and gives up (``Unusual``) where order or merging would matter: groups,
and a sub-message that is given twice.
"""

from __future__ import annotations

import numpy as np

VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5


class Unusual(Exception):
    """Valid, but not as simple as this module reads it; ``places`` are bytes
    of all the messages where this round found it."""

    def __init__(self, why: str, places=()):
        super().__init__(why)
        self.places = places


def varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value as unsigned, place after it) of the varints at these places."""
    byte = data[at]
    value, after = (byte & 127).astype("u8"), at + 1
    more = np.flatnonzero(byte & 128)
    shift = 7
    while len(more):
        byte = data[after[more]]
        value[more] |= (byte & np.uint8(127)).astype("u8") << np.uint64(shift)
        after[more] += 1
        more, shift = more[(byte & 128) != 0], shift + 7
    return value, after


def one_by_one(body: bytes, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every occurrence of a message field at the top level."""
    starts, ends, at, size = [], [], 0, len(body)

    def varint(at: int) -> tuple[int, int]:
        value, shift = 0, 0
        while True:
            b = body[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    while at < size:
        tag, at = varint(at)
        kind = tag & 7
        if kind == BYTES:
            n, at = varint(at)
            if tag >> 3 == number:
                starts.append(at)
                ends.append(at + n)
            at += n
        elif kind == VARINT:
            _, at = varint(at)
        elif kind in (FIXED64, FIXED32):
            at += 8 if kind == FIXED64 else 4
        else:
            raise Unusual("group")
    return np.array(starts, "i8"), np.array(ends, "i8")


def fields(data: np.ndarray, start: np.ndarray, end: np.ndarray, single: set[int] = frozenset(), message: set[int] = frozenset(),
           repeated: set[int] = frozenset()) -> dict[int, tuple]:
    """Per field number (has, value, end) by message: of ``single`` fields the
    last value (of bytes and fixed widths the place), of ``message`` fields the
    only one. Of ``repeated`` fields (owner, start, end) of every occurrence."""
    n = len(start)
    out = {f: (np.zeros(n, "?"), np.zeros(n, "u8"), np.zeros(n, "i8")) for f in (*single, *message)}
    many: dict[int, list] = {f: [] for f in repeated}
    live, at = np.flatnonzero(start < end), start[start < end]
    while len(live):
        tag, at = varints(data, at)
        number, kind = (tag >> np.uint64(3)).astype("i8"), (tag & np.uint64(7)).astype("i1")
        value, after = at.astype("u8"), at + np.where(kind == FIXED64, 8, 4)
        v = np.flatnonzero((kind == VARINT) | (kind == BYTES))
        if len(v):
            value[v], after[v] = varints(data, at[v])
        b = np.flatnonzero(kind == BYTES)
        if len(b):
            length = value[b].astype("i8")
            value[b], after[b] = after[b].astype("u8"), after[b] + length
        group = (kind == 3) | (kind == 4)
        if group.any():
            raise Unusual("group", at[group] - 1)
        for f in np.unique(number).tolist():
            if f in out or f in many:
                m = np.flatnonzero(number == f)
                if f in many:
                    many[f].append((live[m], value[m].astype("i8"), after[m]))
                    continue
                has, x, e = out[f]
                if f in message and has[live[m]].any():
                    raise Unusual("message given twice", at[m][has[live[m]]] - 1)
                has[live[m]], x[live[m]], e[live[m]] = True, value[m], after[m]
        more = after < end[live]
        live, at = live[more], after[more]
    for f, found in many.items():
        owner, s, e = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, "i8"),) * 3
        order = np.argsort(owner, kind="stable")  # rounds go in order of place
        out[f] = (owner[order], s[order], e[order])
    return out


def _is_text(b: bytes) -> bool:
    try:
        b.decode()
    except UnicodeDecodeError:
        return False
    return True


def texts(data: np.ndarray, has: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Arrow strings of these places, null where there is none; raises
    UnicodeDecodeError, with the ``places`` of those that are not, unless all
    are UTF-8."""
    import pyarrow as pa
    s, n = start.astype("i8"), np.where(has, end - start.astype("i8"), 0)
    offsets = np.zeros(len(n) + 1, "i8")
    np.cumsum(n, out=offsets[1:])
    content = data[np.arange(offsets[-1]) + np.repeat(s - offsets[:-1], n)]
    first = content[offsets[:-1][n > 0]]
    whole = content.tobytes()
    if not _is_text(whole) or ((first & 0xC0) == 0x80).any():  # the whole may be right where its parts are not
        error = UnicodeDecodeError("utf-8", b"", 0, 1, "not UTF-8, or begins inside a character")
        error.places = s[[i for i in range(len(n)) if not _is_text(whole[offsets[i]:offsets[i + 1]])]]
        raise error
    valid = pa.py_buffer(np.packbits(has, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(n), [valid, pa.py_buffer(offsets), pa.py_buffer(content)]).cast(pa.string())


def numbers(data: np.ndarray, has: np.ndarray, value: np.ndarray, dtype: str):
    """Arrow numbers: varints by their lowest bits, floats from their places."""
    import pyarrow as pa
    if dtype == "f4":
        at = np.where(has, value, 0).astype("i8")
        raw = np.stack([data[np.minimum(at + i, len(data) - 1)] for i in range(4)], axis=1)
        value = np.ascontiguousarray(raw).view("<f4").ravel()
    else:
        value = value.view("i8").astype(dtype)
    return pa.array(value, mask=~has)
