"""Vectorised word splitting and word/n-gram hashing over Arrow string columns.

Every operator on words works on blocks of whole texts: the UTF-8 bytes of some
hundred documents in one numpy array. All separators are ASCII, so splitting
bytes equals splitting code points. Word hashes are polynomial sums over random
64-bit byte codes (mod 2^64), taken from one running sum; n-gram hashes are the
same over word hashes. A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse mod 2^64
INVERSE = pow(MULT, -1, 1 << 64)
BLOCK_BYTES = 1 << 20  # text bytes worked on at once (a longer text is a block of its own)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection): all output bits depend on all input bits."""
    x = np.asarray(x, U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(MULT))
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse."""
    if len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 1))
        for name, base in (("up", MULT), ("down", INVERSE)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """256 flags, set inside the inclusive spans."""
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo:hi + 1] = True
    return out


#: Words are runs of other characters than space and U+0009..U+000D.
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII digits, lower-case letters and all beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words(NamedTuple):
    """Words of a block: byte spans and, per document, the range of its words."""

    data: np.ndarray    # uint8, bytes of the block (lower-cased where asked)
    starts: np.ndarray  # int64, first byte of each word
    ends: np.ndarray    # int64, one past its last byte
    ptr: np.ndarray     # int64, documents + 1: words of document i are ptr[i]..ptr[i+1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes:
    (first row, end row, bytes, offsets of the rows in them)."""
    column = pc.fill_null(column, "")
    if pa.types.is_string(column.type):
        width = np.int32
    else:
        column, width = column.cast(pa.large_string()), np.int64
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def split_words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, lower: bool) -> Words:
    """Words of every document of a block; a word never spans two documents."""
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64))
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = off[(off > 0) & (off < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return Words(data, starts, ends, np.searchsorted(starts, off))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    if not len(w.starts):
        return np.zeros(0, U64)
    up, down = powers(len(w.data) + 1)
    run = np.empty(len(w.data) + 1, U64)
    run[0] = 0
    np.cumsum(BYTE_CODES[w.data] * up[:-1], out=run[1:])
    return mix((run[w.ends] - run[w.starts]) * down[w.starts] + (w.ends - w.starts).astype(U64) * U64(MULT))


def ngram_hashes(codes: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` codes inside one document.

    Returns the hashes in text order and their document pointer (as ``Words.ptr``):
    a document of n codes has max(0, n - k + 1) of them, the j-th starting at code j.
    """
    counts = np.maximum(np.diff(ptr) - (k - 1), 0)
    out_ptr = np.zeros(len(ptr), np.int64)
    np.cumsum(counts, out=out_ptr[1:])
    if not out_ptr[-1]:
        return np.zeros(0, U64), out_ptr
    up, down = powers(len(codes) + 1)
    run = np.empty(len(codes) + 1, U64)
    run[0] = 0
    np.cumsum(codes * up[:-1], out=run[1:])
    at = np.arange(out_ptr[-1]) + np.repeat(ptr[:-1] - out_ptr[:-1], counts)
    return mix((run[at + k] - run[at]) * down[at]), out_ptr


def sequence_hashes(codes: np.ndarray, ptr: np.ndarray, salt: int = 0) -> np.ndarray:
    """One 64-bit hash of each document's whole code sequence, with its length."""
    up, down = powers(len(codes) + 1)
    run = np.zeros(len(codes) + 1, U64)
    np.cumsum(mix(codes + U64(salt)) * up[:-1], out=run[1:])
    return mix((run[ptr[1:]] - run[ptr[:-1]]) * down[ptr[:-1]] + np.diff(ptr).astype(U64) * U64(MULT))


def joined(w: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every document's (kept) words joined by one space, and the
    documents' offsets in them."""
    starts, ends, ptr = w.starts, w.ends, w.ptr
    if keep is not None:
        ptr = np.concatenate([[0], np.cumsum(keep)])[ptr]
        starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(ptr), np.int64)
    size = ends - starts
    tail = np.ones(len(starts), np.int64)  # the byte after a word, a separator, serves as the space
    filled = ptr[1:] > ptr[:-1]
    tail[ptr[1:][filled] - 1] = 0
    out_end = np.cumsum(size + tail)
    step = np.ones(out_end[-1], np.int64)
    step[0] = starts[0]
    heads = out_end[:-1]
    step[heads] = starts[1:] - (ends + tail)[:-1] + 1
    at = np.cumsum(step)
    space = out_end[tail > 0] - 1
    at[space] = 0
    out = w.data[at]
    out[space] = 0x20
    return out, np.concatenate([[0], out_end])[ptr]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    out = np.sort(values)
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    return out[keep]


def distinct_per_doc(codes: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of each document, with their pointer."""
    parts = [distinct(codes[a:b]) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
    out = np.zeros(len(ptr), np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, codes.dtype)), out
