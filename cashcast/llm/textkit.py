"""Vectorised helpers on the UTF-8 bytes of Arrow text columns.

A batch is cut into pieces of whole texts of about ``PIECE`` bytes (one longer text is a
piece of its own), so the arrays of a task stay small however large the batch is. Spans of
bytes get 64-bit polynomial hashes from one prefix sum, so hashing all words or lines of a
piece costs a few array passes. A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
#: Texts of a piece at most.
PIECE_ROWS = 1 << 13

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_MIX = U64(0xD6E8FEB86659FD93)
_POW = np.ones(1, U64)
_INV = np.ones(1, U64)


def byte_table(*ranges: tuple[int, int], invert: bool = False) -> np.ndarray:
    """Truth table over the 256 byte values; ranges are inclusive."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return ~t if invert else t


#: Bytes of words ``[^\x20\x09-\x0D]+``: all that is not blank.
NON_BLANK = byte_table((0x20, 0x20), (0x09, 0x0D), invert=True)
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Codes that give A-Z the values of a-z.
LOWER = _CODES.copy()
LOWER[0x41:0x5B] = _CODES[0x61:0x7B]
#: Codes that also give every digit one value.
FOLDED = LOWER.copy()
FOLDED[0x30:0x3A] = _CODES[0x30]
EXACT = _CODES


def pieces(col: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from the piece's start) of runs of whole texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, i + PIECE_ROWS)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def _powers(n: int) -> None:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("_POW", _BASE), ("_INV", pow(_BASE, -1, 2**64))):
            a = np.full(size, base, U64)
            a[0] = 1
            globals()[name] = np.cumprod(a, dtype=U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits."""
    h = (h ^ (h >> U64(32))) * _MIX
    h = (h ^ (h >> U64(32))) * _MIX
    return h ^ (h >> U64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of the base; spans of it are hashed by ``span_hash``."""
    _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _POW[:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of the sequence behind ``sums``."""
    return mix((sums[ends] - sums[starts]) * _INV[starts])


def word_spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text row) of the maximal runs of ``table`` bytes; none crosses a text."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = inside[0], inside[-1]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    # a run that goes on over the border of two texts is cut there
    through = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(through):
        starts = np.sort(np.concatenate([starts, through]))
        ends = np.sort(np.concatenate([ends, through]))
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of true bytes in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def row_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """Index of each text's first word (n + 1 values), for sorted ``rows``."""
    return np.searchsorted(rows, np.arange(n + 1))


def window_hash(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words; entry i starts at word i."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    at = np.arange(n)
    return span_hash(prefix_sums(words), at, at + length)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def distinct(rows: np.ndarray, h: np.ndarray, major: np.ndarray | None = None) -> np.ndarray:
    """Indices of the distinct hashes of each text, in the order of text, ``major`` (below 64) and hash."""
    top = rows.astype(U64) << U64(50)
    if major is not None:
        top |= major.astype(U64) << U64(44)
    key = top | (h >> U64(20))
    order = np.argsort(key)
    k, v = key[order], h[order]
    tie = k[1:] == k[:-1]
    if np.any(tie & (v[1:] != v[:-1])):  # equal in 44 bits only
        order = np.lexsort((h, key))
        k, v = key[order], h[order]
        tie = k[1:] == k[:-1]
    new = np.ones(len(order), bool)
    new[1:] = ~(tie & (v[1:] == v[:-1]))
    return order[new]


def shingles(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text row) of all runs of ``length`` words; a shorter text with words is one run.

    Words are runs of non-blank bytes, A-Z taken as a-z.
    """
    starts, ends, rows = word_spans(data, off, NON_BLANK)
    words = span_hash(prefix_sums(LOWER[data]), starts, ends)
    g = window_hash(words, length)
    inside = rows[:len(g)] == rows[length - 1:length - 1 + len(g)]
    n = np.bincount(rows, minlength=len(off) - 1)
    short = np.flatnonzero((n > 0) & (n < length))
    if not len(short):
        return g[inside], rows[:len(g)][inside]
    first = row_starts(rows, len(off) - 1)
    whole = span_hash(prefix_sums(words), first[short], first[short] + n[short]) ^ U64(0x5851F42D4C957F2D)
    h, r = np.concatenate([g[inside], whole]), np.concatenate([rows[:len(g)][inside], short])
    order = np.argsort(r, kind="stable")
    return h[order], r[order]
