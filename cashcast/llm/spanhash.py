"""Published hashes of byte spans (CRC-32, XXH64), for all spans of a piece of texts at once.

``textkit``'s own span hashes are enough where only equality counts; these two are for results
that name a hash function.
"""

from __future__ import annotations

import zlib

import numpy as np

from cashcast.llm import textkit as tk

U64 = np.uint64

#: Bytes with A-Z as a-z.
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[0x41:0x5B] += 0x20


def joined_words(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, text row) of the words with A-Z lower-cased and one blank after each.

    A run of words of one text, joined by one blank, is the span from its first word's start to
    its last word's end.
    """
    starts, ends, rows = tk.word_spans(data, off, table)
    lens = ends - starts
    at = np.cumsum(lens + 1) - (lens + 1)
    out = np.full(int(lens.sum()) + len(lens), 0x20, np.uint8)
    out[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = LOWER_BYTES[data[table[data]]]
    return out, at, at + lens, rows


#: Spans of up to this many bytes are hashed from tables by distance from the span's end.
CRC_NEAR = 64
CRC_SPANS = 1 << 15


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The CRC of a byte followed by d zeros without initial value, and of d zeros with it."""
    zeros = np.array([zlib.crc32(bytes(d)) for d in range(CRC_NEAR + 1)], np.uint32)
    tail = np.empty((CRC_NEAR, 256), np.uint32)
    tail[0] = [zlib.crc32(bytes([b])) ^ int(zeros[1]) for b in range(256)]
    for d in range(1, CRC_NEAR):
        tail[d] = tail[0][tail[d - 1] & np.uint32(0xFF)] ^ (tail[d - 1] >> np.uint32(8))
    return tail, zeros


_TAIL, _ZEROS = _crc_tables()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 (as zlib has it) of non-empty spans, as int64; CRCs are linear, so a span's is the
    XOR of its bytes' parts."""
    out = np.empty(len(starts), np.int64)
    for i in range(0, len(starts), CRC_SPANS):
        a, z = starts[i:i + CRC_SPANS], ends[i:i + CRC_SPANS]
        n = z - a
        near = n <= CRC_NEAR
        part = np.zeros(len(a), np.int64)
        if near.any():
            s, m = a[near], n[near]
            begin = np.cumsum(m) - m
            at = np.arange(int(m.sum())) + np.repeat(s - begin, m)
            x = _TAIL[np.repeat(s + m - 1, m) - at, data[at]]
            part[near] = np.bitwise_xor.reduceat(x, begin) ^ _ZEROS[m]
        for k in np.flatnonzero(~near):
            part[k] = zlib.crc32(data[a[k]:z[k]])
        out[i:i + CRC_SPANS] = part
    return out


# fixed values: the five primes of XXH64
P1, P2, P3, P4, P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rot(x: np.ndarray, k: int) -> np.ndarray:
    return (x << U64(k)) | (x >> U64(64 - k))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rot(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the spans, as uint64: each step of the function for all spans that need it."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # eight bytes from any place
    half = np.ndarray((len(data) + 5,), "<u4", padded, strides=(1,))
    n, pos = ends - starts, starts.copy()
    one = np.full(1, seed, U64)  # arrays wrap around without a warning
    h = np.full(len(n), (one + P5)[0], U64)
    wide = np.flatnonzero(n >= 32)
    if len(wide):
        wide = wide[np.argsort(-n[wide], kind="stable")]
        stripes = n[wide] >> 5
        acc = [np.full(len(wide), v[0], U64) for v in (one + P1 + P2, one + P2, one, one - P1)]
        for k in range(int(stripes[0])):
            go = int(np.searchsorted(-stripes, -k, "left"))  # spans with more than k stripes
            for j in range(4):
                acc[j][:go] = _round(acc[j][:go], word[pos[wide[:go]] + 32 * k + 8 * j])
        w = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
        for v in acc:
            w = (w ^ _round(U64(0), v)) * P1 + P4
        h[wide] = w
        pos[wide] += stripes << 5
    h += n.astype(U64)
    rest = n & 31
    for j in range(3):
        go = np.flatnonzero(rest >= 8 * (j + 1))
        if len(go):
            h[go] = _rot(h[go] ^ _round(U64(0), word[pos[go] + 8 * j]), 27) * P1 + P4
    pos += rest & 24
    go = np.flatnonzero(rest & 4)
    if len(go):
        h[go] = _rot(h[go] ^ (half[pos[go]].astype(U64) * P1), 23) * P2 + P3
    pos += rest & 4
    for j in range(3):
        go = np.flatnonzero((rest & 3) > j)
        if len(go):
            h[go] = _rot(h[go] ^ (data[pos[go] + j].astype(U64) * P5), 11) * P1
    h = (h ^ (h >> U64(33))) * P2
    h = (h ^ (h >> U64(29))) * P3
    return h ^ (h >> U64(32))
