"""Vectorised word, shingle and n-gram hashing over batches of texts.

A batch is one byte array holding all texts back to back with their offsets.
Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; A-Z are
lower-cased first. Hashes have 64 bits, so texts are identified up to a chance
of about n^2 / 2^65 among n distinct words or shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte that is not a letter or digit.
IS_SIGN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_rng = np.random.default_rng(20240607)
BYTE_HASH = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values (in place when possible)."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for k, b in enumerate((BASE, BASE_INV)):
            p = np.full(size, b, U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], pa.string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (or one row)."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + most, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def words(raw: np.ndarray, off: np.ndarray, separator: np.ndarray = IS_SPACE, fold: bool = True, cuts: np.ndarray | None = None):
    """``(start, end, hash, first)``: byte spans and hashes of all words, and the index of each text's first word.

    ``fold``: whether A-Z count as a-z. ``cuts``: places inside words where a further word begins.
    """
    n = len(raw)
    low = LOWER[raw] if fold else raw
    word = ~separator[low]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cut = off[:-1][(off[:-1] < n)]
    begins[cut] = word[cut]
    if cuts is not None:
        begins[cuts] = True
    start = np.flatnonzero(begins)
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < n)] - 1
    closes[inner] = word[inner]  # a word that touches the next text's first word ends at the border
    if cuts is not None:
        closes[cuts - 1] = True
    ends = np.flatnonzero(closes)
    p, q = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(BYTE_HASH[low] * p[:n], dtype=U, out=total[1:])
    h = mix((total[ends + 1] - total[start]) * q[start])
    return start, ends + 1, h, np.searchsorted(start, off)


def shingles(h: np.ndarray, first: np.ndarray, width: int = 5):
    """Hashes of all ``width``-word shingles and the index of each text's first one.

    A text of fewer words (but at least one) has its whole sequence as its one shingle.
    """
    count = np.diff(first)
    many = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(many, out=at[1:])
    if not at[-1]:
        return np.zeros(0, U), at
    n = len(h)
    s = h[: max(0, n - width + 1)].copy()
    for k in range(1, width):
        s = s * BASE + h[k: n - width + 1 + k]
    out = np.empty(at[-1], U)
    full = np.flatnonzero(count >= width)
    pick = np.repeat(first[:-1][full] - at[:-1][full], many[full]) + ranges(at[:-1][full], many[full])
    out[ranges(at[:-1][full], many[full])] = s[pick] if len(pick) else s[:0]
    for d in np.flatnonzero((count > 0) & (count < width)):
        x = U(int(count[d]))
        for v in h[first[d]: first[d + 1]]:
            x = U((int(x) * int(BASE) + int(v)) & (2**64 - 1))
        out[at[d]] = x
    return mix(out), at


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ``start[i] .. start[i] + count[i]``."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return base + np.arange(total)


def distinct_sets(s: np.ndarray, at: np.ndarray):
    """Sorted distinct shingles of every text: values and n + 1 offsets."""
    if not len(s):
        return s, at * 0
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = np.empty_like(s)
    for d in range(len(at) - 1):
        seg = out[at[d]: at[d + 1]] = s[at[d]: at[d + 1]]
        out[at[d]: at[d + 1]] = np.sort(seg)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    off = np.zeros(len(at), np.int64)
    np.cumsum(np.bincount(doc[keep], minlength=len(at) - 1), out=off[1:])
    return out[keep], off
