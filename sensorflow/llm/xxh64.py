"""XXH64 of many byte runs at once, in numpy (checked against the xxhash library in the tests)."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Fixed values of the hash.
P1, P2, P3, P4, P5 = (U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Runs of one length are hashed together if there are so many; others, and longer ones, go to the library.
FEW, LONG = 12, 512


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def _lane(acc, x):
    return _turn(acc + x * P2, 31) * P1


def _together(view8: np.ndarray, raw: np.ndarray, at: np.ndarray, size: int, seed: np.uint64) -> np.ndarray:
    """Hashes of the runs of ``size`` bytes that start at ``at``; ``view8[i]`` is the little-endian number of bytes i .. i + 7."""
    k = 0
    if size >= 32:
        acc = [np.full(len(at), v, U) for v in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        while k + 32 <= size:
            for j in range(4):
                acc[j] = _lane(acc[j], view8[at + (k + 8 * j)])
            k += 32
        h = sum((_turn(a, n) for a, n in zip(acc[1:], (7, 12, 18))), _turn(acc[0], 1))
        for a in acc:
            h = (h ^ _lane(U(0), a)) * P1 + P4
    else:
        h = np.full(len(at), seed + P5, U)
    h += U(size)
    while k + 8 <= size:
        h = _turn(h ^ _lane(U(0), view8[at + k]), 27) * P1 + P4
        k += 8
    if k + 4 <= size:
        h = _turn(h ^ (view8[at + k] & U(0xFFFFFFFF)) * P1, 23) * P2 + P3
        k += 4
    while k < size:
        h = _turn(h ^ raw[at + k].astype(U) * P5, 11) * P1
        k += 1
    h = (h ^ (h >> U(33))) * P2
    h = (h ^ (h >> U(29))) * P3
    return h ^ (h >> U(32))


def hashes(raw: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """The unsigned hash of every run ``raw[start: start + length]``."""
    out = np.empty(len(start), U)
    if not len(start):
        return out
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    view8 = np.ndarray((len(padded) - 7,), "<u8", padded.data, 0, (1,))
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    with np.errstate(over="ignore"):
        for size, a, z in zip(sizes.tolist(), first, [*first[1:], len(order)]):
            own = order[a:z]
            if len(own) >= FEW and size <= LONG:
                out[own] = _together(view8, padded, start[own], size, U(seed))
            else:
                out[own] = [xxhash.xxh64_intdigest(raw[s: s + size].tobytes(), seed) for s in start[own].tolist()]
    return out
