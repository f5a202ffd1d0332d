"""XXH64 of many slices of one buffer at once, as array arithmetic.

The slices (shingles of a batch of documents) are grouped by length; every
group runs the published XXH64 steps on whole arrays.
"""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the XXH64 specification.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)

PAD = b"\0" * 8
LONGEST_GROUPED = 96  # longer slices are few and go to the library one by one


def _rotl(x, r: int):
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def _same_length(u64, u32, u8, s, length: int, seed):
    at = 0
    if length >= 32:
        acc = [np.full(len(s), v, np.uint64) for v in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        while at + 32 <= length:
            acc = [_round(a, u64[s + (at + 8 * k)]) for k, a in enumerate(acc)]
            at += 32
        h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for a in acc:
            h = (h ^ _round(np.uint64(0), a)) * P1 + P4
    else:
        h = np.full(len(s), seed + P5, np.uint64)
    h = h + np.uint64(length)
    while at + 8 <= length:
        h = _rotl(h ^ _round(np.uint64(0), u64[s + at]), 27) * P1 + P4
        at += 8
    if at + 4 <= length:
        h = _rotl(h ^ (u32[s + at].astype(np.uint64) * P1), 23) * P2 + P3
        at += 4
    while at < length:
        h = _rotl(h ^ (u8[s + at].astype(np.uint64) * P5), 11) * P1
        at += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxh64_slices(buffer: bytes, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``buffer[s : s + n]`` for each start and length, unsigned."""
    data = buffer + PAD
    u8 = np.frombuffer(data, np.uint8)
    u64 = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    u32 = np.ndarray((len(data) - 3,), "<u4", data, strides=(1,))
    out = np.empty(len(starts), np.uint64)
    short = np.minimum(lengths, LONGEST_GROUPED + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    edges = np.flatnonzero(np.diff(short[order])) + 1
    with np.errstate(over="ignore"):
        for part in np.split(order, edges) if len(order) else []:
            length = int(short[part[0]])
            if length <= LONGEST_GROUPED:
                out[part] = _same_length(u64, u32, u8, starts[part], length, np.uint64(seed))
            else:
                out[part] = [xxhash.xxh64_intdigest(buffer[a : a + n], seed) for a, n in zip(starts[part].tolist(), lengths[part].tolist())]
    return out
