"""Static binary-fuse filters (three-wise, eight-bit fingerprints) in numpy: sets of 64-bit keys at about 1.2 bytes a key.

No key of the set is ever denied; another key is taken for a member once in 256 times.
"""

from __future__ import annotations

import math
import struct

import numpy as np

ARITY_BASE, SEGMENT_SHIFT = 3.33, 2.25  # the published sizing of three-wise filters
HEAD = "<QII"  # seed, slots of a segment, segments
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three slots of every hash, one in each of three neighbouring segments: shape (3, n)."""
    wide = np.uint64(segment * segments)
    first = ((h >> np.uint64(32)) * wide >> np.uint64(32)).astype(np.int64)
    mask = segment - 1
    second = (first + segment) ^ (h >> np.uint64(18) & np.uint64(mask)).astype(np.int64)
    third = (first + 2 * segment) ^ (h & np.uint64(mask)).astype(np.int64)
    return np.stack([first, second, third])


def prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of these keys (unsigned 64 bits; repeats count once)."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(ARITY_BASE) + SEGMENT_SHIFT))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    for seed in range(1, 1000):
        h = mixed(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
        order = peeled(slots(h, segment, segments), (segments + 2) * segment)
        if order is not None:
            break
        if seed % 20 == 0:
            segments += max(1, segments // 8)
    else:
        raise RuntimeError(f"no filter for {n} keys")
    at, table = slots(h, segment, segments), np.zeros((segments + 2) * segment, dtype=np.uint8)
    wanted = prints(h)
    for who, own in reversed(order):  # the keys of one round do not touch each other's slots
        others = np.bitwise_xor.reduce(table[at[:, who]], axis=0) ^ table[own]
        table[own] = wanted[who] ^ others
    return struct.pack(HEAD, seed * 0x9E3779B97F4A7C15 % 2**64, segment, segments) + table.tobytes()


def peeled(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each has for itself), every key in one round; None if some keys cannot be told apart."""
    n = at.shape[1]
    count = np.bincount(at.ravel(), minlength=size)
    total = np.zeros(size, dtype=np.int64)  # exclusive-or of the keys in a slot: the key itself where there is one
    for row in at:
        np.bitwise_xor.at(total, row, np.arange(n))
    rounds, left, single = [], n, np.flatnonzero(count == 1)
    while left:
        if not len(single):
            return None
        who, first = np.unique(total[single], return_index=True)
        rounds.append((who, single[first]))
        left -= len(who)
        touched = at[:, who].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(total, touched, np.tile(who, 3))
        touched = np.unique(touched)
        single = touched[count[touched] == 1]
    return rounds


def contains(built: bytes, keys: np.ndarray) -> np.ndarray:
    """For every key whether it may be in the set."""
    seed, segment, segments = struct.unpack_from(HEAD, built)
    h = mixed(keys.astype(np.uint64), seed)
    table = np.frombuffer(built, dtype=np.uint8, offset=struct.calcsize(HEAD))
    return np.bitwise_xor.reduce(table[slots(h, segment, segments)], axis=0) == prints(h)
