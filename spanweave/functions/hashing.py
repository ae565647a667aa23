"""Counter-based random numbers: the same on every cluster, whatever the partitioning."""

from __future__ import annotations

from hashlib import md5

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(*parts) -> Column:
    """A whole number below 2^32 from the first hex digits of md5 over the parts."""
    joined = F.concat_ws("|", *(F.lit(p) if isinstance(p, (str, int)) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """A double in (0, 1)."""
    return (hash32(*parts) + 0.5) / float(1 << 32)


def bucket(n: int, *parts) -> Column:
    return F.pmod(hash32(*parts), F.lit(n))


_SHIFTS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]])
_ADDED = np.floor(np.abs(np.sin(np.arange(1, 65))) * 4294967296).astype(np.uint32)
#: Messages that are hashed at once; their words stay in the cache.
_AT_ONCE = 8192


def _first_words(blocks: np.ndarray) -> np.ndarray:
    """The first 32 bits, as md5 prints them, of messages that fill one padded block each: [16, n] little-endian words."""
    a, b, c, d = (np.full(blocks.shape[1], v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    for i in range(64):
        r = i // 16
        if r == 0:
            f, g = d ^ (b & (c ^ d)), i
        elif r == 1:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif r == 2:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += _ADDED[i]
        f += blocks[g]
        s = np.uint32(_SHIFTS[r, i % 4])
        turned = f << s
        turned |= f >> np.uint32(32 - s)
        turned += b
        a, d, c, b = d, c, b, turned
    return (a + np.uint32(0x67452301)).byteswap()


def hash32_of(name: str, ids: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """hash32(name, ids[owner], place) of whole numbers, place not negative, for many rows at once."""
    heads = [f"{name}|{k}|".encode() for k in ids.tolist()]
    if not len(owner) or max(map(len, heads)) > 36:  # else a message fills one block
        tail = zip(owner.tolist(), place.tolist(), strict=True)
        return np.array([int(md5(heads[o] + str(p).encode()).hexdigest()[:8], 16) for o, p in tail], np.int64)
    table = np.array(heads, dtype="S64").view(np.uint8).reshape(len(heads), 64)
    sizes = np.array([len(h) for h in heads])
    out = np.empty(len(owner), np.int64)
    for k in range(0, len(owner), _AT_ONCE):
        own, left = owner[k : k + _AT_ONCE], place[k : k + _AT_ONCE]
        m = table[own]
        digits = 1 + sum((left >= 10**e).astype(np.int64) for e in range(1, len(str(int(left.max())))))
        end = np.arange(len(own)) * 64 + sizes[own] + digits
        flat = m.reshape(-1)
        flat[end] = 0x80
        for e in range(int(digits.max())):
            some = digits > e
            flat[end[some] - 1 - e] = left[some] // 10**e % 10 + 48
        blocks = m.view(np.uint32)
        blocks[:, 14] = (sizes[own] + digits) * 8
        out[k : k + _AT_ONCE] = _first_words(np.ascontiguousarray(blocks.T))
    return out


def bucket_of(n: int, name: str, ids: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """bucket(n, name, ids[owner], place)."""
    return hash32_of(name, ids, owner, place) % n
